"""States that all have the same delivery days or score, as rounded means of large tables may."""

import math

import pytest
from pyspark.sql import functions as F

from vendlens.functions.columns import as_row
from vendlens.functions.statistics import pearson_t, student_p
from vendlens.operators import findings
from vendlens.sinks.files import export_json


def states(spark, pairs):
    return spark.createDataFrame(pairs, "avg_delivery_days double, avg_review_score double")


@pytest.mark.parametrize("pairs", [
    [(17.0, 3.14), (17.0, 3.11), (17.0, 3.1)],
    [(8.7, 0.1), (15.1, 0.1), (11.9, 0.1)],
    [(17.0, 3.0), (17.0, 3.0)],
    [(17.0, 3.14), (17.0, 3.11), (9.0, None), (None, 2.0)],
    [(1e-170, 1.0), (2e-170, 2.0)],
])
def test_no_spread_is_no_number(spark, pairs):
    df = states(spark, pairs).repartition(3)
    found = findings.delivery_review_correlation(df).first()
    assert math.isnan(found.r)
    assert found.n == sum(None not in p for p in pairs)
    r, p = findings.delivery_review_test(df).first()
    assert math.isnan(r)
    # Two pairs leave no degree of freedom.
    assert math.isnan(p) if found.n > 2 else p is None


@pytest.mark.parametrize("pairs", [[], [(1.0, 2.0)], [(1.0, None), (None, 2.0), (3.0, 4.0)]])
def test_fewer_than_two_pairs(spark, pairs):
    found = findings.delivery_review_correlation(states(spark, pairs)).first()
    assert (found.r, found.n) == (None, sum(None not in p for p in pairs))
    assert tuple(findings.delivery_review_test(states(spark, pairs)).first()) == (None, None)


def test_only_whole_pairs_count(spark):
    pairs = [(8.7, 4.16), (15.1, 3.83), (11.9, 4.11), (15.2, 4.08), (19.2, 3.83)]
    whole = states(spark, pairs)
    half = states(spark, [*pairs, (900.0, None), (None, -900.0)])
    expected = whole.agg(F.corr("avg_delivery_days", "avg_review_score")).first()[0]
    for df in (whole, half):
        found = findings.delivery_review_correlation(df).first()
        assert (found.r, found.n) == (pytest.approx(expected, rel=1e-12), 5)
    perfect = states(spark, [(1.0, 2.0), (2.0, 4.0), (4.0, 8.0)])
    assert tuple(findings.delivery_review_test(perfect).first()) == (1.0, 0.0)


def test_tail_of_no_number(spark):
    nan = F.lit(float("nan"))
    row = spark.range(1).select(
        pearson_t(nan, F.lit(25.0)).alias("t"), student_p(nan, F.lit(23.0)).alias("p"),
        student_p(nan, F.lit(0.0)).alias("none"),
    ).first()
    assert math.isnan(row.t) and math.isnan(row.p) and row.none is None


def test_no_number_in_the_exported_document(spark, tmp_path):
    state = findings.delivery_review_test(states(spark, [(17.0, 3.14), (17.0, 3.11)]))
    document = spark.range(1).select(as_row(state).alias("state"))
    path = export_json(document, str(tmp_path), "findings")
    read = spark.read.schema(document.schema).json(path)
    assert math.isnan(read.first().state.delivery_vs_review_r)


def test_rows_of_the_document_spell_no_number_as_the_sql_does(spark, small):
    import __spark_entry__ as entry

    document = entry._findings(spark, small)
    state = F.col("state").withField("delivery_vs_review_r", F.lit(float("nan"))).withField(
        "delivery_vs_review_p", F.lit(None).cast("double"))
    found = {(r.section, r.field): r.text for r in entry._findings_rows(
        document.withColumn("state", state)).collect()}
    assert found["state", "delivery_vs_review_r"] == "nan"
    assert found["state", "delivery_vs_review_p"] is None
    before = {(r.section, r.field): r.text for r in entry._findings_rows(document).collect()}
    changed = {key for key in before if before[key] != found[key]}
    assert changed <= {("state", "delivery_vs_review_r"), ("state", "delivery_vs_review_p")}
