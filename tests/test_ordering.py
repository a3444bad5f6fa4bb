import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vendlens.operators import ordering as ordering_module
from vendlens.operators.ordering import (
    Ordering,
    first_rows,
    ntile,
    rank_and_running_sum,
    ranged,
    rows_at,
    sum_of_first,
)


@pytest.fixture(params=[1, 4, 23])
def ranges(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def table(spark, n, seed=1):
    """Heavy ties (nine in ten rows share one value), NULL values, a NULL key."""
    draw = random.Random(seed)
    data = []
    for i in range(n):
        v = draw.choice([None, draw.randrange(50)]) if draw.random() < 0.1 else 7
        data.append((None if i == n // 2 else f"k{i:05d}", v))
    return spark.createDataFrame(data, "key string, value bigint").repartition(5)


def spec(descending):
    value = F.col("value").desc_nulls_last() if descending else F.col("value").asc_nulls_last()
    return Window.orderBy(value, F.col("key").asc_nulls_last())


@pytest.mark.parametrize("descending", [False, True])
def test_ntile_equals_the_builtin_window(spark, descending, ranges):
    df = table(spark, 1003)
    ours = ntile(df, 5, Ordering("value", "key", descending))
    wrong = df.select(ours.alias("a"), F.ntile(5).over(spec(descending)).alias("b")).where("a <> b")
    assert wrong.count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9, 10, 11, 24])
def test_ntile_of_few_rows(spark, n):
    df = table(spark, n, seed=n)
    for k in (2, 3, 5, 7):
        ours = ntile(df, k, Ordering("value", "key"))
        got = df.select(ours.alias("a"), F.ntile(k).over(spec(False)).alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got]


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_and_running_sums_equal_the_builtin_window(spark, descending, ranges):
    n = 1500
    df = table(spark, n)
    ours = rank_and_running_sum(df, Ordering("value", "key", descending), "value")
    w = spec(descending)
    theirs = df.select(
        "key", "value", F.row_number().over(w).alias("rank"),
        F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_sum"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("total_rows"),
        F.sum("value").over(Window.partitionBy()).alias("total_sum"),
    )
    columns = theirs.columns
    assert ours.select(*columns).exceptAll(theirs).count() == 0
    assert ours.count() == n


def test_all_null_values(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "key string, value bigint")
    got = rank_and_running_sum(df, Ordering("value", "key"), "value").orderBy("rank").collect()
    assert [(r.key, r.rank, r.running_sum) for r in got] == [("a", 1, None), ("b", 2, None)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "key string, value bigint")
    assert df.select(ntile(df, 5, Ordering("value", "key"))).count() == 0
    assert rank_and_running_sum(df, Ordering("value", "key"), "value").count() == 0


def test_small_tables_have_several_ranges(spark):
    assert ranged(table(spark, 1000), Ordering("value", "key")).select("range").distinct() \
        .count() > 1


def test_two_million_rows_of_which_most_tie(spark):
    """97 % of the rows share one value; ranges stay even, sums and tiles are exact."""
    n = 2_000_000
    df = spark.range(n).select(
        F.col("id").alias("key"), F.when(F.col("id") % 100 < 97, 5).otherwise(F.col("id") % 9)
        .cast("bigint").alias("value"),
    )
    order = Ordering("value", "key")
    sizes = [r["count"] for r in ranged(df, order).groupBy("range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.6 * n / 4
    tiles = df.groupBy(ntile(df, 5, order).alias("t")).count().collect()
    assert {r.t: r["count"] for r in tiles} == {t: n // 5 for t in range(1, 6)}
    ranked = rank_and_running_sum(df, order, "value")
    total = df.agg(F.sum("value")).first()[0]
    assert ranked.agg(F.min("rank"), F.max("rank"), F.max("running_sum"), F.max("total_sum")) \
        .first()[:] == (1, n, total, total)


def test_rows_at_ranks(spark):
    df = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    order = Ordering("value", "key")
    found = rows_at(ranged(df, order), order, lambda rows: [1, 500, rows])
    assert [f'"key":{k}' in p for k, p in zip((0, 499, 999), found.places)] == [True] * 3


def test_plan_has_no_single_partition_window_over_rows(spark):
    ranked = rank_and_running_sum(table(spark, 1000), Ordering("value", "key"), "value")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    # Single-partition windows only see one row per range, below the broadcast.
    above = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in above


@pytest.mark.parametrize("n", [0, 1, 7, 500, 1002, 1003, 5000])
def test_first_rows_are_those_of_a_sort(spark, n, ranges):
    df = table(spark, 1003)
    ordering = Ordering("value", "key", descending=True)
    ours = first_rows(df, ordering, n)
    assert "TakeOrdered" not in ours._jdf.queryExecution().executedPlan().toString()
    theirs = df.orderBy(*ordering.sort_columns()).limit(n)
    assert sorted(ours.collect(), key=repr) == sorted(theirs.collect(), key=repr)


def test_tiles_store_values_and_boundary_rows_only(spark, monkeypatch):
    """Ten rows a value: what is put in order is one row per value, and the rows of four values."""
    stored = []

    def recorded(df, ordering, store=ranged):
        result = store(df, ordering)
        stored.append(result.count())
        return result

    monkeypatch.setattr(ordering_module, "ranged", recorded)
    df = spark.range(3000).select(
        F.col("id").alias("range"), (F.col("id") % 300).alias("rows")
    )
    ours = ntile(df, 5, Ordering("rows", "range", descending=True))
    w = Window.orderBy(F.desc("rows"), "range")
    assert df.select(ours.alias("a"), F.ntile(5).over(w).alias("b")).where("a <> b").count() == 0
    assert stored == [300, 40]


@pytest.mark.parametrize("n", [0, 1, 7, 500, 1002, 1003, 5000])
def test_sum_of_first_is_that_of_a_sort(spark, n, ranges):
    df = table(spark, 1003).withColumn("value", F.col("value") * F.crc32("key") % 1000)
    theirs = df.orderBy(F.desc_nulls_last("value")).limit(n).agg(F.sum("value")).first()[0]
    assert sum_of_first(df, "value", n).first()[0] == theirs
    assert sum_of_first(df.limit(0), "value", n).first()[0] is None
