from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vendlens.functions.columns import (
    amount, boundaries_crossed, cents, percent, ratio, round_n,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("x, digits, expected", [
    (1.005, 2, 1.0), (2.675, 2, 2.68), (0.285, 2, 0.28), (-2.5, 0, -3.0), (0.66665, 4, 0.6667),
])
def test_rounding_follows_the_binary_value(spark, x, digits, expected):
    assert value(spark, round_n(F.lit(x), digits)) == expected


@pytest.mark.parametrize("unit, start, end, expected", [
    ("minute", "2020-01-01 00:00:59", "2020-01-01 00:01:01", 1),
    ("minute", "2020-01-01 00:00:00", "2020-01-01 00:00:59", 0),
    ("minute", "2020-01-01 00:01:01", "2020-01-01 00:00:59", -1),
    ("hour", "2020-01-01 00:59:59", "2020-01-01 01:00:00", 1),
    ("hour", "1969-12-31 23:59:59", "1970-01-01 00:00:00", 1),
])
def test_boundaries_not_elapsed_time(spark, unit, start, end, expected):
    df = spark.createDataFrame(
        [(datetime.fromisoformat(start), datetime.fromisoformat(end))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert df.select(boundaries_crossed(unit, F.col("a"), F.col("b"))).first()[0] == expected


def test_boundaries_do_not_depend_on_the_session_time_zone(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1, 0, 40), datetime(2020, 1, 1, 1, 10))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        assert df.select(boundaries_crossed("hour", F.col("a"), F.col("b"))).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_money_is_exact_in_any_order(spark):
    df = spark.range(1000).select((F.col("id") % 7 * 0.1 + 0.1).alias("x"))
    forwards = df.agg(F.sum(cents(F.col("x")))).first()[0]
    backwards = df.orderBy(F.desc("id")).repartition(7).agg(F.sum(cents(F.col("x")))).first()[0]
    assert forwards == backwards == sum(10 * (i % 7) + 10 for i in range(1000))
    assert value(spark, amount(F.lit(1001))) == 10.01


def test_ratios_with_zero_denominator_are_null(spark):
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, ratio(F.lit(0), F.lit(0))) is None
    assert value(spark, percent(F.lit(2), F.lit(3))) == 66.67
