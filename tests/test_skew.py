"""A third of all rows on one key."""

import pytest
from pyspark.sql import functions as F

from vendlens.operators import marts
from vendlens.operators.facts import fact_orders


def joins(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def eager_splitting(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adaptive_execution_splits_a_customer_with_a_third_of_all_orders(spark, eager_splitting):
    n = 9000
    orders = spark.range(0, n, 1, 8).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit("2017-01-01").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in (
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")],
    )
    customers = spark.range(n).select(
        F.col("id").alias("customer_id"), (F.col("id") + 1).alias("customer_unique_id"))
    facts = fact_orders(orders, customers)
    counts = facts.groupBy("order_month", "customer_unique_id").agg(
        F.count("order_id").alias("n"), F.sum("order_id").alias("ids"))
    plan = joins(counts)
    assert "SortMergeJoin(skew=true)" in plan
    assert counts.agg(F.sum("n"), F.max("n"), F.sum("ids")).first()[:] == (
        n, n // 3, n * (n - 1) // 2)


def test_an_order_with_a_third_of_all_reviews_is_split(spark, eager_splitting):
    n = 9000
    reviews = spark.range(0, n, 1, 8).select(
        F.col("id").alias("review_id"), F.lit(4).alias("review_score"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_id"),
    )
    items = spark.range(n).select(
        F.col("id").alias("order_id"), F.lit(1).alias("product_id"), F.lit(2.5).alias("price"),
        F.lit(0.5).alias("freight_value"),
    )
    orders = spark.range(n).select(F.col("id").alias("order_id"), F.lit(1).alias("is_revenue_order"))
    products = spark.createDataFrame([(1, "c")], "product_id int, category string")
    mart = marts.category_performance(items, orders, products, reviews)
    plan = joins(mart)
    assert "SortMergeJoin(skew=true)" in plan
    assert "Expand" not in plan and "Generate" not in plan
    row = mart.first()
    assert (row.orders, row.reviews, row.avg_review_score) == (n, n, 4.0)
    assert row.items_sold == n + n // 3 - 1


def test_a_customer_of_many_addresses_and_orders(spark):
    """10,000 addresses by 10,000 orders enter as weights, never as 10^8 rows."""
    from vendlens.operators import marts as m
    from vendlens.operators.facts import home_states

    n = 10_000
    rollup = spark.range(n).selectExpr(
        "id AS order_id", "'u' AS customer_unique_id", "'delivered' AS order_status",
        "1 AS is_revenue_order", "DATE'2020-01-01' AS order_month", "3 AS days_to_deliver",
        "1 AS days_vs_estimate", "2L AS item_count", "1.5D AS order_revenue",
        "4.0D AS avg_review_score", f"{n}L AS address_rows", "1L AS review_rows",
        "1L AS review_scores", "4.0D AS review_score_sum",
    )
    customers = spark.range(n).selectExpr(
        "'u' AS customer_unique_id", "concat('S', id % 27) AS customer_state"
    )
    kpi = m.monthly_kpi(rollup).collect()
    assert [(r.orders, r.customers, r.revenue, r.items_sold) for r in kpi] == [
        (n, 1, 1.5 * n * n, 2 * n * n)]
    state = m.state_performance(rollup, home_states(customers))
    sla = m.sla_by_state(rollup, home_states(customers))
    assert sum(r.revenue for r in state.collect()) == 1.5 * n * n
    assert {r.orders for r in state.collect()} == {n}
    assert sum(r.delivered_orders for r in sla.collect()) == n * n
