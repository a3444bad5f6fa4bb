"""Headline metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendlens.functions.columns import amount, as_row, cents, percent, ratio, round_n
from vendlens.operators.marts import PLAUSIBLE_DAYS
from vendlens.operators.ordering import sum_of_first
from vendlens.operators.rfm import KEY, customer_profile
from vendlens.schemas import Star
from vendlens.session import materialise

# The columns of the order rollup that the metrics and the customer profile read.
ROLLUP_COLUMNS = [
    "order_id", KEY, "address_rows", "order_status", "is_revenue_order", "is_cancelled_order",
    "order_date", "days_to_deliver", "item_count", "order_revenue",
]


def headline_metrics(
    star: Star, top_customers: int = 8000, profile: DataFrame | None = None
) -> DataFrame:
    """One row with the eleven headline numbers.  Runs a job to order the customers' spending.

    `profile` is the stored customer profile of a star whose order rollup is stored as well.
    Without it, the columns of the rollup that are needed here are stored first, as they are
    read three times: the raw tables of a lazy star are then joined once.

    `top_customers` is a number of customers, not a share: the metric is the
    revenue share of that many biggest spenders, however many customers there are.
    """
    sale = F.col("is_revenue_order") == 1
    rows = F.col("address_rows")
    # Delivery times count once per order, whatever the addresses.
    delivered = (F.col("order_status") == "delivered") & F.col("days_to_deliver").between(
        *PLAUSIBLE_DAYS
    )
    rollup = star.order_rollup
    if profile is None:
        rollup = materialise(rollup.select(*ROLLUP_COLUMNS), "rollup")
        profile = customer_profile(rollup)
    totals = rollup.agg(
        F.sum(F.when(sale, cents(F.col("order_revenue")) * rows)).alias("revenue_cents"),
        F.coalesce(F.sum(F.when(sale, rows)), F.lit(0)).alias("orders"),
        F.min(F.when(sale, F.col("order_date"))).cast("string").alias("period_start"),
        F.max(F.when(sale, F.col("order_date"))).cast("string").alias("period_end"),
        percent(F.sum(F.col("is_cancelled_order") * rows), F.sum(rows))
        .alias("cancellation_rate_pct"),
        round_n(F.avg(F.when(delivered, F.col("days_to_deliver"))), 2)
        .alias("avg_delivery_days"),
    )
    customers = profile.agg(
        F.count(KEY).alias("unique_customers"),
        percent(F.count_if(F.col("frequency") > 1), F.count(F.lit(1)))
        .alias("repeat_customer_pct"),
    )
    top = sum_of_first(profile, "monetary_cents", top_customers).withColumnRenamed(
        "monetary_cents", "top_cents"
    )
    reviews = star.fact_reviews.agg(round_n(F.avg("review_score"), 2).alias("avg_review_score"))

    parts = [totals, customers, top, reviews]
    one_row = star.fact_reviews.sparkSession.range(1)
    row = one_row.select(*[as_row(p).alias(f"p{i}") for i, p in enumerate(parts)])
    revenue = amount(F.col("revenue_cents"))
    return row.select(*[f"p{i}.*" for i in range(len(parts))]).select(
        revenue.alias("revenue_brl"),
        "orders",
        "unique_customers",
        round_n(ratio(revenue, F.col("orders")), 2).alias("aov_brl"),
        "repeat_customer_pct",
        percent(amount(F.col("top_cents")), revenue).alias("top8pct_customers_share_of_revenue"),
        "period_start",
        "period_end",
        "cancellation_rate_pct",
        "avg_delivery_days",
        "avg_review_score",
    )
