"""Data behind each chart and dashboard panel (F1-F16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendlens.functions.columns import as_row, ratio, round_n
from vendlens.operators.findings import (
    WINDOW_START,
    analysis_window,
    cohort_matrix,
    month_on_month,
)
from vendlens.operators.marts import DELIVERY_BUCKETS, NO_DELIVERY
from vendlens.operators.ordering import Ordering, first_rows
from vendlens.operators.rfm import KEY


def monthly_trend(kpi: DataFrame, window_start: str = WINDOW_START) -> DataFrame:
    """Revenue in thousands, orders, order value and growth per month (F1)."""
    return month_on_month(kpi, window_start).select(
        "order_month",
        (F.col("revenue") / F.lit(1000.0)).alias("revenue_thousands"),
        "orders",
        "aov",
        "rev_mom_pct",
        "partial",
        "in_window",
    ).orderBy("order_month")


def cohort_heatmap(cohort: DataFrame) -> DataFrame:
    """Cohort matrix with a row label (F2)."""
    return cohort_matrix(cohort).withColumn(
        "cohort_label", F.date_format("cohort_month", "MMM-yy")
    )


def frequency_scatter(rfm: DataFrame) -> DataFrame:
    """Orders against spend, one point per customer."""
    return rfm.select("frequency", "monetary")


def pareto_curve(pareto: DataFrame) -> DataFrame:
    """The concentration curve, one point per customer."""
    return pareto.select("pct_customers", "pct_revenue")


def repeat_bars(repeat: DataFrame) -> DataFrame:
    """Customers and revenue by number of orders."""
    return repeat.select("order_bucket", "pct_customers", "pct_revenue").orderBy("order_bucket")


def top_categories(category: DataFrame, k: int = 12) -> DataFrame:
    """The k categories with most revenue."""
    return (
        category.orderBy(F.desc("revenue"), F.asc_nulls_last("category"))
        .limit(k)
        .select("category", "revenue", "pct_revenue", "avg_review_score")
    )


def top_states(state: DataFrame, k: int = 10) -> DataFrame:
    """The k states with most revenue, with their delivery days."""
    return (
        state.orderBy(F.desc_nulls_last("revenue"), "customer_state")
        .limit(k)
        .select("customer_state", "revenue", "avg_delivery_days")
    )


def payment_pie(payment: DataFrame) -> DataFrame:
    """Share of value per payment type and share of payments in instalments (F8)."""
    return payment.select(
        "payment_type",
        "value",
        "pct_value",
        (F.col("pct_multi_installment") * 100.0).alias("pct_multi_installment"),
    )


def on_time_line(sla: DataFrame, window_start: str = WINDOW_START) -> DataFrame:
    """On-time share per month of the analysis window."""
    return (
        sla.where(F.col("order_month") >= F.lit(window_start).cast("date"))
        .select("order_month", "on_time_pct")
        .orderBy("order_month")
    )


def delay_bars(review_delay: DataFrame) -> DataFrame:
    """Review score and bad-review share per delivery bucket, earliest first."""
    order = F.array(*[F.lit(b) for b in DELIVERY_BUCKETS])
    return (
        review_delay.where(F.col("delivery_bucket") != NO_DELIVERY)
        .select("delivery_bucket", "avg_review_score", "pct_bad_reviews")
        .orderBy(F.array_position(order, F.col("delivery_bucket")))
    )


def kpi_cards(kpi: DataFrame, rfm: DataFrame, sla: DataFrame) -> DataFrame:
    """The dashboard's six numbers in one row."""
    totals = kpi.agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    customers = rfm.agg(
        F.count(KEY).alias("customers"),
        (F.avg("is_repeat_customer") * 100.0).alias("repeat_pct"),
    )
    on_time = sla.agg(F.avg("on_time_pct").alias("on_time_pct"))
    rows = kpi.sparkSession.range(1).select(
        as_row(totals).alias("t"), as_row(customers).alias("c"), as_row(on_time).alias("s")
    )
    return rows.select(
        round_n(F.col("t.revenue"), 2).alias("revenue"),
        F.col("t.orders").alias("orders"),
        F.col("c.customers").alias("customers"),
        round_n(ratio(F.col("t.revenue"), F.col("t.orders")), 2).alias("aov"),
        round_n(F.col("c.repeat_pct"), 2).alias("repeat_pct"),
        round_n(F.col("s.on_time_pct"), 2).alias("on_time_pct"),
    )


def kpi_table(kpi: DataFrame) -> DataFrame:
    """Monthly KPIs, newest month first."""
    return kpi.orderBy(F.desc_nulls_last("order_month"))


def segments_by_revenue(segments: DataFrame, ascending: bool = False) -> DataFrame:
    """Segments by revenue, for bars (ascending) or a table."""
    revenue = F.asc_nulls_last("revenue") if ascending else F.desc_nulls_last("revenue")
    return segments.orderBy(revenue, "segment")


def find_customers(rfm: DataFrame, pattern: str, limit: int = 20) -> DataFrame:
    """Customers whose id matches a pattern, ignoring case; the first `limit` by id."""
    return (
        rfm.where(F.col(KEY).cast("string").rlike(f"(?i){pattern}")).orderBy(KEY).limit(limit)
    )


def pareto_sample(pareto: DataFrame, size: int = 3000, seed: int = 7) -> DataFrame:
    """A fixed-size sample of the Pareto curve.

    The rows with the smallest hash of seed and customer: uniform over customers,
    and the same rows however the table is partitioned.  Runs jobs.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(KEY).cast("string")))
    drawn = pareto.select("rk", "pct_customers", "pct_revenue", draw.alias("draw"))
    return first_rows(drawn, Ordering("draw", "rk"), size).drop("draw")


def window_summary(kpi: DataFrame, window_start: str = WINDOW_START) -> DataFrame:
    """Revenue, growth and peak month of the analysis window."""
    month = F.col("order_month")
    totals = (
        analysis_window(kpi, window_start)
        .where("in_window")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.min_by("revenue", month).alias("first"),
            F.max_by("revenue", month).alias("last"),
            F.max(F.struct("revenue", (-F.unix_date(month)).alias("earlier"), month))
            .alias("peak"),
        )
    )
    growth = (ratio(F.col("last"), F.col("first")) - 1.0) * 100.0
    return totals.select(
        round_n(F.col("revenue"), 2).alias("window_revenue"),
        round_n(growth, 0).alias("growth_pct"),
        F.date_format("peak.order_month", "MMM-yyyy").alias("peak_month"),
        F.col("peak.revenue").alias("peak_revenue"),
    )


def state_table(state: DataFrame) -> DataFrame:
    """All states, by revenue (F16)."""
    return state.orderBy(F.desc_nulls_last("revenue"), "customer_state")
