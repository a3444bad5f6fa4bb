"""Recency, frequency, monetary scores and customer segments.

Two frequency scores are kept apart on purpose: `rfm_tiered` uses fixed tiers
(1 / 2 / 3-4 / 5+ orders), `rfm_ntile` quintiles.  The segments build on the tiers.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendlens.functions.columns import amount, cents, percent, ratio, round_n, whole_table_sum
from vendlens.operators.facts import times
from vendlens.operators.ordering import Ordering, ntile
from vendlens.session import materialise

KEY = "customer_unique_id"

# The order in which segments are listed.  No rule gives the labels
# "Cant Lose Them" and "Other"; they only hold their place in the list.
SEGMENT_ORDER = [
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "New / Promising",
    "Need Attention",
    "At Risk",
    "Cant Lose Them",
    "Hibernating / Lost",
    "Other",
]


def customer_profile(summary: DataFrame) -> DataFrame:
    """One row per customer with a revenue order; money in cents.

    From the order rollup, weighted by address rows, or the summary, which repeats orders.
    """
    rows = times(summary)
    return (
        summary.where("is_revenue_order = 1")
        .groupBy(KEY)
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.countDistinct("order_id").alias("frequency"),
            F.sum(cents(F.col("order_revenue")) * rows).alias("monetary_cents"),
            F.sum(F.col("item_count") * rows).alias("items_bought"),
        )
    )


def frequency_tier(frequency: Column) -> Column:
    return (
        F.when(frequency == 1, 1).when(frequency == 2, 2).when(frequency <= 4, 3).otherwise(4)
    )


def _scored(profile: DataFrame, tiered: bool, stored: bool) -> DataFrame:
    # The profile is read once per score below, so it is written down first, unless
    # it is a stored table already: one row per customer, far smaller than the
    # order facts it comes from.
    base = profile if stored else materialise(profile, "customer_profile")

    def quintile(value: str) -> Column:
        return ntile(base, 5, Ordering(value, KEY))

    # The searches for the tile starts do not depend on each other.
    scores = ["last_order_date", "monetary_cents"] + ([] if tiered else ["frequency"])
    with ThreadPoolExecutor(len(scores)) as pool:
        tiles = dict(zip(scores, pool.map(quintile, scores)))

    as_of = base.agg(F.max("last_order_date").alias("as_of_date")).scalar()
    # The most recent fifth scores 5: fewest days since the last order is the
    # same as the latest last order.
    frequency_score = frequency_tier(F.col("frequency")) if tiered else tiles["frequency"]
    scored = base.select(
        "*",
        as_of.alias("as_of_date"),
        tiles["last_order_date"].alias("r_score"),
        frequency_score.alias("f_score"),
        tiles["monetary_cents"].alias("m_score"),
    )
    spent = F.col("monetary_cents")
    return scored.select(
        "*",
        F.datediff("as_of_date", "last_order_date").alias("recency_days"),
        amount(spent).alias("monetary"),
        round_n(ratio(amount(spent), F.col("frequency")), 2).alias("avg_order_value"),
        F.when(F.col("frequency") > 1, 1).otherwise(0).alias("is_repeat_customer"),
    )


def with_rfm_cell(scored: DataFrame) -> DataFrame:
    """Add the three scores as one text such as '514' (A7)."""
    return scored.withColumn(
        "rfm_cell", F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")])
    )


def rfm_tiered(profile: DataFrame, stored: bool = False) -> DataFrame:
    """RFM with the tiered frequency score (B11).  Runs jobs to find the tiles."""
    return with_rfm_cell(_scored(profile, True, stored)).select(
        KEY, "first_order_date", "last_order_date", "as_of_date", "recency_days", "frequency",
        "monetary", "items_bought", "r_score", "f_score", "m_score", "avg_order_value",
        "is_repeat_customer", "rfm_cell",
    )


def rfm_ntile(profile: DataFrame, stored: bool = False) -> DataFrame:
    """RFM with quintiles for all three scores (C2).  Runs jobs to find the tiles."""
    return with_rfm_cell(_scored(profile, False, stored)).select(
        KEY, "first_order_date", "last_order_date", "as_of_date", "recency_days", "frequency",
        "monetary", "items_bought", "r_score", "f_score", "m_score", "rfm_cell",
        "avg_order_value", "is_repeat_customer",
    )


def average_spend(rfm: DataFrame) -> Column:
    """Average customer spend, as a scalar subquery."""
    mean = ratio(amount(F.sum(cents(F.col("monetary")))), F.count("monetary"))
    return rfm.agg(mean.alias("average_spend")).scalar()


def customer_segments(rfm: DataFrame) -> DataFrame:
    """Tiered RFM plus a segment label from the R x F grid."""
    r, f = F.col("r_score"), F.col("f_score")
    repeat = f >= 2
    segment = (
        F.when(r == 5, F.when(f >= 3, "Champions").when(f == 2, "Loyal Customers")
               .otherwise("New / Promising"))
        .when((r == 4) & repeat, "Loyal Customers")
        .when((r == 3) & repeat, "Potential Loyalists")
        .when(r.isin(3, 4), "Need Attention")
        .when((r == 2) & repeat & (F.col("monetary") > average_spend(rfm)), "At Risk")
        .otherwise("Hibernating / Lost")
    )
    return rfm.withColumn("segment", segment)


def segment_rollup(segments: DataFrame) -> DataFrame:
    """Size, revenue and averages of each segment."""
    spent = F.col("spent")
    return (
        segments.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum(cents(F.col("monetary"))).alias("spent"),
            F.count("monetary").alias("spenders"),
            F.avg("frequency").alias("mean_frequency"),
            F.avg("recency_days").alias("mean_recency"),
        )
        .select(
            "segment",
            "customers",
            percent(F.col("customers"), whole_table_sum(F.col("customers")))
            .alias("pct_customers"),
            amount(spent).alias("revenue"),
            percent(amount(spent), amount(whole_table_sum(spent))).alias("pct_revenue"),
            round_n(ratio(amount(spent), F.col("spenders")), 2).alias("avg_monetary"),
            round_n(F.col("mean_frequency"), 2).alias("avg_frequency"),
            round_n(F.col("mean_recency"), 0).alias("avg_recency_days"),
        )
        .orderBy(F.desc_nulls_last("revenue"), "segment")
    )
