"""Fact tables.

`grain` decides what happens where a customer has several rows in dim_customer:

* "reference": every such row joins, so an order counts once per row.
* "order": one dimension row per customer, one (averaged) review per order.

The rows of a customer enter as a weight: the rollup has one row per order with the number of
its customer's rows, and is only multiplied out where that is the result, in the order summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendlens.functions.columns import amount, boundaries_crossed, cents, ratio
from vendlens.schemas import SUMMARY_COLUMNS

# What counts as a sale, and as a cancellation.
REVENUE_STATUSES = ("delivered", "shipped")
CANCELLED_STATUSES = ("canceled", "unavailable")

GRAINS = ("reference", "order")


def check_grain(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def fact_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the true customer key, status flags and durations in days.

    `days_vs_estimate` is positive for an early delivery.  The customer side is
    reduced to distinct pairs before the join; a customer with very many orders
    is on the left side, where adaptive execution splits the hot partition.
    """
    owner = customers.select("customer_id", "customer_unique_id").distinct()
    bought = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    approved = F.col("order_approved_at").cast("timestamp_ntz")
    shipped = F.col("order_delivered_carrier_date").cast("timestamp_ntz")
    delivered = F.col("order_delivered_customer_date").cast("timestamp_ntz")
    promised = F.col("order_estimated_delivery_date").cast("date")
    status = F.col("order_status")
    return orders.join(owner, "customer_id", "left").select(
        "order_id",
        "customer_unique_id",
        status,
        bought.alias("order_purchase_ts"),
        bought.cast("date").alias("order_date"),
        F.trunc(bought.cast("date"), "month").alias("order_month"),
        approved.alias("order_approved_ts"),
        shipped.alias("shipped_ts"),
        delivered.alias("delivered_ts"),
        promised.alias("estimated_delivery_date"),
        _flag(status.isin(*REVENUE_STATUSES)).alias("is_revenue_order"),
        _flag(status.isin(*CANCELLED_STATUSES)).alias("is_cancelled_order"),
        (boundaries_crossed("minute", bought, approved) / F.lit(60.0)).alias("hours_to_approve"),
        F.datediff(shipped, approved).alias("days_to_ship"),
        F.datediff(delivered, bought).alias("days_to_deliver"),
        F.datediff(promised, delivered).alias("days_vs_estimate"),
    )


def fact_order_items(items: DataFrame) -> DataFrame:
    """Order items; amounts that are no number become NULL."""
    price = F.col("price").try_cast("double")
    freight = F.col("freight_value").try_cast("double")
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).alias("revenue"),
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_ts"),
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    """One row per payment."""
    return payments.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        F.col("payment_installments").try_cast("int").alias("payment_installments"),
        F.col("payment_value").try_cast("double").alias("payment_value"),
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    """One row per review, with the time to its answer in days."""
    created = F.col("review_creation_date").cast("timestamp_ntz")
    answered = F.col("review_answer_timestamp").cast("timestamp_ntz")
    return reviews.select(
        "review_id",
        "order_id",
        F.col("review_score").try_cast("int").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        created.alias("review_creation_ts"),
        answered.alias("review_answer_ts"),
        (boundaries_crossed("hour", created, answered) / F.lit(24.0))
        .alias("days_to_answer_review"),
    )


def home_states(dim_customer: DataFrame) -> DataFrame:
    """(customer_unique_id, customer_state, address_rows): a customer's rows in each state."""
    return dim_customer.groupBy("customer_unique_id", "customer_state").agg(
        F.count(F.lit(1)).alias("address_rows")
    )


def times(orders: DataFrame) -> Column:
    """How often a row counts: by its address rows, or once in a table that has none."""
    return F.col("address_rows") if "address_rows" in orders.columns else F.lit(1)


def _weighted(fact_orders: DataFrame, dim_customer: DataFrame, grain: str) -> DataFrame:
    """Orders with `address_rows`, and with their one state if they have but one.

    With grain "order" a customer lives where their lowest customer id does.
    """
    customers = dim_customer.groupBy("customer_unique_id")
    if grain == "reference":
        joined = customers.agg(F.count(F.lit(1)).alias("address_rows"))
    else:
        first = F.min_by("customer_state", F.struct("first_customer_id", "customer_zip_prefix"))
        joined = customers.agg(first.alias("customer_state")).withColumn("address_rows", F.lit(None))
    once = F.coalesce("address_rows", F.lit(1)).cast("bigint")
    return fact_orders.join(joined, "customer_unique_id", "left").withColumn("address_rows", once)


def order_summary(rollup: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """The rollup with a row for each address row of an order's customer."""
    if "customer_state" in rollup.columns:
        return rollup.select(*SUMMARY_COLUMNS)
    states = dim_customer.select("customer_unique_id", "customer_state")
    return rollup.join(states, "customer_unique_id", "left").select(*SUMMARY_COLUMNS)


def _items_per_order(items: DataFrame) -> DataFrame:
    # A distinct count would move every item twice, by order and seller and then by order.
    sellers = F.size(F.collect_set("seller_id")).cast("bigint")
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        sellers.alias("seller_count"),
        amount(F.sum(cents(F.col("price")))).alias("order_revenue"),
        amount(F.sum(cents(F.col("freight_value")))).alias("order_freight"),
    )


def _reviews_per_order(reviews: DataFrame, grain: str) -> DataFrame:
    """Number of reviews, how many have a score, and the sum of scores.

    With grain "order" an order's reviews count as one, with their average score.
    """
    totals = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_rows"),
        F.count("review_score").alias("review_scores"),
        F.sum("review_score").cast("double").alias("review_score_sum"),
    )
    mean = ratio(F.col("review_score_sum"), F.col("review_scores"))
    totals = totals.withColumn("avg_review_score", mean)
    if grain == "reference":
        return totals
    return totals.select(
        "order_id",
        F.lit(1).cast("bigint").alias("review_rows"),
        F.least("review_scores", F.lit(1)).alias("review_scores"),
        F.col("avg_review_score").alias("review_score_sum"),
        "avg_review_score",
    )


WEIGHTS = ["address_rows", "review_rows", "review_scores", "review_score_sum"]


def order_rollup(
    fact_orders: DataFrame,
    dim_customer: DataFrame,
    fact_order_items: DataFrame,
    fact_payments: DataFrame,
    fact_reviews: DataFrame,
    grain: str = "reference",
) -> DataFrame:
    """One row per order with its item, payment and review totals.

    Items, payments and reviews are aggregated to one row per order before they
    join, partly before the shuffle, so an order with very many of them costs
    one row.  The three joins share one partitioning by order, which tables stored in
    buckets of it have already; customers join last, so rows end up by customer, as the
    profile groups them.  Each is a left join on a unique key: a query that needs no
    reviews, say, does not read them.

    Besides the summary's columns it has review totals and `address_rows`, with which marts
    can weigh an order instead of joining its reviews and its customer's addresses.  The state
    is a column only with grain "order", where there is one; see `order_summary`.
    """
    check_grain(grain)
    paid = fact_payments.groupBy("order_id").agg(
        amount(F.sum(cents(F.col("payment_value")))).alias("paid")
    )
    columns = [c for c in SUMMARY_COLUMNS if grain == "order" or c != "customer_state"]
    orders = (
        fact_orders.join(_items_per_order(fact_order_items), "order_id", "left")
        .join(paid, "order_id", "left")
        .join(_reviews_per_order(fact_reviews, grain), "order_id", "left")
        .withColumn("payment_value", F.coalesce("paid", F.lit(0.0)))
    )
    return _weighted(orders, dim_customer, grain).select(*columns, *WEIGHTS)
