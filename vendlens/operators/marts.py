"""Business marts.

Where a mart's definition repeats an order (once per item, once per review), the
repetition enters as a weight on pre-aggregated rows.  The result is that of the
repeating join, without its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from vendlens.functions.columns import amount, cents, percent, ratio, round_n, whole_table_sum
from vendlens.operators.facts import check_grain, times
from vendlens.operators.ordering import Ordering, rank_and_running_sum
from vendlens.operators.rfm import KEY
from vendlens.session import materialise

# Delivery buckets by days before the promised date.
DELIVERY_BUCKETS = [
    "7+ days early",
    "3-6 days early",
    "0-2 days early",
    "1-3 days late",
    "4+ days late",
]
NO_DELIVERY = "no data"

# Durations outside this range are data errors.
PLAUSIBLE_DAYS = (0, 200)


def _rows() -> Column:
    return F.count(F.lit(1))


def _delivered_in_time_range() -> Column:
    return (F.col("order_status") == "delivered") & F.col("days_to_deliver").between(
        *PLAUSIBLE_DAYS
    )


def _on_time() -> Column:
    return F.when(F.col("days_vs_estimate") >= 0, 1).otherwise(0)


def _state() -> Column:
    return F.coalesce("customer_state", F.lit("UNKNOWN")).alias("customer_state")


def _review_repeats() -> Column:
    """How often a join with the reviews would repeat an order."""
    return F.coalesce("review_rows", F.lit(1))


def _mean(value: Column, rows: Column) -> Column:
    """The mean of a value that counts several times."""
    return ratio(F.sum(value * rows), F.sum(F.when(value.isNotNull(), rows)))


def _in_states(totals: DataFrame, homes: DataFrame | None) -> DataFrame:
    """`totals` per customer, or per customer and state, in their states with `address_rows`.

    What has no state is in the state UNKNOWN, and a customer is in each state once.
    """
    if homes is None:
        return totals.withColumn("customer_state", _state()).withColumn(
            "address_rows", F.lit(1)
        )
    states = homes.groupBy(KEY, _state()).agg(F.sum("address_rows").alias("address_rows"))
    return totals.join(states, KEY, "left").withColumn("customer_state", _state()).withColumn(
        "address_rows", F.coalesce("address_rows", F.lit(1))
    )


def _with_distinct(totals: DataFrame, rows: DataFrame, by: str) -> DataFrame:
    """`totals`, one row per `by`, with how many different orders and customers there are.

    `rows` has the groups of `totals`.  Each is counted from the pairs with `by`; two distinct
    counts in one aggregation would multiply the rows before the shuffle.  Totals and counts
    come side by side by one more aggregation over a few rows per group, without a join.
    """
    parts = [totals]
    for name, column in (("orders", "order_id"), ("customers", KEY)):
        pairs = rows.where(F.col(column).isNotNull()).groupBy(by, column).agg(_rows())
        parts.append(pairs.groupBy(by).agg(_rows().alias(name)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = [F.coalesce(F.max(n), F.lit(0)).alias(n) for n in ("orders", "customers")]
    sums = [F.max(c).alias(c) for c in totals.columns if c != by]
    return union.groupBy(by).agg(*sums, *counts)


def monthly_kpi(summary: DataFrame) -> DataFrame:
    """Orders, customers, revenue and service level per month.

    From the order rollup, weighted by address rows, or the summary, which repeats orders.
    """
    revenue, rows = amount(F.col("revenue_cents")), times(summary)
    sold = summary.where("is_revenue_order = 1")
    totals = sold.groupBy("order_month").agg(
        F.sum(cents(F.col("order_revenue")) * rows).alias("revenue_cents"),
        F.sum(F.col("item_count") * rows).alias("items_sold"),
        _mean(F.col("days_to_deliver"), rows).alias("mean_days"),
        _mean(F.col("avg_review_score"), rows).alias("mean_score"),
    )
    return (
        _with_distinct(totals, sold, "order_month")
        .select(
            "order_month",
            "orders",
            "customers",
            revenue.alias("revenue"),
            round_n(ratio(revenue, F.col("orders")), 2).alias("aov"),
            round_n(ratio(revenue, F.col("customers")), 2).alias("revenue_per_customer"),
            "items_sold",
            round_n(F.col("mean_days"), 1).alias("avg_delivery_days"),
            round_n(F.col("mean_score"), 2).alias("avg_review_score"),
        )
        .orderBy(F.asc_nulls_last("order_month"))
    )


def cohort_retention(orders: DataFrame, max_offset: int = 24) -> DataFrame:
    """Share of each first-purchase month's customers that buy again, by month (C4).

    One shuffle by customer: a customer's months are a set no larger than the
    calendar, and partial sets are merged before the shuffle, so a customer with
    very many orders is no hot key.  Everyone in a cohort is active in its first
    month, so the cohort's size is its count at offset 0.
    """
    first, active = F.col("cohort_month"), F.col("active_month")
    offset = (F.year(active) - F.year(first)) * 12 + F.month(active) - F.month(first)
    in_first_month = F.when(F.col("month_offset") == 0, F.col("active_customers"))
    size = F.max(in_first_month).over(Window.partitionBy("cohort_month"))
    return (
        orders.where((F.col("is_revenue_order") == 1) & F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.collect_set("order_month").alias("months"))
        .select(F.array_min("months").alias("cohort_month"),
                F.explode("months").alias("active_month"))
        .groupBy("cohort_month", offset.alias("month_offset"))
        .agg(_rows().alias("active_customers"))
        .where(F.col("month_offset").between(0, max_offset))
        .select(
            "cohort_month",
            size.alias("cohort_size"),
            "month_offset",
            "active_customers",
            percent(F.col("active_customers"), size).alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_offset")
    )


def pareto(profile: DataFrame) -> DataFrame:
    """Customers by spend with their cumulative share of revenue (C5).  Runs a job."""
    ranked = rank_and_running_sum(
        profile.select(KEY, "monetary_cents"), Ordering("monetary_cents", KEY, descending=True),
        "monetary_cents",
    )
    running = amount(F.col("running_sum"))
    return ranked.select(
        F.col("rank").alias("rk"),
        KEY,
        amount(F.col("monetary_cents")).alias("monetary"),
        running.alias("cumulative_revenue"),
        percent(F.col("rank"), F.col("total_rows"), 4).alias("pct_customers"),
        percent(running, amount(F.col("total_sum")), 4).alias("pct_revenue"),
    )


def category_performance(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
    grain: str = "reference",
) -> DataFrame:
    """Sales and review scores per product category.

    One row per order and category meets one row per order, with the totals of its
    reviews: what the definition repeats enters as weights.  Which reviews a category has
    is a separate, narrow inner join, of which adaptive execution can split either side.
    Items move to their order once: left to itself, Spark would shuffle them by order and
    category first, of which an order has nearly as many as items.  With grain "reference" the
    rows per order and category are read twice, for the sums and for the reviews, and stored
    before: that runs a job.
    """
    check_grain(grain)
    sales = orders.where("is_revenue_order = 1").groupBy("order_id").agg(
        _rows().alias("order_rows")
    )
    sold = (
        items.join(products.select("product_id", "category"), "product_id", "left")
        .select("order_id", "category", cents(F.col("price")).alias("price_cents"),
                cents(F.col("freight_value")).alias("freight_cents"))
        .repartition("order_id")
        .groupBy("order_id", "category")
        .agg(
            _rows().alias("items"),
            F.sum("price_cents").alias("price_cents"),
            F.sum("freight_cents").alias("freight_cents"),
        )
        .join(sales, "order_id")
    )
    score = F.col("review_score")
    if grain == "reference":
        totals = reviews.groupBy("order_id").agg(
            _rows().alias("review_rows"), F.sum(score).alias("score_sum"),
            F.count(score).alias("scores"),
        )
    else:
        # An order's reviews count as one, with their average score.
        ids = reviews.groupBy("order_id", "review_id").agg(
            F.sum(score).alias("s"), F.count(score).alias("n")
        )
        totals = ids.groupBy("order_id").agg(
            F.lit(1).alias("review_rows"), ratio(F.sum("s"), F.sum("n")).alias("score_sum"),
            F.when(F.sum("n") > 0, 1).otherwise(0).alias("scores"),
            F.count("review_id").alias("review_ids"),
        )
    rows = F.col("order_rows") * _review_repeats()
    weight = F.col("order_rows") * F.col("items")
    parts = {
        "items_sold": F.col("items") * rows,
        "price_cents": F.col("price_cents") * rows,
        "freight_cents": F.col("freight_cents") * rows,
        "score_sum": F.col("score_sum") * weight,
        "scores": F.col("scores") * weight,
    }
    if grain == "order":
        parts["reviews"] = F.col("review_ids") * F.col("order_rows")
    reviewed = sold.join(totals, "order_id", "left").select(
        "order_id", "category", *[part.alias(name) for name, part in parts.items()]
    )
    if grain == "reference":
        reviewed = materialise(reviewed, "category_sales")
    grouped = reviewed.groupBy("category").agg(
        F.count("order_id").alias("orders"), *[F.sum(name).alias(name) for name in parts]
    )
    if grain == "reference":
        # The hash as a second key has both sides shuffled anew, which adaptive execution
        # needs in order to split an order with very many reviews.
        key = F.xxhash64("order_id").alias("order_hash")
        distinct_reviews = (
            reviewed.select("order_id", "category", key)
            .join(
                reviews.where("review_id IS NOT NULL").select("order_id", "review_id", key),
                ["order_hash", "order_id"],
            )
            .groupBy("category", "review_id").agg(_rows().alias("n"))
            .groupBy(F.col("category").alias("reviewed")).agg(_rows().alias("reviews"))
        )
        grouped = grouped.join(
            distinct_reviews, F.col("category").eqNullSafe(F.col("reviewed")), "left"
        )
    grouped = grouped.withColumn("reviews", F.coalesce("reviews", F.lit(0)))
    revenue, freight = amount(F.col("price_cents")), amount(F.col("freight_cents"))
    return (
        grouped
        .where("price_cents > 0")
        .select(
            "category",
            "orders",
            "items_sold",
            revenue.alias("revenue"),
            freight.alias("freight"),
            round_n(ratio(revenue, F.col("items_sold")), 2).alias("avg_unit_price"),
            percent(revenue, amount(whole_table_sum(F.col("price_cents")))).alias("pct_revenue"),
            "reviews",
            round_n(ratio(F.col("score_sum"), F.col("scores")), 2).alias("avg_review_score"),
        )
        .orderBy(F.desc("revenue"), F.asc_nulls_last("category"))
    )


def state_performance(rollup: DataFrame, homes: DataFrame | None = None) -> DataFrame:
    """Sales, delivery time and review scores per customer state.

    In the result an order counts once per item, review and address, which enter as weights:
    orders are totalled per customer before a customer meets their states in `homes`.  Only
    the ids of orders meet states, to be counted once in each.
    """
    days, items = F.col("days_to_deliver"), F.col("item_count")
    rows = items * _review_repeats()
    revenue = amount(F.col("price_cents"))
    sold = rollup.where((F.col("is_revenue_order") == 1) & items.isNotNull())
    place = [KEY] if homes is not None else [KEY, "customer_state"]
    sums = {
        "price_cents": cents(F.col("order_revenue")) * _review_repeats(),
        "days_sum": days * rows,
        "days_rows": F.when(days.isNotNull(), rows),
        "score_sum": F.col("review_score_sum") * items,
        "scores": F.col("review_scores") * items,
    }
    spent = sold.groupBy(*place).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    totals = _in_states(spent, homes).groupBy("customer_state").agg(
        *[F.sum(F.col(n) * F.col("address_rows")).alias(n) for n in sums]
    )
    pairs = _in_states(sold.select(*place, "order_id"), homes)
    return (
        _with_distinct(totals, pairs, "customer_state")
        .select(
            "customer_state",
            "orders",
            "customers",
            revenue.alias("revenue"),
            round_n(ratio(revenue, F.col("orders")), 2).alias("aov"),
            percent(revenue, amount(whole_table_sum(F.col("price_cents")))).alias("pct_revenue"),
            round_n(ratio(F.col("days_sum"), F.col("days_rows")), 1).alias("avg_delivery_days"),
            round_n(ratio(F.col("score_sum"), F.col("scores")), 2).alias("avg_review_score"),
        )
        .orderBy(F.desc_nulls_last("revenue"), "customer_state")
    )


def delivery_sla(orders: DataFrame) -> DataFrame:
    """Delivery times and on-time share per month.

    The exact median keeps one counter per distinct value; days are whole numbers
    from 0 to 200, so that is at most 201 counters per month.
    """
    return (
        orders.where(_delivered_in_time_range())
        .groupBy("order_month")
        .agg(
            _rows().alias("delivered_orders"),
            round_n(F.avg("days_to_deliver"), 2).alias("avg_delivery_days"),
            round_n(F.median("days_to_deliver"), 2).alias("median_delivery_days"),
            F.sum(_on_time()).alias("on_time_orders"),
            percent(F.sum(_on_time()), _rows()).alias("on_time_pct"),
            round_n(F.avg("days_to_ship"), 2).alias("avg_days_to_ship"),
            round_n(F.avg("days_vs_estimate"), 2).alias("avg_days_vs_estimate"),
        )
        .orderBy(F.asc_nulls_last("order_month"))
    )


def payment_mix(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Value and instalments per payment type.

    Payments move to their order once and are reduced to (order, type) there, before they
    join the orders; an order that is there several times enters as a weight.
    """
    installments = F.col("payment_installments")
    moved = payments.select(
        "order_id", "payment_type", "payment_installments",
        cents(F.col("payment_value")).alias("value_cents"),
    ).repartition("order_id")
    paid = moved.groupBy("order_id", "payment_type").agg(
        _rows().alias("payments"),
        F.sum("value_cents").alias("value_cents"),
        F.sum(installments).alias("installments"),
        F.count(installments).alias("with_installments"),
        F.sum(F.when(installments > 1, 1).otherwise(0)).alias("multi"),
    )
    value = amount(F.col("value_cents"))
    totals = ("payments", "value_cents", "installments", "with_installments", "multi")
    sales = orders.where("is_revenue_order = 1").groupBy("order_id").agg(
        _rows().alias("order_rows")
    )
    return (
        paid.join(sales, "order_id")
        .groupBy("payment_type")
        .agg(
            F.count("order_id").alias("orders"),
            *[F.sum(F.col(c) * F.col("order_rows")).alias(c) for c in totals],
        )
        .select(
            "payment_type",
            "orders",
            value.alias("value"),
            percent(value, amount(whole_table_sum(F.col("value_cents")))).alias("pct_value"),
            round_n(ratio(F.col("installments"), F.col("with_installments")), 2)
            .alias("avg_installments"),
            round_n(ratio(F.col("multi"), F.col("payments")), 4).alias("pct_multi_installment"),
        )
        .orderBy(F.desc_nulls_last("value"), F.asc_nulls_last("payment_type"))
    )


def repeat_purchase(profile: DataFrame) -> DataFrame:
    """Customers and revenue by number of orders: 1, 2, 3, 4 or more."""
    n, spent = F.col("frequency"), F.col("spent")
    bucket = (
        F.when(n == 1, "1 order").when(n == 2, "2 orders").when(n == 3, "3 orders")
        .otherwise("4+ orders")
    )
    return (
        profile.groupBy(bucket.alias("order_bucket"))
        .agg(
            _rows().alias("customers"),
            F.sum("monetary_cents").alias("spent"),
            F.count("monetary_cents").alias("spenders"),
        )
        .select(
            "order_bucket",
            "customers",
            percent(F.col("customers"), whole_table_sum(F.col("customers")))
            .alias("pct_customers"),
            amount(spent).alias("revenue"),
            percent(amount(spent), amount(whole_table_sum(spent))).alias("pct_revenue"),
            round_n(ratio(amount(spent), F.col("spenders")), 2).alias("avg_monetary"),
        )
        .orderBy("order_bucket")
    )


def delivery_bucket(days_early: Column) -> Column:
    week, some, none, few, more = DELIVERY_BUCKETS
    return (
        F.when(days_early.isNull(), NO_DELIVERY)
        .when(days_early >= 7, week)
        .when(days_early >= 3, some)
        .when(days_early >= 0, none)
        .when(days_early >= -3, few)
        .otherwise(more)
    )


def review_by_delay(summary: DataFrame) -> DataFrame:
    """Review scores of delivered orders by how early or late they came (C11)."""
    score, rows = F.col("avg_review_score"), times(summary)
    bad = F.sum(F.when(score <= 2, rows).otherwise(0))
    return (
        summary.where((F.col("order_status") == "delivered") & score.isNotNull())
        .groupBy(delivery_bucket(F.col("days_vs_estimate")).alias("delivery_bucket"))
        .agg(
            F.sum(rows).alias("orders"),
            round_n(_mean(score, rows), 3).alias("avg_review_score"),
            percent(bad, F.sum(rows)).alias("pct_bad_reviews"),
            F.min("days_vs_estimate").alias("earliest"),
        )
        .orderBy(F.desc_nulls_last("earliest"))
        .drop("earliest")
    )


def sla_by_state(rollup: DataFrame, homes: DataFrame | None = None) -> DataFrame:
    """Delivery time, on-time share and review score per customer state.

    Totalled per customer before a customer meets their states in `homes`.
    """
    rows = _review_repeats()
    sums = {
        "delivered_orders": rows,
        "days_sum": F.col("days_to_deliver") * rows,
        "on_time": _on_time() * rows,
        "score_sum": F.col("review_score_sum"),
        "scores": F.col("review_scores"),
    }
    delivered = rollup.where(_delivered_in_time_range()).groupBy(
        *([KEY] if homes is not None else [KEY, "customer_state"])
    ).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    return (
        _in_states(delivered, homes)
        .groupBy("customer_state")
        .agg(*[F.sum(F.col(n) * F.col("address_rows")).alias(n) for n in sums])
        .select(
            "customer_state",
            "delivered_orders",
            round_n(ratio(F.col("days_sum"), F.col("delivered_orders")), 2)
            .alias("avg_delivery_days"),
            percent(F.col("on_time"), F.col("delivered_orders")).alias("on_time_pct"),
            round_n(ratio(F.col("score_sum"), F.col("scores")), 2).alias("avg_review_score"),
        )
        .orderBy(F.desc("delivered_orders"), "customer_state")
    )
