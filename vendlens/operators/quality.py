"""Data-quality checks (D1-D16): counts of suspicious rows, and whether revenue adds up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendlens.functions.columns import amount, as_row, cents, percent
from vendlens.operators.rfm import KEY
from vendlens.schemas import Star

# The checks, in report order, and whether they are amounts.
CHECKS = [
    "orders_total",
    "orders_null_customer_key",
    "orders_duplicate_order_id",
    "items_orphan_order_id",
    "payments_orphan_order_id",
    "items_missing_product_id",
    "items_negative_price",
    "items_null_freight",
    "products_null_category",
    "customers_unique_ids",
    "customers_with_multiple_order_ids",
    "orders_missing_delivered_ts",
    "delivered_after_estimate",
    "revenue_item_based",
    "revenue_payments_based",
    "revenue_reconciliation_gap_pct",
]
AMOUNTS = {"revenue_item_based", "revenue_payments_based", "revenue_reconciliation_gap_pct"}


def _order_flags() -> dict[str, Column]:
    """The checks that look at one row of the orders."""
    return {
        "orders_null_customer_key": F.col(KEY).isNull(),
        "orders_missing_delivered_ts":
            (F.col("order_status") == "delivered") & F.col("delivered_ts").isNull(),
        "delivered_after_estimate": F.col("days_vs_estimate") < 0,
    }


def _item_flags() -> dict[str, Column]:
    """The checks that look at one row of the items."""
    price = F.col("price")
    return {
        "items_missing_product_id": F.col("product_id").isNull(),
        "items_negative_price": price.isNull() | (price < 0),
        "items_null_freight": F.col("freight_value").isNull(),
    }


def _order_ledger(star: Star) -> DataFrame:
    """What each order id occurs with, in one row per id.

    Orders, items and payments meet in one aggregation instead of one join per
    check, and bring the checks of their own rows along, so each is read once.  Each
    is summed up before the shuffle, so an id that holds a third of the items is
    one row per task.
    """
    orders, items = _order_flags(), _item_flags()
    columns = (
        "orders", "revenue_orders", "items", "payments", "paid_cents", *orders, *items
    )

    def part(df: DataFrame, **values: Column) -> DataFrame:
        return df.select("order_id", *[
            values.get(c, F.lit(0)).cast("bigint").alias(c) for c in columns
        ])

    def counts(flags: dict[str, Column]) -> dict[str, Column]:
        return {name: F.when(flag, 1).otherwise(0) for name, flag in flags.items()}

    one = F.lit(1)
    parts = [
        part(star.fact_orders, orders=one, revenue_orders=F.col("is_revenue_order"),
             **counts(orders)),
        part(star.fact_order_items, items=one, **counts(items)),
        part(star.fact_payments, payments=one, paid_cents=cents(F.col("payment_value"))),
    ]
    return reduce(DataFrame.unionAll, parts).groupBy("order_id").agg(
        *[F.sum(c).alias(c) for c in columns]
    )


def _order_checks(star: Star) -> DataFrame:
    known = (F.col("orders") > 0) & F.col("order_id").isNotNull()
    counted = F.when(known, F.col("orders")).otherwise(0)
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*_order_flags(), *_item_flags())]
    return _order_ledger(star).agg(
        F.sum("orders").alias("orders_total"),
        (F.sum("orders") - F.count_if(known)).alias("orders_duplicate_order_id"),
        F.sum(F.when(counted == 0, F.col("items")).otherwise(0)).alias("items_orphan_order_id"),
        F.sum(F.when(counted == 0, F.col("payments")).otherwise(0))
        .alias("payments_orphan_order_id"),
        amount(F.sum(F.when(known & (F.col("revenue_orders") > 0),
                            F.col("paid_cents") * F.col("revenue_orders"))))
        .alias("revenue_payments_based"),
        *totals,
    )


def data_quality(star: Star) -> DataFrame:
    """All checks as one row: each fact is read once, whatever the number of checks."""
    parts = [
        _order_checks(star),
        star.dim_product.agg(
            F.count_if(F.col("category") == "uncategorised").alias("products_null_category")
        ),
        star.dim_customer.agg(
            F.count(F.lit(1)).alias("customers_unique_ids"),
            F.count_if(F.col("customer_id_count") > 1).alias("customers_with_multiple_order_ids"),
        ),
        star.order_rollup.where("is_revenue_order = 1").agg(
            amount(F.sum(cents(F.col("order_revenue")) * F.col("address_rows")))
            .alias("revenue_item_based")
        ),
    ]
    one_row = star.fact_orders.sparkSession.range(1)
    rows = one_row.select(*[as_row(p).alias(f"p{i}") for i, p in enumerate(parts)])
    checks = rows.select(*[f"p{i}.*" for i in range(len(parts))])
    item, paid = F.col("revenue_item_based"), F.col("revenue_payments_based")
    return checks.withColumn(
        "revenue_reconciliation_gap_pct", percent(paid - item, item)
    ).select(*CHECKS)


def as_long_table(one_row: DataFrame, names: list[str]) -> DataFrame:
    """One row of checks as (check, value) rows."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(n).cast("double").alias("value")) for n in names
    ])
    return one_row.select(F.inline(pairs))
