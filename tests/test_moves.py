"""How often rows are moved: items and payments once, to their order."""

import re

from pyspark.sql import functions as F

from vendlens.operators import marts
from vendlens.operators.facts import order_rollup

ORDERS = [(1, 10, 1), (1, 10, 1), (2, 11, 1), (3, 11, 0), (None, 12, 1), (4, None, 1)]
ITEMS = [
    (1, 100, 7, 1.5, 0.5), (1, 100, 7, 2.5, None), (1, 101, 8, 4.0, 1.0), (2, 101, None, 3.0, 0.0),
    (2, 999, 9, 1.0, 1.0), (3, 100, 7, 9.0, 9.0), (None, 100, 7, 5.0, 5.0), (4, None, 7, 2.0, 1.0),
]
PAYMENTS = [
    (1, "card", 2, 3.0), (1, "card", 1, 4.0), (1, None, None, 1.0), (2, "card", 3, None),
    (2, "slip", 1, 2.0), (3, "slip", 1, 9.0), (None, "card", 5, 7.0), (4, "slip", None, 1.25),
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _moved_by(df):
    """The columns by which the rows of `df` are moved, besides the order."""
    return set(re.findall(r"hashpartitioning\(order_id#\d+L?, (\w+)#", _plan(df)))


def _tables(spark):
    orders = spark.createDataFrame(
        ORDERS, "order_id long, customer_unique_id long, is_revenue_order int"
    )
    items = spark.createDataFrame(
        ITEMS, "order_id long, product_id long, seller_id long, price double, freight_value double"
    )
    payments = spark.createDataFrame(
        PAYMENTS, "order_id long, payment_type string, payment_installments int, "
        "payment_value double",
    )
    products = spark.createDataFrame([(100, "toys"), (101, "books")],
                                     "product_id long, category string")
    reviews = spark.createDataFrame([(1, 1, 5), (2, 1, 2), (3, 2, 4)],
                                    "review_id long, order_id long, review_score int")
    return orders, items, payments, products, reviews


def test_payments_are_moved_once(spark):
    orders, _, payments, _, _ = _tables(spark)
    mix = marts.payment_mix(payments, orders)
    assert "payment_type" not in _moved_by(mix)
    # An order that is there twice counts its payments twice and itself once.
    found = [(r.payment_type, r.orders, r.value, r.avg_installments) for r in mix.collect()]
    assert found == [("card", 2, 14.0, 1.8), ("slip", 2, 3.25, 1.0), (None, 1, 2.0, None)]


def test_items_are_moved_to_their_order_once(spark):
    orders, items, _, products, reviews = _tables(spark)
    category = marts.category_performance(items, orders, products, reviews)
    assert "category" not in _moved_by(category)
    found = [(r.category, r.orders, r.items_sold, r.revenue, r.reviews) for r in category.collect()]
    # Two rows of order 1 and two reviews: its items count four times.
    assert found == [("books", 2, 5, 19.0, 3), ("toys", 1, 8, 16.0, 2), (None, 2, 2, 3.0, 1)]


def test_sellers_are_counted_without_moving_items_twice(spark):
    orders, items, payments, _, reviews = _tables(spark)
    facts = orders.select(
        "*", F.lit("delivered").alias("order_status"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("order_date", "date"), ("order_month", "date"), ("order_purchase_ts", "timestamp_ntz"),
            ("delivered_ts", "timestamp_ntz"), ("estimated_delivery_date", "date"),
            ("days_to_deliver", "int"), ("days_vs_estimate", "int"),
            ("is_cancelled_order", "int"),
        )],
    )
    customers = spark.createDataFrame([(10, "A", 1, 1)], "customer_unique_id long, "
                                      "customer_state string, first_customer_id long, "
                                      "customer_zip_prefix int")
    rollup = order_rollup(facts, customers, items, payments, reviews)
    counted = rollup.select("order_id", "item_count", "seller_count")
    assert "seller_id" not in _moved_by(counted)
    assert rollup.schema["seller_count"].dataType.simpleString() == "bigint"
    found = {tuple(r) for r in counted.collect()}
    assert found == {(1, 3, 2), (2, 2, 1), (3, 1, 1), (4, 1, 1), (None, None, None)}
