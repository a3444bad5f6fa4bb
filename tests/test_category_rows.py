"""The category mart makes its rows per order and category once, for the sums and the reviews."""

import pytest

from vendlens.operators import marts
from vendlens.plans.marts import MARTS
from vendlens.plans.warehouse import store_star
from vendlens.sources.trade_tables import raw_tables


@pytest.fixture()
def whole_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_items_are_read_once(spark, small, tmp_path, whole_metadata):
    star = store_star(raw_tables(spark, small), str(tmp_path))
    plan = MARTS["mart_category"](star)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    # Both readers take the stored rows; items and products have been joined before.
    assert not any("/fact_order_items]" in s or "/dim_product]" in s for s in scans)
    assert sum("/category_sales]" in s for s in scans) == 2


@pytest.mark.parametrize("grain, expected", [
    # order 1 is there twice and has two reviews, one of which order 2 shares; order 3 no sale
    ("reference", {("books", 2, 5, 19.0, 2, 2.6), ("toys", 1, 8, 16.0, 2, 3.0),
                   (None, 1, 1, 1.0, 1, 1.0)}),
    ("order", {("books", 2, 3, 11.0, 5, 2.33), ("toys", 1, 4, 8.0, 4, 3.0),
               (None, 1, 1, 1.0, 1, 1.0)}),
])
def test_repeated_orders_and_shared_reviews(spark, grain, expected):
    orders = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 0), (None, 1)],
                                   "order_id long, is_revenue_order int")
    items = spark.createDataFrame(
        [(1, 100, 1.5, 0.5), (1, 100, 2.5, None), (1, 101, 4.0, 1.0), (2, 101, 3.0, 0.0),
         (2, 999, 1.0, 1.0), (3, 100, 9.0, 9.0), (None, 100, 5.0, 5.0)],
        "order_id long, product_id long, price double, freight_value double")
    products = spark.createDataFrame([(100, "toys"), (101, "books")],
                                     "product_id long, category string")
    reviews = spark.createDataFrame(
        [(1, 1, 5), (2, 1, 1), (2, 2, 1), (4, 3, 4), (None, None, 3)],
        "review_id long, order_id long, review_score int")
    mart = marts.category_performance(items, orders, products, reviews, grain)
    found = {(r.category, r.orders, r.items_sold, r.revenue, r.reviews, r.avg_review_score)
             for r in mart.collect()}
    assert found == expected
