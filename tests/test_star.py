from datetime import date

import pytest
from market import ITEMS, ORDERS, raw, rows

from vendlens.plans.warehouse import star_schema, store_star
from vendlens.sources.tables import read_star, read_table


@pytest.fixture(scope="module")
def star(spark):
    return star_schema(raw(spark))


def test_customers_have_one_row_per_address(star):
    dim = rows(star.dim_customer, "customer_unique_id", "customer_zip_prefix")
    assert len(dim) == 5
    assert dim["u1", 1000]["customer_state"] == "SP"
    # ' mg ' and 'MG' are one state: two ids, one row
    assert dim["u3", 3000]["customer_id_count"] == 2
    assert dim["u3", 3000]["first_customer_id"] == "c3"
    assert dim["u5", 5000]["customer_state"] is None


def test_products(star):
    dim = rows(star.dim_product, "product_id")
    assert [dim[p]["category"] for p in ("p1", "p2", "p3", "p4")] == [
        "beauty", "moveis", "vazio", "uncategorised"]
    assert dim["p1"]["product_volume_cm3"] == 60.0
    assert dim["p2"]["product_volume_cm3"] == 3.5  # 3.4875
    assert dim["p3"]["product_volume_cm3"] is None


def test_sellers(star):
    assert {k: v["seller_state"] for k, v in rows(star.dim_seller, "seller_id").items()} == {
        "s1": "SP", "s2": "RJ"}


def test_calendar_has_every_day(star):
    days = rows(star.dim_date, "date_day")
    assert len(days) == 117 and min(days) == date(2017, 1, 5) and max(days) == date(2017, 5, 1)
    sunday = days[date(2017, 4, 2)]
    assert (sunday["dow"], sunday["doy"], sunday["month_label"], sunday["quarter_label"]) == (
        0, 92, "Apr-17", "2017-Q2")
    assert sunday["date_quarter"] == date(2017, 4, 1)


def test_orders(star):
    o = rows(star.fact_orders, "order_id")
    assert o["o1"]["hours_to_approve"] == 1 / 60  # one boundary in two seconds
    assert o["o2"]["hours_to_approve"] == 1 / 60 and o["o2"]["days_to_ship"] == 2
    assert (o["o1"]["days_to_deliver"], o["o1"]["days_vs_estimate"]) == (5, 8)
    assert o["o2"]["days_vs_estimate"] == -1
    assert o["o3"]["days_to_deliver"] is None and o["o3"]["hours_to_approve"] is None
    assert o["o7"]["customer_unique_id"] is None
    assert [o[k]["is_revenue_order"] for k in ("o1", "o3", "o4")] == [1, 1, 0]
    assert [o[k]["is_cancelled_order"] for k in ("o1", "o3", "o4")] == [0, 0, 1]
    assert o["o2"]["order_month"] == date(2017, 2, 1)


def test_amounts_that_are_no_number_become_null(star):
    items = rows(star.fact_order_items, "order_id", "order_item_id")
    assert items["o3", 2]["price"] is None and items["o3", 2]["revenue"] is None
    assert items["o1", 1]["revenue"] == 11.1
    assert items["o5", 1]["freight_value"] is None


def test_review_answer_time(star):
    got = {(r.review_id, r.order_id): r.days_to_answer_review for r in star.fact_reviews.collect()}
    assert got["r1", "o1"] == 0.0 and got["r2", "o1"] == 25 / 24
    assert got["r5", "o5"] is None


def test_summary_repeats_an_order_per_address(star):
    summary = star.fact_order_summary.collect()
    assert sorted(r.order_id for r in summary) == sorted(
        ["o1", "o1", "o2", "o2", "o3", "o4", "o5", "o6", "o7"])
    assert {r.customer_state for r in summary if r.order_id == "o1"} == {"SP", "RJ"}
    by = {r.order_id: r for r in summary}
    assert (by["o1"].item_count, by["o1"].seller_count, by["o1"].order_revenue) == (3, 2, 30.6)
    assert by["o1"].avg_review_score == 4.5 and by["o1"].payment_value == 33.7
    assert by["o3"].order_revenue == 50.0 and by["o3"].item_count == 2
    assert by["o6"].item_count is None and by["o6"].order_revenue is None
    assert by["o6"].payment_value == 0.0 and by["o6"].avg_review_score is None
    assert by["o5"].avg_review_score is None and by["o5"].order_freight is None


def test_order_grain_has_one_row_per_order(spark):
    summary = rows(star_schema(raw(spark), "order").fact_order_summary, "order_id")
    assert len(summary) == len(ORDERS)
    assert summary["o1"]["customer_state"] == summary["o2"]["customer_state"] == "SP"


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        star_schema(raw(spark), "item")


def test_unused_sides_are_not_read(star):
    plan = star.fact_order_summary.select("order_id", "customer_state")._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "payment_value" not in text and "review_score" not in text and "price" not in text


def test_stored_star_equals_the_lazy_one(spark, star, tmp_path):
    store_star(raw(spark), str(tmp_path))
    again = read_star(spark, str(tmp_path))
    for name, df in star.named().items():
        assert again.named()[name].exceptAll(df).count() == 0, name
        assert again.named()[name].count() == df.count(), name
    assert read_table(spark, str(tmp_path), "fact_order_items").count() == len(ITEMS)


def test_empty_inputs(spark):
    empty = raw(spark, [], [], [], [], [])
    star = star_schema(empty)
    assert star.fact_order_summary.count() == 0
    assert star.dim_date.count() == 0
