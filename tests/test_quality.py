import pytest
from market import raw

from vendlens.operators.headline import headline_metrics
from vendlens.operators.quality import CHECKS, as_long_table, data_quality
from vendlens.plans.warehouse import star_schema


@pytest.fixture(scope="module")
def star(spark):
    return star_schema(raw(spark))


def test_checks(star):
    q = data_quality(star)
    assert q.columns == CHECKS
    assert q.first().asDict() == {
        "orders_total": 7,
        "orders_null_customer_key": 1,
        "orders_duplicate_order_id": 0,
        "items_orphan_order_id": 1,
        "payments_orphan_order_id": 1,
        "items_missing_product_id": 1,
        "items_negative_price": 2,
        "items_null_freight": 1,
        "products_null_category": 1,
        "customers_unique_ids": 5,
        "customers_with_multiple_order_ids": 1,
        "orders_missing_delivered_ts": 1,
        "delivered_after_estimate": 2,
        "revenue_item_based": 2 * 30.6 + 2 * 100 + 50 + 7 + 3,
        "revenue_payments_based": 30.6 + 3.1 + 110 + 55,
        "revenue_reconciliation_gap_pct": pytest.approx(100 * (198.7 - 321.2) / 321.2, abs=0.005),
    }


def test_duplicate_orders_are_counted_and_multiply_payments(spark):
    base = raw(spark)
    twice = raw(spark, orders=[*base_orders(), base_orders()[0]])
    q = data_quality(star_schema(twice)).first()
    assert base.orders.count() == 7 and q.orders_total == 8
    assert q.orders_duplicate_order_id == 1
    assert q.revenue_payments_based == pytest.approx(198.7 + 33.7)


def base_orders():
    from market import ORDERS

    return ORDERS


def test_long_table(star):
    got = {r["check"]: r["value"] for r in as_long_table(data_quality(star), CHECKS).collect()}
    assert list(got) == CHECKS and got["orders_total"] == 7.0


def test_headline(star):
    h = headline_metrics(star, top_customers=1).first()
    # u1's two orders count once per address
    assert (h.orders, h.unique_customers, h.revenue_brl) == (8, 3, 321.2)
    assert h.aov_brl == 40.15
    assert h.repeat_customer_pct == 50.0
    assert h.top8pct_customers_share_of_revenue == pytest.approx(100 * 261.2 / 321.2, abs=0.005)
    assert (h.period_start, h.period_end) == ("2017-01-05", "2017-05-01")
    assert h.cancellation_rate_pct == 11.11
    assert h.avg_delivery_days == 6.67
    assert h.avg_review_score == 3.0
