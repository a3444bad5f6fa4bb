"""The mart catalogue: name -> DataFrame over a star."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendlens.operators import marts as m
from vendlens.operators import rfm
from vendlens.operators.marts import DELIVERY_BUCKETS
from vendlens.schemas import Star


def rfm_base(star: Star) -> DataFrame:
    return rfm.rfm_tiered(rfm.customer_profile(star.order_rollup))


def customer_segment(star: Star) -> DataFrame:
    return rfm.customer_segments(rfm_base(star))


MARTS: dict[str, Callable[[Star], DataFrame]] = {
    "mart_monthly_kpi": lambda s: m.monthly_kpi(s.order_rollup),
    "mart_rfm": lambda s: rfm.rfm_ntile(rfm.customer_profile(s.order_rollup)),
    "mart_rfm_segments": lambda s: rfm.segment_rollup(customer_segment(s)),
    "mart_cohort": lambda s: m.cohort_retention(s.fact_orders),
    "mart_pareto": lambda s: m.pareto(rfm.customer_profile(s.order_rollup)),
    "mart_category": lambda s: m.category_performance(
        s.fact_order_items, s.fact_orders, s.dim_product, s.fact_reviews, s.grain
    ),
    "mart_state": lambda s: m.state_performance(s.order_rollup, s.home_states),
    "mart_delivery_sla": lambda s: m.delivery_sla(s.fact_orders),
    "mart_payment": lambda s: m.payment_mix(s.fact_payments, s.fact_orders),
    "mart_repeat": lambda s: m.repeat_purchase(rfm.customer_profile(s.order_rollup)),
    "mart_review_delay": lambda s: m.review_by_delay(s.order_rollup),
    "mart_sla_by_state": lambda s: m.sla_by_state(s.order_rollup, s.home_states),
    "mart_customer_segment": customer_segment,
    "dim_date": lambda s: s.dim_date.orderBy("date_day"),
    "fact_order_summary": lambda s: s.fact_order_summary,
}


def mart_order(name: str) -> list[Column] | None:
    """How an exported mart is sorted; None for tables without an order of their own."""
    return _orders().get(name)


def _orders() -> dict[str, list[Column]]:
    return {
        "mart_monthly_kpi": [F.asc_nulls_last("order_month")],
        "mart_rfm_segments": [F.desc_nulls_last("revenue"), F.asc("segment")],
        "mart_cohort": [F.asc("cohort_month"), F.asc("month_offset")],
        "mart_pareto": [F.asc("rk")],
        "mart_category": [F.desc("revenue"), F.asc_nulls_last("category")],
        "mart_state": [F.desc_nulls_last("revenue"), F.asc("customer_state")],
        "mart_delivery_sla": [F.asc_nulls_last("order_month")],
        "mart_payment": [F.desc_nulls_last("value"), F.asc_nulls_last("payment_type")],
        "mart_repeat": [F.asc("order_bucket")],
        "mart_review_delay": [
            F.asc(F.coalesce(
                F.nullif(F.array_position(
                    F.array(*[F.lit(b) for b in DELIVERY_BUCKETS]), F.col("delivery_bucket")
                ), F.lit(0)), F.lit(len(DELIVERY_BUCKETS) + 1)
            )),
        ],
        "mart_sla_by_state": [F.desc("delivered_orders"), F.asc("customer_state")],
        "dim_date": [F.asc("date_day")],
    }
