"""Marts, checks and headline numbers against DuckDB on skewed and dirty tables.

A third of the orders belong to one customer, a third of the items to one order and to
one product; some customers, orders and products are missing; the first orders come twice.
"""

import duckdb
import pytest
from compare import database, differences

import __spark_entry__ as entry

CHANGES = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 WHEN o_orderkey % 41 = 0 "
              "THEN 999999 ELSE o_custkey END AS o_custkey) FROM src WHERE o_orderkey % 17 <> 0 "
              "UNION ALL SELECT * FROM src WHERE o_orderkey IN (1, 4)",
    "lineitem": "SELECT * REPLACE (CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN 7 "
                "ELSE l_orderkey END AS l_orderkey, CASE WHEN l_suppkey % 3 = 0 THEN 11 "
                "WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_partkey END AS l_partkey) FROM src",
    "part": "SELECT * FROM src WHERE p_partkey % 13 <> 0",
    "customer": "SELECT * FROM src",
    "supplier": "SELECT * FROM src",
    "nation": "SELECT * FROM src",
}
NAMES = [
    "fact_orders", "fact_order_summary", "fact_order_summary_order_grain", "mart_rfm_base",
    "mart_customer_segment", "mart_monthly_kpi", "mart_rfm", "mart_rfm_segments", "mart_cohort",
    "mart_pareto", "mart_category", "mart_state", "mart_state_order_grain", "mart_delivery_sla",
    "mart_payment", "mart_repeat", "mart_review_delay", "mart_sla_by_state", "dq_checks",
    "headline_metrics", "late_review_test",
]


@pytest.fixture(scope="module")
def dirty(tmp_path_factory, small):
    folder = str(tmp_path_factory.mktemp("dirty"))
    for table, change in CHANGES.items():
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW src AS SELECT * FROM '{small}/{table}.parquet'")
        connection.execute(f"COPY ({change}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, dirty, name):
    df = entry.queries()[name](spark, dirty)
    assert differences(df, database(dirty), entry.oracle_sql()[name]) is None
