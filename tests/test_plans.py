"""Filters and columns reach the scan."""

import pytest


@pytest.fixture()
def whole_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_and_columns_reach_the_scan(spark, small, tmp_path, whole_metadata):
    from vendlens.plans.marts import MARTS
    from vendlens.plans.warehouse import store_star
    from vendlens.sources.trade_tables import raw_tables

    star = store_star(raw_tables(spark, small), str(tmp_path))
    plan = MARTS["mart_state"](star)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_revenue_order,1)" in plan and "IsNotNull(item_count)" in plan
    # Only the counts per state are joined.
    assert "order_freight" not in plan and "SortMergeJoin" not in plan
    plan = MARTS["mart_delivery_sla"](star)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in plan
    assert "GreaterThanOrEqual(days_to_deliver,0)" in plan and "hours_to_approve" not in plan


def test_marts_do_not_multiply_rows_and_read_the_cohort_mart_once(spark, small, tmp_path):
    from vendlens.operators.findings import cohort_matrix
    from vendlens.plans.marts import MARTS
    from vendlens.plans.warehouse import store_star
    from vendlens.sources.trade_tables import raw_tables

    star = store_star(raw_tables(spark, small), str(tmp_path))
    for name in ("mart_monthly_kpi", "mart_state", "mart_category"):
        plan = MARTS[name](star)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "Generate" not in plan, name
    cohort = MARTS["mart_cohort"](star)
    cohort.write.parquet(f"{tmp_path}/cohort")
    matrix = cohort_matrix(spark.read.parquet(f"{tmp_path}/cohort"))
    assert matrix._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_facts_in_buckets_of_their_order_are_joined_without_a_shuffle(spark, small, tmp_path):
    from vendlens.plans.warehouse import by_order, store_facts
    from vendlens.sources.trade_tables import raw_tables

    def shuffles_by_order(star):
        plan = star.order_rollup._jdf.queryExecution().executedPlan().toString()
        return plan.count("hashpartitioning(order_id")

    spark.sql(f"CREATE DATABASE stars LOCATION '{tmp_path}/catalogue'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = raw_tables(spark, small)
        plain = store_facts(raw, f"{tmp_path}/plain")
        cut = store_facts(raw, f"{tmp_path}/cut", store=by_order(16, "stars"))
        assert shuffles_by_order(plain) >= 3 and shuffles_by_order(cut) == 0
        rows = [sorted(map(str, star.order_rollup.collect())) for star in (plain, cut)]
        assert rows[0] == rows[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE stars CASCADE")


def test_checks_and_headline_read_each_fact_once(spark, small, tmp_path):
    from vendlens.operators.headline import headline_metrics
    from vendlens.operators.quality import data_quality
    from vendlens.plans.report import store_profile
    from vendlens.plans.warehouse import star_schema, store_star
    from vendlens.sources.trade_tables import raw_tables

    def reads(df, table):
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
        return sum("FileScan" in line and f"/{table}]" in line for line in plan)

    star = store_star(raw_tables(spark, small), str(tmp_path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        checks = data_quality(star)
        for table in ("fact_orders", "fact_order_items", "fact_payments", "order_rollup"):
            assert reads(checks, table) == 1, table
        report = headline_metrics(star, 100, store_profile(star, str(tmp_path)))
        for table in ("order_rollup", "customer_profile", "fact_reviews"):
            assert reads(report, table) == 1, table
        assert reads(report, "fact_orders") == 0
        # On a lazy star the reviews alone are read again, for the scores of all of them; the
        # spending has been put in order before.
        raw = raw_tables(spark, small)
        report = headline_metrics(star_schema(raw), 100)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{small}/") == 1 and plan.count("/rollup]") == 2
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
