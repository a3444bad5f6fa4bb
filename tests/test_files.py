"""CSV in, CSV and JSON out."""

import json
from datetime import datetime
from glob import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vendlens.operators.quality import data_quality
from vendlens.plans.report import run_report
from vendlens.plans.warehouse import star_schema, store_csv, store_raw
from vendlens.session import materialise, scratch_root, scratch_space
from vendlens.sinks.files import export_csv, export_json, store_bucketed, store_table
from vendlens.sources.raw_csv import raw_tables as csv_tables
from vendlens.sources.raw_csv import REASON, REJECT, judged_csv, read_raw_csv, rejected_rows
from vendlens.sources.tables import read_raw, read_table
from vendlens.sources.trade_tables import raw_tables

FILES = {
    "x_orders_dataset.csv": """"order_id","customer_id","order_status","order_purchase_timestamp","order_approved_at","order_delivered_carrier_date","order_delivered_customer_date","order_estimated_delivery_date"
"a","c","delivered",2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00
"b","c","shipped",2017-10-03 10:56:33,,,,2017-10-18 00:00:00
"bad","c","shipped",not a time,,,,2017-10-18 00:00:00
""",
    "x_order_items_dataset.csv": """"order_id","order_item_id","product_id","seller_id","shipping_limit_date","price","freight_value"
"a",1,"p","s",2017-10-06 11:07:15,29.99,8.72
"b",1,"p","s",2017-10-06 11:07:15,free,8.72
"b",2
""",
    "x_order_payments_dataset.csv": """"order_id","payment_sequential","payment_type","payment_installments","payment_value"
"a",1,"credit_card",1,38.71
""",
    "x_order_reviews_dataset.csv": """"review_id","order_id","review_score","review_comment_title","review_comment_message","review_creation_date","review_answer_timestamp"
"r","a",4,,"two
lines, a comma and a ""quote\""",2017-10-11 00:00:00,2017-10-12 03:43:48
""",
    "x_customers_dataset.csv": """"customer_id","customer_unique_id","customer_zip_code_prefix","customer_city","customer_state"
"c","u","01151","sao paulo","SP"
""",
    "x_products_dataset.csv": """"product_id","product_category_name","product_name_lenght","product_description_lenght","product_photos_qty","product_weight_g","product_length_cm","product_height_cm","product_width_cm"
"p","beleza_saude",40,287,1,225,16,10,14
""",
    "x_sellers_dataset.csv": """"seller_id","seller_zip_code_prefix","seller_city","seller_state"
"s","13023","campinas","SP"
""",
    "product_category_name_translation.csv": "﻿product_category_name,product_category_name_english\r\nbeleza_saude,health_beauty",
}


@pytest.fixture()
def csv_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / name).write_text(text.replace('quote\\"', 'quote"'), encoding="utf-8")
    return str(folder)


def test_raw_csv(spark, csv_folder):
    raw = csv_tables(spark, csv_folder)
    orders = raw.orders.orderBy("order_id").collect()
    assert [o.order_id for o in orders] == ["a", "b"]  # the malformed row is dropped
    assert orders[0].order_purchase_timestamp == datetime(2017, 10, 2, 10, 56, 33)
    assert orders[1].order_approved_at is None
    # left out whatever columns a query asks for: a row with too few fields
    assert raw.items.count() == raw.items.select("order_id").count() == 2
    # a number that cannot be read is missing, its row stays
    assert sorted((i.order_id, i.price, i.freight_value) for i in raw.items.collect()) == [
        ("a", 29.99, 8.72), ("b", None, 8.72)]
    rejected = {r.table: (r.rows, r.rejected) for r in rejected_rows(spark, csv_folder).collect()}
    assert rejected["orders"] == (3, 1) and rejected["items"] == (3, 1)
    assert sum(n for name, (_, n) in rejected.items() if name not in ("orders", "items")) == 0
    review = raw.reviews.first()
    assert review.review_comment_message == 'two\nlines, a comma and a "quote"'
    assert review.review_answer_timestamp == datetime(2017, 10, 12, 3, 43, 48)
    assert raw.category_translation.columns[0] == "product_category_name"
    assert raw.category_translation.first().product_category_name_english == "health_beauty"
    assert raw.customers.first().customer_zip_code_prefix == 1151


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("extra,price,order_id\nx,1.5,7\n")
    assert read_raw_csv(spark, str(path)).dtypes == [
        ("extra", "string"), ("price", "double"), ("order_id", "string")]


def test_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,price,freight_value\na,1,2\n")
    (tmp_path / "b.csv").write_text("order_id,freight_value,price\nb,3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path / "*.csv")).collect()


def test_bad_prices_are_counted_by_the_checks(spark, csv_folder):
    checks = data_quality(star_schema(csv_tables(spark, csv_folder))).first()
    assert checks.items_negative_price == 1 and checks.items_null_freight == 0
    assert checks.items_orphan_order_id == 0


def test_exports_spell_out_numbers_and_keep_the_order(spark, tmp_path):
    rows = [(13443534.14, 1.5e-7), (1e7, 0.1), (123456789012.25, 2.0), (None, 5.0), (0.5, None)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(3)
    path = export_csv(df, str(tmp_path), "t", [F.desc_nulls_last("x")])
    lines = [line for p in parts(path) for line in open(p).read().split("\n")[1:-1]]
    assert lines == ["123456789012.25,2.0", "13443534.14,0.00000015", "10000000.0,0.1",
                     "0.5,", ",5.0"]
    sorted_mart = spark.range(1000).repartition(7)
    sorted_mart.write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    path = export_csv(stored, str(tmp_path), "sorted", [F.asc("id")])
    lines = [int(x) for p in parts(path) for x in open(p).read().split("\n")[1:-1]]
    assert lines == list(range(1000))


def test_report_from_csv(spark, csv_folder, tmp_path):
    raw = store_raw(csv_tables(spark, csv_folder), str(tmp_path / "stored"))
    assert read_raw(spark, str(tmp_path / "stored")).orders.count() == raw.orders.count() == 2
    written = run_report(raw, str(tmp_path / "out"))
    category = spark.read.option("header", True).csv(written["mart_category"]).collect()
    assert [(r.category, r.revenue) for r in category] == [("health_beauty", "29.99")]


EXPECTED = {
    "mart_monthly_kpi": "order_month,orders,customers,revenue,aov,revenue_per_customer,"
                        "items_sold,avg_delivery_days,avg_review_score",
    "mart_rfm": "customer_unique_id,first_order_date,last_order_date,as_of_date,recency_days,"
                "frequency,monetary,items_bought,r_score,f_score,m_score,rfm_cell,"
                "avg_order_value,is_repeat_customer",
    "mart_rfm_segments": "segment,customers,pct_customers,revenue,pct_revenue,avg_monetary,"
                         "avg_frequency,avg_recency_days",
    "mart_cohort": "cohort_month,cohort_size,month_offset,active_customers,retention_pct",
    "mart_pareto": "rk,customer_unique_id,monetary,cumulative_revenue,pct_customers,pct_revenue",
    "mart_category": "category,orders,items_sold,revenue,freight,avg_unit_price,pct_revenue,"
                     "reviews,avg_review_score",
    "mart_state": "customer_state,orders,customers,revenue,aov,pct_revenue,avg_delivery_days,"
                  "avg_review_score",
    "mart_delivery_sla": "order_month,delivered_orders,avg_delivery_days,median_delivery_days,"
                         "on_time_orders,on_time_pct,avg_days_to_ship,avg_days_vs_estimate",
    "mart_payment": "payment_type,orders,value,pct_value,avg_installments,pct_multi_installment",
    "mart_repeat": "order_bucket,customers,pct_customers,revenue,pct_revenue,avg_monetary",
    "mart_review_delay": "delivery_bucket,orders,avg_review_score,pct_bad_reviews",
    "mart_sla_by_state": "customer_state,delivered_orders,avg_delivery_days,on_time_pct,"
                         "avg_review_score",
    "mart_customer_segment": "customer_unique_id,first_order_date,last_order_date,as_of_date,"
                             "recency_days,frequency,monetary,items_bought,r_score,f_score,"
                             "m_score,avg_order_value,is_repeat_customer,rfm_cell,segment",
    "dim_date": "date_day,date_month,date_quarter,year,month,month_label,quarter_label,dow,doy",
    "fact_order_summary": "order_id,customer_unique_id,customer_state,order_status,"
                          "is_revenue_order,is_cancelled_order,order_date,order_month,"
                          "days_to_deliver,days_vs_estimate,item_count,seller_count,"
                          "order_revenue,order_freight,payment_value,avg_review_score",
}


def parts(folder, pattern="part-*"):
    return sorted(glob(f"{folder}/{pattern}"))


def test_full_report(spark, small, tmp_path):
    written = run_report(raw_tables(spark, small), str(tmp_path), "1996-01-01", 1, 10)
    for name, header in EXPECTED.items():
        for part in parts(written[name]):
            with open(part, encoding="utf-8") as f:
                assert f.readline().strip() == header, name
    documents = {}
    for name in ("data_quality", "headline_metrics", "findings"):
        lines = [line for p in parts(written[name]) for line in open(p, encoding="utf-8")]
        assert len(lines) == 1
        documents[name] = json.loads(lines[0])
    assert len(documents["data_quality"]) == 16 and len(documents["headline_metrics"]) == 11
    assert list(documents["findings"]) == [
        "trend", "cohort", "rfm", "pareto", "category", "state", "payment", "sla"]
    assert [len(v) for v in documents["findings"].values()] == [13, 4, 8, 3, 4, 6, 2, 10]
    assert set(documents["findings"]["pareto"]["concentration"]) == {"1", "5", "10", "20", "30", "50"}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a,b")], "x int, y double, z string").coalesce(1)
    text = [open(p).read() for p in parts(export_csv(df, str(tmp_path), "t"))]
    assert text == ['x,y,z\n1,,"a,b"\n']
    document = [open(p).read() for p in parts(export_json(df, str(tmp_path), "j"))]
    assert json.loads("".join(document)) == {"x": 1, "y": None, "z": "a,b"}


def test_scratch_folder_follows_the_session(spark):
    root = scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or root == configured.rstrip("/")
    stored = materialise(spark.range(5), "t")
    assert stored.count() == 5
    assert all(f.replace("file://", "").replace("file:", "").startswith(root.replace("file:", ""))
               for f in stored.inputFiles())


def test_scratch_space_is_removed(spark):
    def made():
        return glob(f"{scratch_root(spark).replace('file:', '')}/vendlens-*")

    before = made()
    with scratch_space(spark):
        assert materialise(spark.range(5), "t").count() == 5
        assert len(made()) == len(before) + 1
    assert made() == before


def test_a_session_without_shared_folder_is_refused():
    class Bare:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError):
        scratch_root(Bare)


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    folder = str(tmp_path)
    store_table(spark.range(5), folder, "t")
    bad = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id")
    )
    with pytest.raises(Exception, match="stop"):
        store_table(bad, folder, "t")
    assert read_table(spark, folder, "t").count() == 5
    # A table may be replaced by what is computed from it.
    again = store_table(read_table(spark, folder, "t").selectExpr("id + 1 AS id"), folder, "t")
    assert sorted(r.id for r in again.collect()) == [1, 2, 3, 4, 5]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_csv_is_stored_with_what_is_rejected(spark, csv_folder, tmp_path):
    tables, rejects = store_csv(spark, csv_folder, f"{tmp_path}/tables")
    lazy = csv_tables(spark, csv_folder)
    for name, df in tables.named().items():
        assert df.schema == getattr(lazy, name).schema
        rows = [sorted(map(str, t.collect())) for t in (
            df, getattr(lazy, name), getattr(read_raw(spark, f"{tmp_path}/tables"), name))]
        assert rows[0] == rows[1] == rows[2], name
    found = [(r.table, r.reason) for r in rejects.collect()]
    assert sorted(t for t, _ in found) == ["items", "orders"]
    assert all(r.text for r in rejects.collect())


def test_rejects_give_the_column_and_the_fields(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "order_id,shipping_limit_date,price\n"
        "a,2017-01-02 03:04:05,1\nb,soon,2\nc,,x\nd,2017-01-02\n"
    )
    rows = judged_csv(spark, f"{tmp_path}/t.csv").orderBy("order_id").collect()
    assert [(r.order_id, r[REASON]) for r in rows] == [
        ("a", None), ("b", "shipping_limit_date"), ("c", None), ("d", "fields")]
    assert [r[REJECT] for r in rows] == [None, "b,soon,2", None, "d,2017-01-02"]


def test_bucketed_table_is_replaced_by_its_next_version(spark, tmp_path):
    database, folder = "shelves", f"{tmp_path}/shelves"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/catalogue'")
    try:
        first = spark.range(100).withColumn("half", F.col("id") % 2)
        stored = store_bucketed(first, folder, "t", "id", 4, database)
        assert stored.count() == 100
        broken = first.withColumn("half", F.raise_error(F.lit("stop")).cast("long"))
        with pytest.raises(Exception, match="stop"):
            store_bucketed(broken, folder, "t", "id", 4, database)
        assert spark.table(f"{database}.t").count() == 100
        # The next version may be made from the one it replaces.
        grown = stored.unionAll(stored.selectExpr("id + 100", "half"))
        assert store_bucketed(grown, folder, "t", "id", 4, database).count() == 200
        assert spark.table(f"{database}.t").count() == 200
        assert len(list(Path(folder).iterdir())) == 1
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
