
from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from oracle import sql as oracle  # noqa: E402
from vendlens.functions.columns import plain_text, round_n  # noqa: E402
from vendlens.operators import datasets, findings, headline, quality  # noqa: E402
from vendlens.operators import marts as m  # noqa: E402
from vendlens.plans import marts as catalogue  # noqa: E402
from vendlens.plans.marts import MARTS, mart_order  # noqa: E402
from vendlens.plans.report import store_marts, store_profile  # noqa: E402
from vendlens.plans.warehouse import (  # noqa: E402
    by_order,
    star_schema,
    store_csv,
    store_facts,
    store_raw,
    store_star,
)
from vendlens.schemas import RAW_FILES, Star  # noqa: E402
from vendlens.sinks.files import export_csv, export_json  # noqa: E402
from vendlens.sources.raw_csv import raw_tables as csv_tables  # noqa: E402
from vendlens.sources.tables import read_raw, read_table  # noqa: E402
from vendlens.sources.trade_tables import raw_tables  # noqa: E402
from vendlens.session import scratch_folder, use_own_scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# Parameters that fit the test tables: their dates, their number of customers.
WINDOW_START = "1996-01-01"
MIN_COHORT = oracle.MIN_COHORT

Query = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, folder: str, grain: str = "reference") -> Star:
    return star_schema(raw_tables(spark, folder), grain)


def _on_star(build: Callable[[Star], DataFrame], grain: str = "reference") -> Query:
    return lambda spark, folder: build(_star(spark, folder, grain))


def _on_marts(build: Callable[..., DataFrame], *names: str, **options) -> Query:
    """A query over marts, built from the raw tables up."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        star = _star(spark, folder)
        return build(*[MARTS[n](star) for n in names], **options)

    return run


def _correlation(state: DataFrame) -> DataFrame:
    return findings.delivery_review_correlation(state).select(round_n(F.col("r"), 6).alias("r"), "n")


def _findings(spark: SparkSession, folder: str) -> DataFrame:
    """Stores star and marts first, as every section reads several of them."""
    target = scratch_folder(spark)
    star = store_star(raw_tables(spark, folder), target)
    marts = store_marts(star, store_profile(star, target), target)
    summary = read_table(spark, target, "fact_order_summary")
    return findings.findings_document(marts, summary, WINDOW_START, MIN_COHORT)


def _findings_from_json(spark: SparkSession, folder: str) -> DataFrame:
    """The findings document, exported as JSON and read back."""
    document = _findings(spark, folder)
    path = export_json(document, scratch_folder(spark), "findings")
    # Keys of JSON objects are text.
    written = document.schema.simpleString().replace("map<int,", "map<string,")
    read = spark.read.schema(T.DataType.fromDDL(written)).json(path)
    marks = F.transform_keys("pareto.concentration", lambda key, _: key.cast("int"))
    return _findings_rows(
        read.withColumn("pareto", F.col("pareto").withField("concentration", marks))
    )


def _findings_document(spark: SparkSession, folder: str) -> DataFrame:
    return _findings_rows(_findings(spark, folder))


def _findings_rows(document: DataFrame) -> DataFrame:
    """The whole findings document as (section, field, text) rows."""

    def row(section: str, field: str, text) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(field).alias("field"),
                        text.alias("text"))

    fields = []
    for section in document.schema:
        for field in section.dataType:
            value = F.col(section.name)[field.name]
            if isinstance(field.dataType, T.DoubleType):
                # As the SQL spells what is no number.
                text = F.when(F.isnan(value), "nan").otherwise(plain_text(value))
                fields.append(row(section.name, field.name, text))
            elif not isinstance(field.dataType, (T.MapType, T.ArrayType)):
                fields.append(row(section.name, field.name, value.cast("string")))
    marks = [
        row("pareto", f"concentration_{p}", plain_text(F.col("pareto.concentration")[p]))
        for p in findings.PARETO_MARKS
    ]
    segments = F.flatten(F.transform("rfm.segments_table", lambda s: F.array(*[
        F.struct(F.lit("rfm").alias("section"),
                 F.concat(F.lit("segments_table: "), s["segment"], F.lit(f": {c}")).alias("field"),
                 s[c].alias("text"))
        for c in findings.SEGMENT_COLUMNS
    ])))
    return document.select(F.inline(F.concat(F.array(*fields, *marks), segments)))


def _findings_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Every number of the findings document as (section, metric, value) rows."""
    document = _findings(spark, folder)

    def row(section: str, metric: str, value) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"))

    numbers = [
        row(section.name, field.name, F.col(section.name)[field.name])
        for section in document.schema for field in section.dataType
        if isinstance(field.dataType, T.NumericType)
    ]
    marks = [
        row("pareto", f"concentration_{p}", F.col("pareto.concentration")[p])
        for p in findings.PARETO_MARKS
    ]
    return document.select(F.inline(F.array(*numbers, *marks)))


def _from_csv(table: str) -> Query:
    """Write all eight raw tables as CSV, read them back as raw files, build `table` on them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        target, raw = scratch_folder(spark), raw_tables(spark, folder)
        for name, df in raw.named().items():
            export_csv(df, target, RAW_FILES[name].strip("*").removesuffix(".csv"))
        read = getattr(star_schema(csv_tables(spark, target)), table)
        # Ids are text in the files and numbers in the test tables.
        schema = getattr(star_schema(raw), table).schema
        return read.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in read.columns])

    return run


def _mart_csv_round_trip(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        mart = MARTS[name](_star(spark, folder))
        path = export_csv(mart, scratch_folder(spark), name, mart_order(name))
        return spark.read.schema(mart.schema).option("header", True).csv(path)

    return run


def _json_round_trip(build: Callable[[Star], DataFrame], names: list[str]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        report = build(_star(spark, folder))
        path = export_json(report, scratch_folder(spark), "report")
        return quality.as_long_table(spark.read.schema(report.schema).json(path), names)

    return run


def _csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """(table, reason, rows): raw tables as CSV, some rows spoilt, parsed and stored once.

    Every seventh order has an unreadable time of purchase, every eleventh an unreadable promise;
    the rows that can be used are counted under the reason "usable".
    """
    target, raw = scratch_folder(spark), raw_tables(spark, folder).named()
    key = F.col("order_id")
    for column, by in (("order_purchase_timestamp", 7), ("order_estimated_delivery_date", 11)):
        spoilt = F.when(key % by == 0, "32/13/1995").otherwise(F.col(column).cast("string"))
        raw["orders"] = raw["orders"].withColumn(column, spoilt)
    for name, df in raw.items():
        export_csv(df, target, RAW_FILES[name].strip("*").removesuffix(".csv"))
    tables, rejects = store_csv(spark, target, f"{target}/stored")
    usable = [
        df.agg(F.lit(name).alias("table"), F.lit("usable").alias("reason"),
               F.count(F.lit(1)).alias("rows"))
        for name, df in tables.named().items()
    ]
    counts = rejects.groupBy("table", "reason").agg(F.count("text").alias("rows"))
    return reduce(DataFrame.unionAll, usable, counts)


def _kpi_by_order(spark: SparkSession, folder: str) -> DataFrame:
    """Store the facts in buckets of their order, and build the monthly KPIs on them."""
    target = scratch_folder(spark)
    # Tables of the catalogue are the session's, so each call has names of its own.
    database = f"vendlens_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{target}/catalogue'")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    star = store_facts(raw_tables(spark, folder), target, store=by_order(buckets, database))
    return MARTS["mart_monthly_kpi"](star)


def _headline_period(spark: SparkSession, folder: str) -> DataFrame:
    """The two dates of the headline report, exported as JSON and read back."""
    report = _headline(_star(spark, folder))
    path = export_json(report, scratch_folder(spark), "report")
    return spark.read.schema(report.schema).json(path).select("period_start", "period_end")


def _headline(star: Star) -> DataFrame:
    return headline.headline_metrics(star, oracle.TOP_CUSTOMERS)


def _raw_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Store the raw tables, read them back, and build the category mart on them."""
    target = scratch_folder(spark)
    store_raw(raw_tables(spark, folder), target)
    return MARTS["mart_category"](star_schema(read_raw(spark, target)))


def _kpi_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Store the whole star, read one table back by name, and build a mart on it."""
    target = scratch_folder(spark)
    store_star(raw_tables(spark, folder), target)
    return m.monthly_kpi(read_table(spark, target, "fact_order_summary"))


def entry(spark: SparkSession) -> DataFrame:
    """Monthly KPIs on the smallest test tables."""
    return queries()["mart_monthly_kpi"](spark, SMALL)


def _training_data():
    """The queries on training data, or None where that subpackage is not installed."""
    try:
        from vendlens.llm import queries as training
    except ImportError:  # the subpackage, or a library that only it needs
        return None
    return training


def queries() -> dict[str, Query]:
    """Every operator, as (spark, folder) -> DataFrame over the tables of the folder."""
    training = _training_data()
    known = library_queries() | (training.QUERIES if training else {})
    return {name: _with_scratch(query) for name, query in known.items()}


def _with_scratch(query: Query) -> Query:
    """A local session without a shared folder gets its own, as tests and trials have none."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        use_own_scratch(spark)
        return query(spark, folder)

    return run


def library_queries() -> dict[str, Query]:
    """The operators on the marketplace."""
    kpi, cohort, segments = "mart_monthly_kpi", "mart_cohort", "mart_rfm_segments"
    state, category, sla = "mart_state", "mart_category", "mart_delivery_sla"
    dimensions_and_facts = [
        "dim_customer", "dim_product", "dim_seller", "fact_orders", "fact_order_items",
        "fact_payments", "fact_reviews",
    ]
    result: dict[str, Query] = {
        name: _on_star(lambda s, name=name: getattr(s, name)) for name in dimensions_and_facts
    }
    result |= {name: _on_star(build) for name, build in MARTS.items()}
    result |= {
        "fact_order_summary_order_grain": _on_star(MARTS["fact_order_summary"], "order"),
        "mart_rfm_base": _on_star(catalogue.rfm_base),
        "mart_category_order_grain": _on_star(MARTS["mart_category"], "order"),
        "mart_state_order_grain": _on_star(MARTS["mart_state"], "order"),
        "mart_sla_by_state_order_grain": _on_star(MARTS["mart_sla_by_state"], "order"),
        "dq_checks": _on_star(
            lambda s: quality.as_long_table(quality.data_quality(s), quality.CHECKS)
        ),
        "headline_metrics": _on_star(
            lambda s: headline.headline_metrics(s, oracle.TOP_CUSTOMERS)
        ),
        # findings
        "analysis_window": _on_marts(findings.analysis_window, kpi, window_start=WINDOW_START),
        "month_on_month": _on_marts(findings.month_on_month, kpi, window_start=WINDOW_START),
        "trend_summary": _on_marts(findings.trend_summary, kpi, window_start=WINDOW_START),
        "cohort_matrix": _on_marts(findings.cohort_matrix, cohort),
        "cohort_matrix_all": _on_marts(
            findings.cohort_matrix, cohort, max_offset=24, mature_only=False
        ),
        "cohort_summary": _on_marts(findings.cohort_summary, cohort, min_cohort=MIN_COHORT),
        "segment_summary": _on_marts(findings.segment_summary, segments),
        "segment_table": _on_marts(
            lambda s: findings.segment_table(s).select(F.inline("segments_table")),
            segments,
        ),
        "pareto_marks": _on_marts(findings.pareto_marks, "mart_pareto"),
        "pareto_marks_truncated": _on_marts(
            findings.pareto_marks, "mart_pareto", marks=(1, 5, 10, 20, 50), truncate=True
        ),
        "repeat_summary": _on_marts(findings.repeat_summary, "mart_repeat"),
        "category_summary": _on_marts(findings.category_summary, category),
        "state_summary": _on_marts(findings.state_summary, state),
        "delivery_review_correlation": _on_marts(_correlation, state),
        "delivery_review_test": _on_marts(findings.delivery_review_test, state),
        "payment_summary": _on_marts(findings.payment_summary, "mart_payment"),
        "late_review_welch": _on_marts(
            findings.late_review_test, "fact_order_summary", with_p=False
        ),
        "late_review_test": _on_marts(findings.late_review_test, "fact_order_summary"),
        "sla_summary": _on_marts(
            findings.sla_summary, sla, "mart_review_delay", window_start=WINDOW_START
        ),
        "findings_document": _findings_document,
        "findings_numbers": _findings_numbers,
        # chart and dashboard data
        "data_monthly_trend": _on_marts(datasets.monthly_trend, kpi, window_start=WINDOW_START),
        "data_cohort_heatmap": _on_marts(datasets.cohort_heatmap, cohort),
        "data_segments_ordered": _on_marts(findings.segments_in_order, segments),
        "data_frequency_scatter": _on_marts(datasets.frequency_scatter, "mart_rfm"),
        "data_pareto_curve": _on_marts(datasets.pareto_curve, "mart_pareto"),
        "data_repeat_bars": _on_marts(datasets.repeat_bars, "mart_repeat"),
        "data_top_categories": _on_marts(datasets.top_categories, category, k=5),
        "data_top_states": _on_marts(datasets.top_states, state, k=10),
        "data_payment_pie": _on_marts(datasets.payment_pie, "mart_payment"),
        "data_on_time_line": _on_marts(datasets.on_time_line, sla, window_start=WINDOW_START),
        "data_delay_bars": _on_marts(datasets.delay_bars, "mart_review_delay"),
        "data_kpi_cards": _on_marts(datasets.kpi_cards, kpi, "mart_rfm", sla),
        "data_kpi_table": _on_marts(datasets.kpi_table, kpi),
        "data_segment_bars": _on_marts(datasets.segments_by_revenue, segments, ascending=True),
        "data_segment_table": _on_marts(datasets.segments_by_revenue, segments),
        "data_customer_search": _on_marts(
            datasets.find_customers, "mart_rfm", pattern=oracle.SEARCH
        ),
        "data_pareto_sample": _on_marts(datasets.pareto_sample, "mart_pareto", size=oracle.SAMPLE),
        "data_window_summary": _on_marts(
            datasets.window_summary, kpi, window_start=WINDOW_START
        ),
        "data_state_table": _on_marts(datasets.state_table, state),
        # stored tables and files
        **{f"{table}_from_csv": _from_csv(table) for table in oracle.FROM_CSV},
        **{f"{name}_csv_round_trip": _mart_csv_round_trip(name) for name in MARTS},
        "dq_checks_json_round_trip": _json_round_trip(quality.data_quality, quality.CHECKS),
        "headline_json_round_trip": _json_round_trip(_headline, oracle.HEADLINE_NUMBERS),
        "headline_period_json_round_trip": _headline_period,
        "findings_json_round_trip": _findings_from_json,
        "raw_csv_rejects": _csv_rejects,
        "mart_monthly_kpi_by_order": _kpi_by_order,
        "mart_monthly_kpi_stored": _kpi_stored,
        "mart_category_raw_stored": _raw_stored,
    }
    return result


def oracle_sql() -> dict[str, str]:
    """The same queries as DuckDB SQL over the test tables, as far as SQL can express them."""
    training = _training_data()
    return library_oracles() | (training.ORACLES if training else {})


def library_oracles() -> dict[str, str]:
    """SQL for the operators on the marketplace."""
    return oracle.all_statements()
