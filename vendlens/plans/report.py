"""The whole run: raw tables -> stored star -> marts as CSV -> reports as JSON."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from vendlens.operators import marts as m
from vendlens.operators import rfm
from vendlens.operators.findings import MIN_COHORT, WINDOW_START, findings_document
from vendlens.operators.headline import headline_metrics
from vendlens.operators.quality import data_quality
from vendlens.plans.marts import MARTS, mart_order
from vendlens.plans.warehouse import JOBS_AT_ONCE, store_facts, store_rollup
from vendlens.schemas import RawTables, Star
from vendlens.sinks.files import export_csv, export_json, store_table

# Marts over dimensions and facts alone: they need not wait for the order rollup.
FACT_MARTS = ["mart_category", "mart_payment", "mart_cohort", "mart_delivery_sla"]
ROLLUP_MARTS = ["mart_monthly_kpi", "mart_state", "mart_review_delay", "mart_sla_by_state"]


def _store_all(builds: dict[str, Callable[[], DataFrame]], folder: str) -> dict[str, DataFrame]:
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        jobs = {
            name: pool.submit(lambda n=name, b=build: store_table(b(), folder, n))
            for name, build in builds.items()
        }
        return {name: job.result() for name, job in jobs.items()}


def store_fact_marts(facts: Star, folder: str) -> dict[str, DataFrame]:
    """Store the marts over stored facts."""
    return _store_all({n: lambda n=n: MARTS[n](facts) for n in FACT_MARTS}, folder)


def store_profile(star: Star, folder: str) -> DataFrame:
    """The customer profile, which several marts share."""
    return store_table(rfm.customer_profile(star.order_rollup), folder, "customer_profile")


def store_order_marts(star: Star, profile: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Store the marts over the order rollup and the customer profile."""

    def segments() -> DataFrame:
        base = store_table(rfm.rfm_tiered(profile, stored=True), folder, "mart_rfm_base")
        return rfm.customer_segments(base)

    builds = {n: lambda n=n: MARTS[n](star) for n in ROLLUP_MARTS}
    builds["mart_customer_segment"] = segments
    builds["mart_rfm"] = lambda: rfm.rfm_ntile(profile, stored=True)
    builds["mart_pareto"] = lambda: m.pareto(profile)
    builds["mart_repeat"] = lambda: m.repeat_purchase(profile)
    marts = _store_all(builds, folder)
    rollup = rfm.segment_rollup(marts["mart_customer_segment"])
    return {**marts, "mart_rfm_segments": store_table(rollup, folder, "mart_rfm_segments")}


def store_marts(star: Star, profile: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Compute every mart once, store it, and return the stored tables by name."""
    with ThreadPoolExecutor(1) as pool:
        early = pool.submit(store_fact_marts, star, folder)
        return {**store_order_marts(star, profile, folder), **early.result()}


def run_report(
    raw: RawTables,
    folder: str,
    window_start: str = WINDOW_START,
    min_cohort: int = MIN_COHORT,
    top_customers: int = 8000,
    grain: str = "reference",
) -> dict[str, str]:
    """Build everything under `folder`; returns the written CSV and JSON paths by name."""
    tables, processed, reports = f"{folder}/tables", f"{folder}/processed", f"{folder}/reports"

    def export(name: str, df: DataFrame) -> str:
        return export_csv(df, processed, name, mart_order(name))

    def checks(star: Star) -> str:
        return export_json(data_quality(star), reports, "data_quality")

    def headline(star: Star, profile: DataFrame) -> str:
        metrics = headline_metrics(star, top_customers, profile)
        return export_json(metrics, reports, "headline_metrics")

    facts = store_facts(raw, tables, grain)
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        early = pool.submit(store_fact_marts, facts, tables)
        jobs = {"dim_date": pool.submit(export, "dim_date", MARTS["dim_date"](facts))}
        star = store_rollup(facts, tables)
        jobs["data_quality"] = pool.submit(checks, star)
        jobs["fact_order_summary"] = pool.submit(
            export, "fact_order_summary", star.fact_order_summary
        )
        profile = store_profile(star, tables)
        jobs["headline_metrics"] = pool.submit(headline, star, profile)
        marts = {**store_order_marts(star, profile, tables), **early.result()}
        jobs |= {name: pool.submit(export, name, df) for name, df in marts.items()}
        findings = findings_document(marts, star.order_rollup, window_start, min_cohort)
        jobs["findings"] = pool.submit(export_json, findings, reports, "findings")
        return {name: job.result() for name, job in jobs.items()}
