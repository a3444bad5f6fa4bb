"""Raw tables -> star schema, lazily or stored step by step."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendlens.operators.dimensions import dim_customer, dim_date, dim_product, dim_seller
from vendlens.operators.facts import (
    check_grain,
    fact_order_items,
    fact_orders,
    fact_payments,
    fact_reviews,
    order_rollup,
)
from vendlens.schemas import MULTILINE_FILES, RAW_FILES, RawTables, Star
from vendlens.sinks.files import store_bucketed, store_table
from vendlens.sources.raw_csv import REASON, REJECT, judged_csv, usable_rows

JOBS_AT_ONCE = 8
ORDER_FACTS = ("fact_orders", "fact_order_items", "fact_payments", "fact_reviews")

Store = Callable[[DataFrame, str, str], DataFrame]


def star_schema(raw: RawTables, grain: str = "reference") -> Star:
    """The whole star as lazy DataFrames: a query on it reads only what it needs."""
    check_grain(grain)
    star = Star(
        grain,
        dim_customer=lambda: dim_customer(raw.customers),
        dim_product=lambda: dim_product(raw.products, raw.category_translation),
        dim_seller=lambda: dim_seller(raw.sellers),
        dim_date=lambda: dim_date(raw.orders),
        fact_orders=lambda: fact_orders(raw.orders, raw.customers),
        fact_order_items=lambda: fact_order_items(raw.items),
        fact_payments=lambda: fact_payments(raw.payments),
        fact_reviews=lambda: fact_reviews(raw.reviews),
        order_rollup=lambda: rollup_of(star),
    )
    return star


def rollup_of(star: Star) -> DataFrame:
    return order_rollup(
        star.fact_orders, star.dim_customer, star.fact_order_items, star.fact_payments,
        star.fact_reviews, star.grain,
    )


def store_raw(raw: RawTables, folder: str) -> RawTables:
    """Store the eight raw tables, so that CSV is parsed once (A2)."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        stored = {
            name: pool.submit(store_table, df, folder, f"raw_{name}")
            for name, df in raw.named().items()
        }
        return RawTables(**{name: job.result() for name, job in stored.items()})


def store_csv(spark: SparkSession, source: str, folder: str) -> tuple[RawTables, DataFrame]:
    """Parse the eight CSV tables of `source` once and store all their rows (A1, A2).

    Returns the tables of usable rows and (table, reason, text) of the rejected ones, which
    the same pass stored beside them.
    """
    def store(name: str, pattern: str) -> DataFrame:
        rows = judged_csv(spark, f"{source}/{pattern}", name in MULTILINE_FILES)
        return store_table(rows, folder, f"raw_{name}")

    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        jobs = {name: pool.submit(store, name, p) for name, p in RAW_FILES.items()}
        stored = {name: job.result() for name, job in jobs.items()}
    rejects = [
        df.where(F.col(REASON).isNotNull()).select(
            F.lit(name).alias("table"), F.col(REASON).alias("reason"), F.col(REJECT).alias("text")
        )
        for name, df in stored.items()
    ]
    tables = RawTables(**{name: usable_rows(df) for name, df in stored.items()})
    return tables, reduce(DataFrame.unionAll, rejects)


def by_order(buckets: int, database: str = "default") -> Store:
    """Stores the facts in buckets of their order, other tables plainly.

    The joins of the order rollup then shuffle nothing.
    """
    def store(df: DataFrame, folder: str, name: str) -> DataFrame:
        if name in ORDER_FACTS:
            return store_bucketed(df, folder, name, "order_id", buckets, database)
        return store_table(df, folder, name)

    return store


def store_facts(
    raw: RawTables, folder: str, grain: str = "reference", store: Store = store_table
) -> Star:
    """Store dimensions and facts (A2); the order rollup on top of them stays lazy.

    `store` says how: as plain Parquet, or `by_order` where the session has a catalogue.
    """
    star = star_schema(raw, grain)
    names = [name for name in Star.NAMES if name != "order_rollup"]
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        jobs = {
            name: pool.submit(lambda n=name: store(getattr(star, n), folder, n))
            for name in names
        }
        stored = {name: job.result() for name, job in jobs.items()}
    facts = star.with_tables(**stored)
    return facts.with_tables(order_rollup=lambda: rollup_of(facts))


def store_rollup(facts: Star, folder: str) -> Star:
    """Store the order rollup of stored facts (A2)."""
    return facts.with_tables(order_rollup=store_table(facts.order_rollup, folder, "order_rollup"))


def store_star(
    raw: RawTables, folder: str, grain: str = "reference", store: Store = store_table
) -> Star:
    """Store the whole star: dimensions and facts, then the order rollup and summary on them."""
    star = store_rollup(store_facts(raw, folder, grain, store), folder)
    store_table(star.fact_order_summary, folder, "fact_order_summary")
    return star
