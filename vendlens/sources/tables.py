"""Read back tables that an earlier step wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vendlens.schemas import RawTables, Star
from vendlens.sources.raw_csv import REASON, usable_rows


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One stored table or mart by name (A5)."""
    return spark.read.parquet(f"{folder}/{name}")


def read_star(spark: SparkSession, folder: str, grain: str = "reference") -> Star:
    """A stored star; `grain` is the one it was stored with."""
    return Star(grain, **{n: lambda n=n: read_table(spark, folder, n) for n in Star.NAMES})


def read_raw(spark: SparkSession, folder: str) -> RawTables:
    """Stored raw tables, without the rejected rows of those that have them."""

    def read(name: str) -> DataFrame:
        stored = read_table(spark, folder, f"raw_{name}")
        return usable_rows(stored) if REASON in stored.columns else stored

    return RawTables(**{n: lambda n=n: read(n) for n in RawTables.NAMES})
