"""What the operators share: tables by name, normal forms of text, worker-side caches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space the contracts name, as bytes and as a Java pattern.
SPACE = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings, null as the empty text."""
    return [value or "" for value in batch.column(name).to_pylist()]


class Cache(dict):
    """A dictionary that computes what is missing and starts anew when it is full.

    Words follow a steep distribution, so the common ones are back at once.
    """

    def __init__(self, compute: Callable, entries: int):
        super().__init__()
        self.compute, self.entries = compute, entries

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.entries:
            self.clear()
        self[key] = value
        return value


@cache
def _trim() -> Callable | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it


def give_back() -> None:
    """Return memory that is free to the system: a worker lives on and the next task may not
    be its own."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def tidy(run: Callable) -> Callable:
    """A function for `mapInArrow` that gives back its memory at the end of each task."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `rows` rows, so that little is held as objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def free_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores before it until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The `rows` rows of `df` with the smallest hash of `key` (all, if there are fewer).

    Only hashes are sorted; the rows themselves stay where they are.  Rows that tie with the
    last one, as copies of it do, are in as well.
    """
    hashed = F.xxhash64(key)
    last = df.select(hashed.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.where(hashed <= F.lit(last)) if last is not None else df.limit(0)
