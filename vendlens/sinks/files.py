"""Writers: Parquet tables between steps, CSV and JSON at the end."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendlens.functions.columns import plain_text


def store_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Replace a stored table and return it as read back (A2).

    Parquet keeps the types and lets later steps read single columns.  The new version is written
    beside the table, whose place it takes by a rename once it is whole: a write that fails leaves
    the old table, and the new one may be computed from it.
    """
    path, mark = f"{folder}/{name}", uuid.uuid4().hex
    new, old = f"{folder}/_{name}-{mark}-new", f"{folder}/_{name}-{mark}-old"
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.parquet(new)
    except BaseException:
        files.delete(place(new), True)
        raise
    replaced = files.exists(place(path))
    if replaced and not files.rename(place(path), place(old)):
        raise OSError(f"{path} could not be moved")
    if not files.rename(place(new), place(path)):
        if replaced:
            files.rename(place(old), place(path))
        raise OSError(f"{new} could not take the place of {path}")
    files.delete(place(old), True)
    return spark.read.schema(df.schema).parquet(path)


def store_bucketed(
    df: DataFrame, folder: str, name: str, key: str, buckets: int, database: str = "default"
) -> DataFrame:
    """Replace a catalogue table whose rows lie in `buckets` buckets of `key` (A2).

    Tables in equally many buckets of one key are joined and grouped by it without a shuffle.
    The new version is a table of its own, `name` a view on it that is replaced when the version
    is whole; then the old version goes.  Rows are brought together by bucket before they are
    written, and a hot key is still written by several tasks, but one task reads a bucket: where
    a key may hold a large share of the rows, use `store_table`.
    """
    spark, version = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    view, table, path = f"{database}.{name}", f"{database}.{version}", f"{folder}/{version}"
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        (
            df.hint("rebalance", buckets, F.col(key)).write.bucketBy(buckets, key)
            .option("path", path).saveAsTable(table)
        )
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        files.delete(place(path), True)
        raise
    for row in spark.sql(f"SHOW TABLES IN {database}").collect():
        if re.fullmatch(f"{name}_[0-9a-f]{{32}}", row.tableName) and row.tableName != version:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{row.tableName}")
            files.delete(place(f"{folder}/{row.tableName}"), True)
    return spark.table(view)


def _plain(df: DataFrame) -> list[Column]:
    """Columns as a CSV reader expects them: doubles without an exponent."""
    return [
        (plain_text(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.DoubleType)
         else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema
    ]


def export_csv(df: DataFrame, folder: str, name: str, order: list[Column] | None = None) -> str:
    """Write a mart as a folder of CSV files with header (A3, A4).

    Every task writes its own part, also for customer-level marts.  With `order` the rows are
    in that order, from file to file by their names; a stored table has to be sorted anew.
    """
    path = f"{folder}/{name}.csv"
    rows = df.orderBy(*order) if order else df
    rows.select(*_plain(df)).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_json(one_row: DataFrame, folder: str, name: str) -> str:
    """Write a one-row result as one JSON object."""
    path = f"{folder}/{name}.json"
    one_row.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path
