"""Reader for the raw CSV files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendlens.schemas import MULTILINE_FILES, RAW_FILES, RAW_TYPES, RawTables


REJECT = "_rejected"  # the text of a row with a wrong number of fields
REASON = "_reason"    # why a row is rejected
# A row is of no use without a readable timestamp; numbers may be missing.
_NEEDED = "timestamp_ntz"


def _as_text(spark: SparkSession, path: str, multiline: bool) -> tuple[DataFrame, list[str]]:
    """All columns as text, and their names; files whose header differs raise an error.

    Values are read as text and cast later: the CSV reader itself checks only the columns a
    query asks for, so a row would be bad for one query and good for another.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline)
    names = reader.csv(path).columns
    fields = [T.StructField(n, T.StringType()) for n in [*names, REJECT]]
    text = (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT)
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .option("escape", '"')
        .schema(T.StructType(fields))
        .csv(path)
    )
    return text, names


def _typed(names: list[str]) -> tuple[dict[str, Column], Column]:
    """Typed columns by name, and why a row cannot be used: null if it can."""
    filled = {n: F.nullif(F.trim(n), F.lit("")) for n in names if n in RAW_TYPES}
    typed = {n: value.try_cast(RAW_TYPES[n]) for n, value in filled.items()}
    reason = F.when(F.col(REJECT).isNotNull(), "fields")
    for n, value in filled.items():
        if RAW_TYPES[n] == _NEEDED:
            reason = reason.when(value.isNotNull() & typed[n].isNull(), n)
    return typed, reason


def _row(names: list[str], typed: dict[str, Column]) -> list[Column]:
    return [typed[n].alias(n) if n in typed else F.col(n) for n in names]


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One CSV table: header row, typed by column name.

    Only the header line is read ahead; types come from `RAW_TYPES`, so there is no inference
    pass over the data.  A number that cannot be read is NULL and its row stays.  A row with a
    wrong number of fields or an unreadable timestamp is left out, whatever columns a query
    reads; `rejected_rows` counts these.  Several files must have the same header, else reading
    them raises an error.  Quoted line breaks (`multiline`) stop Spark from splitting a file,
    so such a table should come as many files.
    """
    text, names = _as_text(spark, path, multiline)
    typed, reason = _typed(names)
    return text.where(reason.isNull()).select(*_row(names, typed))


def judged_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All rows of one CSV table, with why a row is rejected and its text (null if usable).

    Reasons are "fields", for a wrong number of them, or the column of the first timestamp that
    cannot be read; the text is then the row's fields as CSV.  Stored whole, the table is read
    once for both; `usable_rows` gives what `read_raw_csv` does.
    """
    text, names = _as_text(spark, path, multiline)
    typed, reason = _typed(names)
    line = F.when(reason.isNotNull(), F.coalesce(F.col(REJECT), F.to_csv(F.struct(*names))))
    return text.select(*_row(names, typed), reason.alias(REASON), line.alias(REJECT))


def usable_rows(judged: DataFrame) -> DataFrame:
    """The rows of a judged table that can be used, as `read_raw_csv` gives them."""
    return judged.where(F.col(REASON).isNull()).drop(REASON, REJECT)


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(table, rows, rejected) of the eight raw tables: what `read_raw_csv` leaves out."""

    def counts(name: str, pattern: str) -> DataFrame:
        text, names = _as_text(spark, f"{folder}/{pattern}", name in MULTILINE_FILES)
        reason = _typed(names)[1]
        # Spark refuses to read the text of rejects alone, so a column is counted as well.
        rows = F.greatest(F.count(F.lit(1)), F.count(names[0]))
        return text.agg(
            F.lit(name).alias("table"), rows.alias("rows"),
            F.count(reason).alias("rejected"),
        )

    return reduce(DataFrame.unionAll, [counts(n, p) for n, p in RAW_FILES.items()])


def raw_tables(spark: SparkSession, folder: str) -> RawTables:
    """All eight raw tables of a folder (A1)."""
    return RawTables(**{
        name: lambda name=name, pattern=pattern: read_raw_csv(
            spark, f"{folder}/{pattern}", name in MULTILINE_FILES
        )
        for name, pattern in RAW_FILES.items()
    })
