"""The training-data pipeline: what stays of `documents`, and where it is packed.

STAGES are applied in order; each is written as Parquet and read again by the next.  All but
the last return the columns of `documents`; the last returns a row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vendlens.llm import language, line_dedup, near_dedup, packing, quality
from vendlens.llm.common import free_name, table
from vendlens.llm.queries import SITES, WORD_VOCABULARY
from vendlens.session import materialise, ship_package


# Rows of an Arrow batch.  Whole texts are held off heap and in Python at once, and a long-lived
# worker keeps the memory its largest batch needed.
BATCH_ROWS = 1024


def _prepare(spark: SparkSession) -> None:
    """Send the package, and set the size of Arrow batches for this session."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of low quality and toxic ones.

    The classifier learns from the labelled documents among `docs`.  Without labels of both
    kinds, and for documents without a source or language, see the operator.
    """
    _prepare(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = free_name(docs, "kept")
    return quality.classify(docs, model, SITES).where(F.col(kept)).select(*docs.columns)


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in none of the corpus' languages.

    The models learn from all of `docs` that state a language; texts without a letter go.
    """
    _prepare(spark)
    model = language.fit(docs)
    rejected = free_name(docs, "rejected")
    return language.identify(docs, model).where(~F.col(rejected)).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share; `n_chars` follows the text.

    Documents stay, also those that lose all their lines.
    """
    _prepare(spark)
    deduped = line_dedup.line_dedup(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return deduped
    kind = docs.schema["n_chars"].dataType
    return deduped.withColumn("n_chars", F.length("text").cast(kind))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies.

    A row is known by its id and its words.  Of rows that share both, if they stay, the one
    with the smallest text does.
    """
    _prepare(spark)
    decided = materialise(
        near_dedup.decisions(docs).select("doc_id", "body", "copies", "stays"), "near_decisions"
    )
    gone, key = free_name(docs, "gone"), free_name(docs, "gone_id")
    # How many rows of an id stay: fewer than there are only if some are copies.
    stays = decided.groupBy("doc_id").agg(
        F.sum(F.col("stays").cast("int")).alias("stay"), F.sum("copies").alias("rows")
    )
    dropped = materialise(
        stays.where("stay < rows").select(F.col("doc_id").alias(key), F.col("stay").alias(gone)),
        "near_copies",
    )
    marked = docs.join(dropped, docs["doc_id"].eqNullSafe(F.col(key)), "left")
    whole = marked.where(F.col(gone).isNull()).select(*docs.columns)
    repeated = dropped.where(F.col(gone) > 0)
    if not repeated.limit(1).count():
        return whole
    # Ids of several rows of which some stay: one row of each text that stays.  Found by
    # aggregation, which shrinks before the shuffle, as many rows may have no id.
    body, row = free_name(docs, "body"), free_name(docs, "row")
    mixed = docs.join(repeated, docs["doc_id"].eqNullSafe(F.col(key)), "left_semi")
    others = [f.name for f in docs.schema if f.dataType.typeName() in _PLAIN]
    first = near_dedup.with_body(mixed, body).groupBy("doc_id", body).agg(
        F.min_by(F.struct(*docs.columns), F.struct("text", *others)).alias(row)
    )
    kept = decided.where("stays").select(F.col("doc_id").alias(key), F.col("body").alias(gone))
    rows = first.join(
        kept, first["doc_id"].eqNullSafe(F.col(key)) & (F.col(body) == F.col(gone)), "left_semi"
    )
    return whole.unionByName(rows.select(f"{row}.*"))


# Types whose columns decide among rows that share id and text.
_PLAIN = {"string", "byte", "short", "integer", "long", "float", "double", "boolean", "date",
          "timestamp"}


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; see the operator for the columns."""
    _prepare(spark)
    return packing.pack_places(docs, WORD_VOCABULARY)


STAGES = [
    ("quality", quality_filter),
    ("language", language_filter),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier and the language models are beyond SQL.
ORACLE_SQL = None
