"""Operator 9: exact duplicates by progressive refinement, in DataFrame operations only.

Texts are compared after each run of white space became one space.  Rows are grouped by
length first, those that share it by the hash of their start, and only rows that share both
are read in full and get a SHA-256.  The first two steps carry two numbers per row and count
with partial aggregation; texts are moved once, to meet the groups that are still open.
Where the digests of all rows are asked for, each text is read once, where it lies, and only
digests are moved.

Defined results: null text is the empty text.  Of equal texts the smallest id stays; null
ids come last.  Where the staying id is on several rows of the group, one of them stays.  An
empty table gives an empty result.  Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendlens.llm.common import SPACE_PATTERN
from vendlens.session import materialise

PREFIX = 256  # characters read for the second step


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_PATTERN}+", " ")


def _shared(keys: DataFrame, *by: str) -> DataFrame:
    """The values of `by` that more than one row has."""
    return keys.groupBy(*by).agg(F.count("*").alias("rows")).where("rows > 1").select(*by)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digests: bool = False) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    `text_sha256` is null for rows that no other row can equal, as these are never read in
    full; with `digests` those rows are read for their digest as well.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("body")
    ).select(
        "doc_id", "body", F.length("body").alias("n"),
        F.xxhash64(F.substring("body", 1, PREFIX)).alias("p"),
    )
    full = F.sha2("body", 256)
    if digests:
        texts = materialise(
            texts.select("doc_id", "n", "p", full.alias("text_sha256")), "digests"
        )
        full, starts = F.col("text_sha256"), texts.select("n", "p")
    else:
        full, starts = F.when(F.col("open"), full), materialise(texts.select("n", "p"), "starts")
    by_length = _shared(starts, "n")
    by_prefix = _shared(starts.join(by_length, "n", "left_semi"), "n", "p")

    # Whole texts are needed now, or their digests.  A merge join whatever the size of the other
    # side, so that the step costs the same at every scale; a hot group is split, as only one
    # side has it.
    refined = texts.hint("merge").join(
        by_prefix.withColumn("open", F.lit(True)), ["n", "p"], "left"
    )
    members = materialise(
        refined.select(
            "doc_id", "n", "p", F.coalesce("open", F.lit(False)).alias("open"),
            full.alias("text_sha256"),
        ), "members"
    )
    alone = members.where(~F.col("open")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    # Rows that repeat an id with the same text are counted, and given back at the end.
    same = ["n", "p", "text_sha256"]
    copies = members.where("open").groupBy("doc_id", *same).agg(F.count("*").alias("copies"))
    groups = copies.groupBy(*same).agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    grouped = copies.join(groups, same).select(
        "*", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )
    return grouped.unionByName(alone)


# DuckDB SQL for the query over `documents`.
SQL = r"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
           AS text_sha256
    FROM documents),
groups AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
    FROM texts GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM texts JOIN groups USING (text_sha256)
"""
