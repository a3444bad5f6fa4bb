"""Operator 11: ranked lexical search, scoring each different bag of words once.

1. A document is its bag: how often each term of the items occurs in it, and `n`, all its terms.
   Other terms matter to no score and are only counted.
2. Documents with the same bag and the same length part `m` score alike for every item.  They
   are a class, found by a 64-bit hash and verified by the bag itself; copies are counted before
   they are shuffled.
3. Each class is scored once for all items, in whole numbers: a block of classes is a matrix of
   term parts, and an item's scores are the weighted sum of its terms' rows.
4. A task keeps the best classes of each item, by score and smallest document; `k` classes are
   enough, as each has a document.  They are merged per item, first in salted parts.
5. The classes that remain are expanded to their `k` smallest documents, and these are ranked.

Only what items name is sent to tasks: their terms and weights.  Items are dealt into blocks
of about `VOCABULARY` terms, so that this stays bounded however many items there are; each
block reads the documents once.

Defined results: null text has no term; documents and items without terms, and scores of 0,
give no rows.  Each row is a document, also if it repeats an id; null ids come last among
equal scores.  Rows that repeat an item id are items of their own, each
with its own ranks.  An empty table on either side gives an empty result.  Other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vendlens.session import materialise

K = 10
VOCABULARY = 50_000  # terms of a block of items, repeats counted
BLOCK_BYTES = 16 << 20  # of term parts scored at a time
SALTS = 32

# Bytes that are part of a term; A-Z in lower case, and all others a space.
_TERM_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b
    if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_PAIR = np.dtype([("term", "<u4"), ("tf", "<u4")])


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


class Items:
    """A block of items: their terms by number, and how often each item repeats each term."""

    def __init__(self, rows: list):
        self.ids = [r.item_id for r in rows]
        counts = [Counter(terms_of(r.text)) for r in rows]
        self.number = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        self.terms = [np.array([self.number[t] for t in c], np.int64) for c in counts]
        self.repeats = [np.array(list(c.values()), np.int64) for c in counts]


def _blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded vocabulary, read by the driver one block at a time."""
    size = F.length(F.coalesce("text", F.lit("")))
    total = items.agg(F.sum((size + 1) / 2)).first()[0]
    # A term and what parts it from the next take two characters at least.
    parts = math.ceil((total or 0) / VOCABULARY)
    for part in range(parts):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part
        rows = items.where(mine).collect()
        if any(terms_of(r.text) for r in rows):
            yield Items(rows)


# ---------------------------------------------------------------- bags and classes


def _bags(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, bag) of each document; `bag` is pairs of term and count by term."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.keys()
        for batch in batches:
            sizes, bags = [], []
            for value in batch.column("text"):
                terms = terms_of(value.as_py())
                sizes.append(len(terms))
                counts = Counter(terms)
                found = sorted((number[t], counts[t]) for t in counts.keys() & known)
                bags.append(np.array(found, _PAIR).tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary()),
            ], ["doc_id", "n", "bag"])

    return docs.mapInArrow(run, f"doc_id {kind}, n long, bag binary")


def _holders(bags: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(terms, np.int64)
        for batch in batches:
            for bag in batch.column("bag"):
                counts[np.frombuffer(bag.as_buffer(), _PAIR)["term"]] += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array(counts[held])], ["term", "docs"]
        )

    found = bags.select("bag").mapInArrow(run, "term long, docs long")
    result = np.zeros(terms, np.int64)
    for term, docs in found.groupBy("term").agg(F.sum("docs")).collect():  # one row per term
        result[term] = docs
    return result


def _weights(holders: np.ndarray, documents: int) -> np.ndarray:
    return np.array([
        math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))
        for held in holders.tolist()
    ], np.int64)


# ---------------------------------------------------------------- scores


class _Best:
    """The `k` best classes of an item so far, as (-score, no id, smallest id, class)."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def offer(self, scores: np.ndarray, classes: list[tuple]) -> None:
        """classes: (smallest id, number) of each score."""
        full = len(self.rows) == self.k
        at = np.flatnonzero(scores >= (-self.rows[-1][0] if full else 1))
        if len(at) > self.k:  # all that tie with the last of the best: their ids decide
            last = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= last]
        if len(at):
            new = [(-int(scores[i]), *classes[i]) for i in at]
            self.rows = sorted(
                self.rows + new,
                key=lambda r: (r[0], r[1] is None, 0 if r[1] is None else r[1], r[2]),
            )[:self.k]


def _scored(classes: DataFrame, items: Items, weights: np.ndarray, k: int) -> DataFrame:
    """(item, class, first, score): the best classes of each item in each task."""
    schema = f"item int, class long, first {_kind(classes, 'first')}, score long"
    arrow = classes.select("first").schema
    terms = items.terms
    factors = [weights[t] * r for t, r in zip(items.terms, items.repeats)]
    width = max(1, len(weights))
    rows = max(1, BLOCK_BYTES // (8 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in terms]
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                named = list(zip(part.column("first").to_pylist(),
                                 part.column("class").to_pylist()))
                of_term = np.zeros((width, len(named)), np.int64)
                for i, (m, bag) in enumerate(zip(part.column("m").to_pylist(),
                                                 part.column("bag").to_pylist())):
                    pairs = np.frombuffer(bag, _PAIR)
                    tf = pairs["tf"].astype(np.int64)
                    of_term[pairs["term"], i] = 1_000_000_000 * tf // (1000 * tf + 8 * m)
                for mine, used, factor in zip(best, terms, factors):
                    mine.offer(factor @ of_term[used], named)
        found = [(i, r[2], r[1], -r[0]) for i, mine in enumerate(best) for r in mine.rows]
        kind = to_arrow_type(arrow["first"].dataType)
        for start in range(0, len(found), 4096):
            item, number, first, score = zip(*found[start:start + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(number, pa.int64()),
                 pa.array(first, kind), pa.array(score, pa.int64())],
                ["item", "class", "first", "score"],
            )

    return classes.select("first", "class", "m", "bag").mapInArrow(run, schema)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _top(df: DataFrame, k: int, by: list, order: list) -> DataFrame:
    """The first `k` rows of each group; Spark drops the others before it shuffles as well."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _ranked(docs: DataFrame, items: Items, k: int, item_kind: str) -> DataFrame:
    """The ranking for one block of items."""
    spark = docs.sparkSession
    bags = materialise(_bags(docs, items.number), "bags")
    documents, terms = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    holders = _holders(bags, len(items.number))
    part = F.expr(f"25 + (75 * n * {documents}L) div {max(terms or 0, 1)}L")
    held = bags.where(F.length("bag") > 0).select("doc_id", part.alias("m"), "bag").withColumn(
        "h", F.xxhash64("bag", "m")
    )
    same = ["h", "m", "bag"]
    classes = materialise(
        held.groupBy(*same).agg(F.min("doc_id").alias("first")).withColumn(
            "class", F.monotonically_increasing_id()
        ), "classes"
    )
    scored = _scored(classes, items, _weights(holders, documents), k)
    order = [F.desc("score"), F.asc_nulls_last("first"), "class"]
    salted = _top(scored.withColumn("salt", F.pmod(F.hash("class"), F.lit(SALTS))), k,
                  ["item", "salt"], order)
    chosen = materialise(_top(salted, k, ["item"], order).drop("salt", "rank"), "chosen")

    # Members of the chosen classes.  Of a block's items there are at most VOCABULARY or so, and
    # `k` classes of each, so that their hashes can be broadcast; the bags settle equality.
    wanted = classes.join(chosen.select("class").distinct(), "class").select("class", *same)
    near = held.join(F.broadcast(wanted.select("h").distinct()), "h", "left_semi")
    by_id = F.asc_nulls_last("doc_id")
    members = _top(near, k, same, [by_id]).drop("rank").join(wanted, same).select(
        "class", "doc_id"
    )
    found = chosen.select("item", "class", "score").join(members, "class")
    names = spark.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {item_kind}")
    return _top(found, k, ["item"], [F.desc("score"), by_id]).join(names, "item").select(
        "item_id", F.col("rank").cast("int"), "doc_id", "score"
    )


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id",
           text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """The `k` best documents of each item: item_id, rank, doc_id, score."""
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )
    asked = items.select(
        F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("binary").alias("text")
    )
    kind = _kind(asked, "item_id")
    result = docs.sparkSession.createDataFrame(
        [], f"item_id {kind}, rank int, doc_id {_kind(named, 'doc_id')}, score long"
    )
    for block in _blocks(asked):
        result = result.unionByName(_ranked(named, block, k, kind))
    return result


# DuckDB SQL for the query over `documents` and `benchmark`.
SQL = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
item_terms AS (
    SELECT item_id, term, count(*) AS c
    FROM (SELECT item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark)
    GROUP BY item_id, term),
sizes AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
lengths AS (
    SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM sizes, totals),
counts AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms
    WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE
                                 / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, totals GROUP BY term),
scores AS (
    SELECT item_id, doc_id,
           sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM item_terms JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id)
    GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, doc_id, score,
           (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
