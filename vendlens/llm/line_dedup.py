"""Operator 7: reversible line dedup with sharded cuckoo filters over exact counts.

A line's key is the 128-bit hash of the line without white space at its ends and with A-Z in
lower case.  The state of an index is three tables:

* `references`: one row per key and document that holds it, the exact truth;
* `counts`: per key, in how many documents it is and the largest of them;
* `filters`: per shard of keys, a cuckoo filter of the keys that are common enough to be
  dropped.  A shard has at most about `KEYS_PER_SHARD` of them, so a filter is bounded.

Documents can be added and deleted.  Both change the exact tables, and then only the filters
of shards in which a key became common or stopped being so.  A deleted document's fingerprints
leave the filters, so lines that are no longer common come back.

To drop lines, a document's keys are first asked of the filters, shard by shard, and only
those that pass, a small part, are joined with the exact counts.  Fingerprints never
decide alone.

Defined results: null or empty text is one empty line.  A document is its id: rows that
repeat an id count once per key, and each loses the same lines.  A row without an id counts
nowhere and keeps all its lines.  An empty table gives an empty result.  Other columns are
kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendlens.llm.common import SPACE, free_name, slices, strings
from vendlens.session import materialise

MIN_CHARS = 20
MIN_DOCS = 3
KEYS_PER_SHARD = 50_000
SLOTS = 4
ROWS = 1024


# ---------------------------------------------------------------- cuckoo filter


class CuckooFilter:
    """16-bit fingerprints in buckets of four; supports deletion; never a false negative."""

    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x slots, 0 is free; a power of two of buckets

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> CuckooFilter:
        """A filter of these keys, doubled until all of them find a place."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, len(high)) / SLOTS / 0.85))))
        while True:
            made = cls(np.zeros((buckets, SLOTS), dtype=np.uint16))
            if made.insert(high, low):
                return made
            buckets *= 2

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, high: np.ndarray, low: np.ndarray):
        """Fingerprint and both buckets of each key."""
        mask = np.uint64(len(self.table) - 1)
        low = low.astype(np.int64).view(np.uint64)
        prints = (low >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = low & mask
        second = first ^ (self._spread(prints) & mask)
        return prints, first.astype(np.int64), second.astype(np.int64)

    @staticmethod
    def _spread(prints):
        return (np.asarray(prints).astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(7)

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(high, low)
        found = (self.table[first] == prints[:, None]).any(axis=1)
        return found | (self.table[second] == prints[:, None]).any(axis=1)

    def insert(self, high: np.ndarray, low: np.ndarray) -> bool:
        """False if a key found no place; the filter has to be made anew then."""
        mask = len(self.table) - 1
        for print_, first, second in zip(*self._places(high, low)):
            bucket, current = first, print_
            for turn in range(500):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = current
                    break
                if turn == 0:
                    bucket = second
                    continue
                slot = (turn + int(current)) % SLOTS
                current, self.table[bucket, slot] = self.table[bucket, slot], current
                bucket = int(bucket) ^ (int(self._spread(current)) & mask)
            else:
                return False
        return True

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        """Remove one fingerprint per key; the keys must have been inserted."""
        for print_, first, second in zip(*self._places(high, low)):
            for bucket in (first, second):
                held = np.flatnonzero(self.table[bucket] == print_)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break


# ---------------------------------------------------------------- keys of lines


def key_of(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of a line as 16 bytes, None for lines too short to count."""
    stripped = line.strip(SPACE)
    if len(stripped) < min_chars:
        return None
    return xxhash.xxh3_128_digest(stripped.encode("utf-8").lower())  # bytes: A-Z alone


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows of (doc_id, high, low): each key of each row's text once."""
    named = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    named = named.where("doc_id IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            rows, keys = [], []
            for row, text in enumerate(strings(batch, "text")):
                found = {key_of(line, min_chars) for line in text.split("\n")} - {None}
                rows.extend([row] * len(found))
                keys.extend(found)
            pairs = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
            ], ["doc_id", "high", "low"])

    kind = named.schema["doc_id"].dataType.simpleString()
    return named.mapInArrow(run, f"doc_id {kind}, high long, low long")


# ---------------------------------------------------------------- the index


@dataclass(frozen=True)
class LineIndex:
    """Stored tables of an index; see the module's description."""

    references: DataFrame  # doc_id, high, low
    counts: DataFrame      # high, low, docs, last_doc
    filters: DataFrame     # shard, filter
    shards: int
    min_docs: int

    def common(self) -> DataFrame:
        return self.counts.where(F.col("docs") >= self.min_docs)


def _count(references: DataFrame) -> DataFrame:
    return references.groupBy("high", "low").agg(
        F.count("*").alias("docs"), F.max("doc_id").alias("last_doc")
    )


def _shard(shards: int):
    return F.pmod(F.col("high"), F.lit(shards)).cast("int").alias("shard")


def _make_filters(common: DataFrame, shards: int) -> DataFrame:
    def run(keys: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(keys["high"].to_numpy(), keys["low"].to_numpy())
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "filter": [made.to_bytes()]})

    keyed = common.select("high", "low", _shard(shards))
    return keyed.groupBy("shard").applyInPandas(run, "shard int, filter binary")


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
    """The index of all of `docs`."""
    keys = line_keys(docs, id_col, text_col, min_chars).groupBy("doc_id", "high", "low")
    references = materialise(keys.agg(F.lit(1)).select("doc_id", "high", "low"), "references")
    return _index(references, min_docs)


def _index(references: DataFrame, min_docs: int) -> LineIndex:
    counts = materialise(_count(references), "counts")
    shards = 1 + counts.where(F.col("docs") >= min_docs).count() // KEYS_PER_SHARD
    filters = _make_filters(counts.where(F.col("docs") >= min_docs), shards)
    return LineIndex(references, counts, materialise(filters, "filters"), shards, min_docs)


def update(index: LineIndex, added: DataFrame | None = None, deleted: DataFrame | None = None,
           id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS
           ) -> LineIndex:
    """The index after deleting documents (rows of ids) and adding others.

    An added document replaces what the index held under its id.
    """
    references, changed = index.references, None
    gone = [d.selectExpr(f"`{id_col}` AS doc_id") for d in (added, deleted) if d is not None]
    if not gone:
        return index
    ids = gone[0] if len(gone) == 1 else gone[0].union(gone[1])
    ids = ids.where("doc_id IS NOT NULL").distinct()
    changed = references.join(ids, "doc_id", "left_semi").select("high", "low")
    references = references.join(ids, "doc_id", "left_anti")
    if added is not None:
        new = line_keys(added, id_col, text_col, min_chars).distinct()
        new = materialise(new.select("doc_id", "high", "low"), "added")
        references = references.unionByName(new)
        changed = changed.union(new.select("high", "low"))
    changed = materialise(changed.distinct(), "changed")
    references = materialise(references.select("doc_id", "high", "low"), "references")
    recounted = _count(references.join(changed, ["high", "low"], "left_semi"))
    untouched = index.counts.join(changed, ["high", "low"], "left_anti")
    counts = materialise(untouched.unionByName(recounted), "counts")
    after = LineIndex(references, counts, index.filters, index.shards, index.min_docs)
    if after.common().count() > 2 * KEYS_PER_SHARD * index.shards:
        return _index(references, index.min_docs)  # more shards are due
    return LineIndex(
        references, counts, materialise(_update_filters(index, after), "filters"),
        index.shards, index.min_docs,
    )


def _update_filters(before: LineIndex, after: LineIndex) -> DataFrame:
    """Insert keys that became common into their shard's filter, delete those that were."""
    key = ["high", "low"]
    came = after.common().join(before.common(), key, "left_anti")
    went = before.common().join(after.common(), key, "left_anti")
    moves = came.select(*key, F.lit(True).alias("new")).unionByName(
        went.select(*key, F.lit(False).alias("new"))
    ).select("*", _shard(after.shards))
    wanted = after.common().select(*key, _shard(after.shards)).join(
        moves.select("shard").distinct(), "shard", "left_semi"
    ).withColumn("new", F.lit(None).cast("boolean"))

    def run(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        def chosen(rows):
            return rows["high"].to_numpy(np.int64), rows["low"].to_numpy(np.int64)

        if not len(keys):
            return filters[["shard", "filter"]]
        made, all_keys = None, keys[keys["new"].isna()]
        if len(filters):
            made = CuckooFilter.from_bytes(filters["filter"].iloc[0])
            made.delete(*chosen(keys[keys["new"].eq(False)]))
            if not made.insert(*chosen(keys[keys["new"].eq(True)])):
                made = None
        made = made or CuckooFilter.of(*chosen(all_keys))  # from the exact table when full
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "filter": [made.to_bytes()]})

    rows = moves.unionByName(wanted)
    return before.filters.groupBy("shard").cogroup(rows.groupBy("shard")).applyInPandas(
        run, "shard int, filter binary"
    )


# ---------------------------------------------------------------- dropping lines


def _pass_filters(references: DataFrame, index: LineIndex) -> DataFrame:
    """The references whose key its shard's filter has; a few false ones among them."""
    shards = index.shards
    kind = references.schema["doc_id"].dataType.simpleString()
    partitions = int(references.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = max(1, partitions // shards)  # copies of a filter, so that few shards are many tasks

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each batch and shard, with the keys and the place of their ids."""
        for number, batch in enumerate(batches):
            high = batch.column("high").to_numpy()
            low = batch.column("low").to_numpy()
            shard = np.mod(high, shards)
            order = np.argsort(shard, kind="stable")
            found, starts = np.unique(shard[order], return_index=True)
            groups = np.split(order, starts[1:]) if len(order) else []
            salt = int(low[0]) % spread if len(low) else 0
            yield pa.RecordBatch.from_arrays([
                pa.array(found.astype(np.int32)),
                pa.array(np.full(len(found), salt, np.int32)),
                pa.array([high[g].tobytes() for g in groups], pa.binary()),
                pa.array([low[g].tobytes() for g in groups], pa.binary()),
                pa.array([batch.column("doc_id").take(pa.array(g)).to_pylist() for g in groups],
                         pa.list_(batch.column("doc_id").type)),
            ], ["shard", "salt", "high", "low", "docs"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            high = np.frombuffer(batch.column("high")[0].as_py(), dtype=np.int64)
            low = np.frombuffer(batch.column("low")[0].as_py(), dtype=np.int64)
            held = CuckooFilter.from_bytes(batch.column("filter")[0].as_py())
            hit = held.contains(high, low)
            docs = batch.column("docs")[0].values.filter(pa.array(hit))
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(high[hit]), pa.array(low[hit])], ["doc_id", "high", "low"]
            )

    packed = references.select("doc_id", "high", "low").mapInArrow(
        gather, f"shard int, salt int, high binary, low binary, docs array<{kind}>"
    )
    copies = index.filters.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt")
    )
    return packed.join(copies, ["shard", "salt"]).select("docs", "high", "low", "filter") \
        .mapInArrow(probe, f"doc_id {kind}, high long, low long")


def dropped_keys(index: LineIndex) -> DataFrame:
    """Rows of (doc_id, keys): the keys whose lines that document loses."""
    passed = _pass_filters(index.references, index)
    exact = passed.join(index.common().select("high", "low", "last_doc"), ["high", "low"])
    return exact.where("doc_id != last_doc").groupBy("doc_id").agg(
        F.collect_list(F.struct("high", "low")).alias("keys")
    )


def drop_lines(docs: DataFrame, index: LineIndex, id_col: str = "doc_id",
               text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with the lines dropped from the text; appends n_lines and n_dropped.

    A column of `docs` that has one of these names keeps it; the new one gets an underscore.
    """
    lines, dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    keys, key_id = free_name(docs, "keys"), free_name(docs, "key_doc")
    lost = dropped_keys(index).select(F.col("doc_id").alias(key_id), F.col("keys").alias(keys))
    joined = docs.join(lost, docs[id_col] == F.col(key_id), "left").drop(key_id)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            n_lines, n_dropped, kept = [], [], []
            for text, lost_keys in zip(strings(batch, text_col), batch.column(keys).to_pylist()):
                split = text.split("\n")
                stay = split
                if lost_keys:
                    gone = {
                        np.array([k["high"], k["low"]], dtype=np.int64).tobytes()
                        for k in lost_keys
                    }
                    stay = [line for line in split if key_of(line, min_chars) not in gone]
                n_lines.append(len(split))
                n_dropped.append(len(split) - len(stay))
                kept.append("\n".join(stay))
            arrays = [
                pa.array(kept, batch.column(c).type) if c == text_col else batch.column(c)
                for c in columns
            ]
            arrays += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, lines, dropped])

    schema = docs.select(
        "*", F.lit(0).cast("long").alias(lines), F.lit(0).cast("long").alias(dropped)
    ).schema
    return joined.mapInArrow(run, schema)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`drop_lines` of all of `docs` under their own index."""
    index = build(docs, id_col, text_col, min_chars, min_docs)
    return drop_lines(docs, index, id_col, text_col, min_chars)


def digests(deduped: DataFrame) -> DataFrame:
    kept = F.sha2("text", 256).alias("kept_sha256")
    return deduped.select("doc_id", "n_lines", "n_dropped", kept)


# DuckDB SQL for the query over `documents`.
SQL = r"""
WITH split AS (
    SELECT row_number() OVER () AS row, doc_id,
           string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents),
lines AS (
    SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS nth
    FROM split),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
common AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
    SELECT row, keyed.doc_id, nth, line,
           common.key IS NOT NULL AND keyed.doc_id <> last_doc AS drop_it
    FROM keyed LEFT JOIN common USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (drop_it) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT drop_it), ''))
       AS kept_sha256
FROM marked GROUP BY row
"""
