"""Operator 8: nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes smallest distance by one more dimension, which fills vectors up
to the largest length and is zero for queries (scaled to that length).  Each of `TABLES`
tables projects vectors on `HASHES` normal directions and cuts each projection into steps of
`WIDTH`: the step numbers are the bucket.

A query visits buckets in the order of their estimated success, the squared distance from its
projections to the bucket's box: first its own, then perturbations of ever more and farther
coordinates, until a limit.  The limit is fitted on a bounded sample, taken by hash of the id: it
is the distance within which `TARGET` of the true neighbours of the sample's first
`SAMPLE_QUERIES` vectors, in order of that hash, have their bucket in one of the tables.
Candidates of all tables are merged and ranked by their exact inner product.

Buckets are dealt into shards of about `SHARD` vectors by the first `COARSE` coordinates; a
coarse cell that holds more (copies of one vector, say) is split by id.  The list of cells is
bounded, as coordinates are clamped.  A query goes, in blocks of queries, to the shards that
have a cell within its limit; each unit of work is one shard and one block, visits bucket by
bucket, and gives at most k rows per query.

Defined results: ids that are null and vectors that are null, empty, zero, of another than the
most frequent length, or hold null or non-finite components (or overflow when squared) take no
part.  Rows that repeat an id are one item with its best score, and no row with the query's id
is its neighbour.  Ties go to the smaller id.  A query that found too few goes on to the last
bucket.  An empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendlens.llm.common import bounded_sample, slices
from vendlens.session import materialise

TABLES = 2
HASHES = 8
WIDTH = 2.0
COARSE = 4
CLAMP = 8            # step numbers are kept within [-CLAMP, CLAMP)
SHARD = 16_384       # vectors of a shard
QUERY_BLOCK = 1024   # queries of a block
SAMPLE = 4096        # vectors the limit is fitted on
SAMPLE_QUERIES = 256
TARGET = 0.96
ROWS = 2048


@dataclass(frozen=True)
class Hashing:
    """The tables' directions for vectors of a length, and the largest length of a vector."""

    directions: np.ndarray  # tables x (dimensions + 1) x hashes
    shifts: np.ndarray      # tables x hashes
    longest: float

    @classmethod
    def of(cls, dimensions: int, longest: float) -> Hashing:
        rng = np.random.default_rng(dimensions)
        return cls(rng.standard_normal((TABLES, dimensions + 1, HASHES)),
                   rng.random((TABLES, HASHES)) * WIDTH, longest)

    def items(self, vectors: np.ndarray) -> np.ndarray:
        """tables x vectors x hashes: projections of vectors that are searched for."""
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1, keepdims=True)))
        return self._project(np.hstack([scaled, rest]))

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        return self._project(np.hstack([vectors / lengths, np.zeros((len(vectors), 1))]))

    def _project(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([vectors @ d + s for d, s in zip(self.directions, self.shifts)])


def buckets_of(projected: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(projected / WIDTH), -CLAMP, CLAMP - 1).astype(np.int8)


def misfit(projected: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """queries x buckets: squared distance from projections to boxes; small is promising."""
    total = np.zeros((len(projected), len(buckets)))
    for i in range(buckets.shape[1]):
        low = buckets[:, i] * WIDTH
        outside = np.maximum(low[None, :] - projected[:, i, None],
                             projected[:, i, None] - low[None, :] - WIDTH)
        total += np.maximum(outside, 0) ** 2
    return total


def cells_of(buckets: np.ndarray) -> np.ndarray:
    """One number for the first coordinates of each bucket."""
    digits = buckets[:, :COARSE].astype(np.int64) + CLAMP
    return digits @ (2 * CLAMP) ** np.arange(COARSE - 1, -1, -1)


def corners_of(cells: np.ndarray) -> np.ndarray:
    """The first coordinates of each cell."""
    powers = (2 * CLAMP) ** np.arange(COARSE - 1, -1, -1)
    return ((cells[:, None] // powers) % (2 * CLAMP) - CLAMP).astype(np.int8)


# ---------------------------------------------------------------- preparation


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    values = F.col(vector_col).cast("array<double>")
    named = vectors.select(F.col(id_col).alias("vec_id"), values.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    return named.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(~bad).withColumn(
        "square", square
    ).where("square > 0 AND square < double('infinity')")


def _limit(sample: DataFrame, hashing: Hashing, items: int, k: int) -> float:
    """The misfit within which neighbours are looked for, from at most SAMPLE vectors."""
    hashed = F.xxhash64("vec_id").alias("hash")
    rows = sample.limit(SAMPLE).select(hashed, "vec_id", "vector").toArrow().to_pandas()
    # In the order of the hash that took the sample: small ids may be one group of near copies.
    rows = rows.sort_values(["hash", "vec_id"])
    vectors = np.array(rows["vector"].tolist())
    n = len(vectors)
    if n < 2:
        return np.inf
    asked = vectors[:SAMPLE_QUERIES]
    scores = asked @ vectors.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    # Neighbours of a rank in the sample that corresponds to rank k among all vectors.
    rank = min(n - 1, max(1, -(-k * n // items)))
    near = np.argpartition(-scores, rank - 1, axis=1)[:, :rank]
    boxes, places = buckets_of(hashing.items(vectors)), hashing.queries(asked)
    best = np.full(near.shape, np.inf)
    for table in range(TABLES):
        found = misfit(places[table], boxes[table])
        best = np.minimum(best, np.take_along_axis(found, near, axis=1))
    return float(np.quantile(best, TARGET))


def _matrix(batch: pa.RecordBatch, name: str = "vector") -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


@dataclass(frozen=True)
class Directory:
    """Per table the coarse cells with vectors, in order, and the shards they are in."""

    cells: list[np.ndarray]
    first: list[np.ndarray]   # first shard of a cell
    shards: list[np.ndarray]  # how many shards a cell is split into

    @classmethod
    def of(cls, counts: pd.DataFrame) -> Directory:
        cells, first, shards = [], [], []
        for table in range(TABLES):
            mine = counts[counts["table"] == table].sort_values("cell")
            held = mine["count"].to_numpy(np.int64)
            split = np.maximum(1, -(-held // SHARD))
            starts, shard, filled = [], 0, 0
            for n, parts in zip(held, split):
                if parts > 1 or filled + n > SHARD:
                    shard, filled = shard + (filled > 0), 0
                starts.append(shard)
                filled += n
                if parts > 1:
                    shard, filled = shard + parts, 0
            cells.append(mine["cell"].to_numpy(np.int64))
            first.append(np.array(starts, np.int64))
            shards.append(split)
        return cls(cells, first, shards)


# ---------------------------------------------------------------- units of work


def _id_kind(df: DataFrame) -> str:
    return df.schema["vec_id"].dataType.simpleString()


def _cell_counts(items: DataFrame, hashing: Hashing) -> pd.DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            for table, boxes in enumerate(buckets_of(hashing.items(_matrix(batch)))):
                cells, counts = np.unique(cells_of(boxes), return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(cells), table, np.int32)), pa.array(cells),
                    pa.array(counts.astype(np.int64)),
                ], ["table", "cell", "count"])

    counted = items.select("vector").mapInArrow(run, "table int, cell long, count long")
    summed = counted.groupBy("table", "cell").agg(F.sum("count").alias("count"))
    return summed.toArrow().to_pandas()  # at most TABLES x (2 CLAMP)^COARSE rows


def _item_shards(items: DataFrame, hashing: Hashing, directory: Directory) -> DataFrame:
    """(table, shard, ids, vectors, boxes): the vectors of a shard in one row."""
    kind = _id_kind(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            vectors = _matrix(batch)
            spread = pd.util.hash_array(batch.column("vec_id").to_numpy()).astype(np.int64) >> 1
            for table, boxes in enumerate(buckets_of(hashing.items(vectors))):
                at = np.searchsorted(directory.cells[table], cells_of(boxes))
                parts = directory.shards[table][at]
                shard = directory.first[table][at] + np.abs(spread) % parts
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(batch.num_rows, table, np.int32)), pa.array(shard),
                    batch.column("vec_id"),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array([b.tobytes() for b in boxes], pa.binary()),
                ], ["table", "shard", "vec_id", "vector", "box"])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "table": [rows["table"].iloc[0]], "shard": [rows["shard"].iloc[0]],
            "ids": [rows["vec_id"].tolist()], "vectors": [b"".join(rows["vector"])],
            "boxes": [b"".join(rows["box"])],
        })

    dealt = items.select("vec_id", "vector").mapInArrow(
        run, f"table int, shard long, vec_id {kind}, vector binary, box binary"
    )
    return dealt.groupBy("table", "shard").applyInPandas(
        gather, f"table int, shard long, ids array<{kind}>, vectors binary, boxes binary"
    )


def _query_blocks(queries: DataFrame, hashing: Hashing, directory: Directory, limit: float
                  ) -> DataFrame:
    """(table, shard, query_ids, queries): blocks of the queries that a shard may serve."""
    kind = _id_kind(queries)
    blocks = 1 + queries.count() // QUERY_BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corners = [corners_of(cells) for cells in directory.cells]
        for batch in slices(batches, 256):
            vectors = _matrix(batch)
            packed = pa.array([v.tobytes() for v in vectors], pa.binary())
            ids = batch.column("vec_id")
            block = np.abs(pd.util.hash_array(ids.to_numpy()).astype(np.int64) >> 1) % blocks
            for table, places in enumerate(hashing.queries(vectors)):
                last = directory.first[table] + directory.shards[table] - 1
                shards = np.zeros((len(vectors), last.max(initial=-1) + 1), bool)
                near = misfit(places, corners[table]) <= limit
                for cell in range(len(last)):
                    shards[near[:, cell], directory.first[table][cell]:last[cell] + 1] = True
                row, shard = np.nonzero(shards)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(row), table, np.int32)),
                    pa.array(shard.astype(np.int64)), pa.array(block[row]),
                    ids.take(take), packed.take(take),
                ], ["table", "shard", "block", "query_id", "query"])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "table": [rows["table"].iloc[0]], "shard": [rows["shard"].iloc[0]],
            "query_ids": [rows["query_id"].tolist()], "queries": [b"".join(rows["query"])],
        })

    dealt = queries.select("vec_id", "vector").mapInArrow(
        run, f"table int, shard long, block long, query_id {kind}, query binary"
    )
    return dealt.groupBy("table", "shard", "block").applyInPandas(
        gather, f"table int, shard long, query_ids array<{kind}>, queries binary"
    )


def _visit(hashing: Hashing, table: int, vectors: np.ndarray, boxes: np.ndarray,
           queries: np.ndarray, limit: float) -> np.ndarray:
    """queries x vectors: inner products of what the queries visit, -inf for the rest."""
    order = np.lexsort(boxes.T[::-1])
    kinds, first = np.unique(boxes[order], axis=0, return_index=True)
    ends = np.append(first[1:], len(order))
    found = misfit(hashing.queries(queries)[table], kinds)
    ordered = vectors[order]
    products = np.full((len(queries), len(order)), -np.inf)
    # Each bucket, most promising for its queries first, meets the queries that visit it.
    for bucket in np.argsort(found.min(axis=0), kind="stable"):
        visitors = np.flatnonzero(found[:, bucket] <= limit)
        if len(visitors):
            own = slice(first[bucket], ends[bucket])
            products[visitors, own] = queries[visitors] @ ordered[own].T
    result = np.empty_like(products)
    result[:, order] = products
    return result


def _search(items: DataFrame, blocks: DataFrame, hashing: Hashing, limit: float, k: int,
            kind: str) -> DataFrame:
    """(query_id, vec_id, score): the best k of each shard for each query that came to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = hashing.directions.shape[1] - 1
        for batch in slices(batches, 1):
            id_type = batch.column("ids").type.value_type
            row = {name: batch.column(name)[0].as_py() for name in batch.schema.names}
            ids = np.array(row["ids"])
            vectors = np.frombuffer(row["vectors"]).reshape(-1, width)
            boxes = np.frombuffer(row["boxes"], np.int8).reshape(-1, HASHES)
            asked = np.array(row["query_ids"])
            queries = np.frombuffer(row["queries"]).reshape(-1, width)
            repeats = len(ids) - len(np.unique(ids))
            for start in range(0, len(asked), 256):
                part = slice(start, start + 256)
                products = _visit(hashing, row["table"], vectors, boxes, queries[part], limit)
                products[asked[part][:, None] == ids[None, :]] = -np.inf
                rows, columns = [], []
                for i, scores in enumerate(products):
                    top = min(k + repeats, len(scores))
                    least = np.partition(scores, len(scores) - top)[len(scores) - top]
                    near = np.flatnonzero((scores >= least - 1e-9) & (scores > -np.inf))
                    # Sums in one order, so that equal vectors have equal scores.
                    exact = (vectors[near] * queries[start + i]).sum(axis=1)
                    ranked = near[np.lexsort((ids[near], -exact))]
                    _, first = np.unique(ids[ranked], return_index=True)
                    best = ranked[np.sort(first)][:k]
                    rows.extend([start + i] * len(best))
                    columns.extend(best)
                score = (vectors[columns] * queries[rows]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(asked[rows], id_type), pa.array(ids[columns], id_type),
                    pa.array(score, pa.float64()),
                ], ["query_id", "vec_id", "score"])

    return items.join(blocks, ["table", "shard"]).select(
        "table", "ids", "vectors", "boxes", "query_ids", "queries"
    ).mapInArrow(run, f"query_id {kind}, vec_id {kind}, score double")


# ---------------------------------------------------------------- the operator


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row with `is_query`.

    `is_query` is a condition on `vec_id`.
    """
    valid = materialise(_valid(vectors, id_col, vector_col), "valid")
    kind = _id_kind(valid)
    empty = valid.sparkSession.createDataFrame(
        [], f"query_id {kind}, rank int, vec_id {kind}, score double"
    )
    length = valid.groupBy(F.size("vector").alias("n")).agg(
        F.count("*").alias("rows"), F.max("square").alias("square")
    ).orderBy(F.desc("rows"), F.desc("n")).first()
    if length is None:
        return empty
    items = valid.where(F.size("vector") == length["n"])
    hashing = Hashing.of(length["n"], float(np.sqrt(length["square"])))
    limit = _limit(bounded_sample(items, F.col("vec_id"), SAMPLE), hashing, length["rows"], k)
    directory = Directory.of(_cell_counts(items, hashing))
    shards = materialise(_item_shards(items, hashing, directory), "shards")
    queries = items.where(is_query)

    def search(asked: DataFrame, within: float) -> DataFrame:
        blocks = _query_blocks(asked, hashing, directory, within)
        found = _search(shards, blocks, hashing, within, k, kind)
        return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    found = materialise(search(queries, limit), "found")
    # Queries that found too few visit all buckets.
    others = valid.select("vec_id").distinct().count() - 1
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(
        F.col("n") >= min(k, others)
    )
    short = materialise(
        queries.join(enough.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti"),
        "short",
    )
    if short.limit(1).count():
        again = search(short, np.inf)
        found = found.join(
            short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti"
        ).unionByName(again)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
