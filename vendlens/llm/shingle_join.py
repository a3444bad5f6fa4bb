"""Operator 12: texts whose sets of word shingles overlap, by an R-tree over count vectors.

A text's set is its distinct runs of five words.  Two texts link when the intersection of
their sets is at least `PERCENT` of the union; the result is the connected components.

1. Rows with the same set are one node from here on.
2. Nodes meet where they can link at all: of two sets that overlap enough, the shingles that
   come first in any one order, a quarter of each set, share some: more than a passage or two
   have among them.  The order is by hash, with shingles that very many texts hold last, so
   that a passage of many texts is no meeting place.
3. A node's shingles are hashed into groups, and the counts per group are a point.  The summed
   minima of two points, or of a point and the upper corner of a box of points, are a bound for
   the intersection.  An R-tree over these points leaves the pairs for which the bound is enough.
4. Each meeting place has a hub, its member that meets most others.  Members are held against
   their hub first: one pair per member, bounded by their points, then verified by their sets.
5. Members that are not connected by then are compared, in blocks, by R-trees over their points;
   places with the same hub are one.
   The pairs left are verified; where they are many, only those that would connect members not yet
   connected, and if one of them is no link, the place is compared once more by sets.  A place of which
   all but a few members are connected costs no more than its size.

No more than a few pairs per member leave a task.  The tree folds points to fewer groups, as many
as suit the size of the sets, so that long texts are told apart as well as short ones.

Defined results: null text and text without words have no set and link with nothing, also
not with each other.  A text of fewer than five words is one shingle.  Shingles are compared
by 64-bit hashes, and sets by 128-bit hashes where whole sets are taken to be equal.  A null id is never
a component's id unless there is no other.  An empty table gives an empty result.  Other
columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendlens.llm.common import slices
from vendlens.llm.near_dedup import components
from vendlens.session import materialise

WORDS = 5
PERCENT = 80
ROWS = 256

# Shingles held by very many texts.  At most COMMON of them are sent to tasks (8 bytes each).
COMMON = 1 << 18
_COUNTED = 1 << 20  # shingles a task counts at a time
_OFTEN = 4  # occurrences among these from which a shingle is reported

# Groups shingles are hashed into, and those the tree folds them to: a power of two near a
# quarter of the set's size, within these.
MOST_GROUPS = 1 << 16
LEAST_GROUPS, TREE_GROUPS = 16, 4096
FANOUT = 16
_CELLS = 1 << 20  # coordinates compared at a time

PAIRS = 4  # possible pairs per member that leave a task
PRUNINGS = 1
BLOCK = 1024  # members of a block
BLOCK_BYTES = 8 << 20  # of their sets

# Slots of the bitmap of ids whose sets are wanted; fixed, whatever the number of ids.
SLOTS = 1 << 23

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------- sets


# A word is the sum of a random number per byte times a power of an odd base, by its place: the
# difference of two prefix sums, so that all words of many texts are hashed at once.  Long words
# are hashed one by one, as powers of a base repeat their lower bits at last.
_LONG_WORD = 64
_SPAN = 1 << 18  # bytes summed at a time
_BASE = 0x5851F42D4C957F2D
_BYTE = np.random.default_rng(12).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, number: int) -> np.ndarray:
    factors = np.full(number, np.uint64(base % (1 << 64)))
    factors[0] = 1
    return np.cumprod(factors)


_POWER = _powers(_BASE, _SPAN + _LONG_WORD)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _SPAN + _LONG_WORD)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and how many words each text has."""
    data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)  # A-Z only, as these are bytes
    edge = np.diff(np.concatenate([[False], ~_SPACE[data], [False]]).view(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = stop - start
    hashes = np.empty(len(start), np.uint64)
    short = length <= _LONG_WORD
    with np.errstate(over="ignore"):
        span = np.append(np.unique(start // _SPAN, return_index=True)[1], len(start))
        for low, high in zip(span[:-1], span[1:]):
            at = low + np.flatnonzero(short[low:high])
            if len(at):
                origin = start[at[0]]
                part = data[origin:stop[at[-1]]]
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(_BYTE[part] * _POWER[:len(part)], out=sums[1:])
                first = start[at] - origin
                hashes[at] = (sums[stop[at] - origin] - sums[first]) * _INVERSE[first]
        hashes = _mix(hashes + length.astype(np.uint64) * _PRIME)
    for i in np.flatnonzero(~short):
        hashes[i] = xxhash.xxh3_64_intdigest(data[start[i]:stop[i]].tobytes())
    ends = np.cumsum([len(text) + 1 for text in texts])
    return hashes, np.diff(np.searchsorted(start, ends), prepend=0)


def _runs(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    length = max(0, len(hashes) - words + 1) if words else 0
    runs = np.full(length, np.uint64(words))
    with np.errstate(over="ignore"):
        for i in range(words):
            runs = _mix(runs * _PRIME + hashes[i:i + length])
    return runs


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The set of each text, as sorted hashes."""
    hashes, counts = word_hashes([text.as_py() or b"" for text in texts])
    runs = _runs(hashes, WORDS)
    found, start = [], 0
    for count in counts.tolist():
        mine = runs[start:start + count - WORDS + 1]
        if count < WORDS:
            mine = _runs(hashes[start:start + count], count)
        start += count
        mine = np.sort(mine)
        found.append(mine[np.append(mine[:-1] != mine[1:], True)] if len(mine) > 1 else mine)
    return found


def _least_overlap(size: int) -> int:
    """So many shingles, at least, a set of that size has in common with one it links with."""
    return -(-PERCENT * size // 100)


def _spare(size: int) -> int:
    return size // 16


def prefix_size(size: int) -> int:
    """So many of the first shingles of a set are its meeting places.

    Of these it has 1 + _spare(size) in common with a set it links with, or that set's number if
    it is smaller: it lacks no more than `size - _least_overlap(size)` of its shingles, and the
    first common ones are the same from either side.
    """
    return size - _least_overlap(size) + 1 + _spare(size)


def least_shared(size: int) -> int:
    """So many places, at least, a set shares with one it links with."""
    return 1 + _spare(_least_overlap(size))


class Common:
    """The shingles that come last in the order, from the rarest to the commonest."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        order = np.argsort(shingles)
        self.shingles = shingles[order]
        self.rank = np.empty(len(order), np.int64)
        self.rank[np.lexsort((self.shingles, counts[order]))] = np.arange(len(order))

    def prefix(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first shingles of a sorted set, those that are common apart."""
        size = prefix_size(len(shingles))
        if not len(self.shingles):
            return shingles[:size], shingles[:0]
        at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
        common = self.shingles[at] == shingles
        rare = shingles[~common]
        last = shingles[common][np.argsort(self.rank[at[common]])]
        return rare[:size], last[:max(0, size - len(rare))]


def _rows(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, body (hash of its set), n; and rows for common shingles.

    These have a `shingle` and the number of times it occurred among those a task counted at a
    time; what occurs seldom is not reported.  Counted is the part of a set, twice as
    large as the first shingles, from which these are taken once the common ones are last.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, waiting = [], 0

        def reported(schema: pa.Schema) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(counted), return_counts=True)
            often = counts >= _OFTEN
            found = values[often].view(np.int64)
            return pa.RecordBatch.from_arrays([
                pa.nulls(len(found), schema.field("doc_id").type),
                pa.nulls(len(found), pa.binary()), pa.nulls(len(found), pa.int64()),
                pa.array(found), pa.array(counts[often].astype(np.int64)),
            ], ["doc_id", "body", "n", "shingle", "times"])

        schema = None
        for batch in slices(batches, ROWS):
            schema = batch.schema
            bodies, sizes = [], []
            for shingles in shingle_sets(batch.column("text")):
                bodies.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sizes.append(len(shingles))
                if len(shingles):
                    counted.append(shingles[:2 * prefix_size(len(shingles))])
                    waiting += len(counted[-1])
            empty = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(bodies, pa.binary()),
                pa.array(sizes, pa.int64()), empty, empty,
            ], ["doc_id", "body", "n", "shingle", "times"])
            if waiting >= _COUNTED:
                yield reported(schema)
                counted, waiting = [], 0
        if waiting:
            yield reported(schema)

    return docs.mapInArrow(run, f"doc_id {kind}, body binary, n long, shingle long, times long")


def _common(rows: DataFrame) -> Common:
    """Shingles with more than 1/COMMON of all reported occurrences, so at most COMMON."""
    times = rows.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
    total = times.agg(F.sum("times")).first()[0] or 0
    found = times.where(F.col("times") * COMMON > total).toPandas()
    return Common(
        found["shingle"].to_numpy(np.int64).view(np.uint64), found["times"].to_numpy(np.int64)
    )


# ---------------------------------------------------------------- count vectors


def point_of(shingles: np.ndarray) -> np.ndarray:
    """The group of each shingle of a set in order: its count vector, written out sparsely."""
    return np.sort((shingles & np.uint64(MOST_GROUPS - 1)).astype(np.uint16))


def groups_of(size: int) -> int:
    """Groups for the tree; those of a set it can link with are as many, twice or half."""
    return min(TREE_GROUPS, max(LEAST_GROUPS, 1 << max(0, (size - 1) // 4).bit_length()))


def counts_of(point: np.ndarray, groups: int) -> np.ndarray:
    """A point folded to fewer groups: groups that agree in the lower bits are one."""
    return np.bincount(point & (groups - 1), minlength=groups).astype(np.int32)


def bound(a: np.ndarray, b: np.ndarray) -> int:
    """The summed minima of the counts of two points, over all groups."""
    if len(a) > len(b):
        a, b = b, a
    group, first, count = np.unique(a, return_index=True, return_counts=True)
    held = np.searchsorted(b, group, "right") - np.searchsorted(b, group, "left")
    return int(np.minimum(count, held).sum())


def enough(overlap, a, b):
    """Whether sets of sizes a and b with that intersection link."""
    return (100 + PERCENT) * overlap >= PERCENT * (a + b)


class CountTree:
    """An R-tree over count vectors, packed by size and then by the widest coordinate."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        for start in range(0, len(order), FANOUT * FANOUT):
            tile = order[start:start + FANOUT * FANOUT]
            widest = np.ptp(counts[tile], axis=0).argmax()
            order[start:start + len(tile)] = tile[np.argsort(counts[tile, widest], kind="stable")]
        self.order = order
        # Levels from points up: upper corners, and least and greatest size below.
        self.levels = [(counts[order], sizes[order], sizes[order])]
        while len(self.levels[-1][0]) > FANOUT:
            corner, least, most = self.levels[-1]
            first = np.arange(0, len(corner), FANOUT)
            self.levels.append((
                np.maximum.reduceat(corner, first), np.minimum.reduceat(least, first),
                np.maximum.reduceat(most, first),
            ))

    def possible(self, counts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and point for which the bound of the overlap is enough."""
        top = len(self.levels[-1][0])
        query = np.repeat(np.arange(len(sizes)), top)
        node = np.tile(np.arange(top), len(sizes))
        for level in reversed(range(len(self.levels))):
            corner, least, most = self.levels[level]
            size = sizes[query]
            # A set within the box that could be as large as the query needs, and as small.
            fits = (100 * most[node] >= PERCENT * size) & (100 * size >= PERCENT * least[node])
            query, node = query[fits], node[fits]
            kept = np.zeros(len(query), bool)
            step = max(1, _CELLS // counts.shape[1])
            for start in range(0, len(query), step):
                q, n = query[start:start + step], node[start:start + step]
                bound = np.minimum(counts[q], corner[n]).sum(1, dtype=np.int64)
                kept[start:start + step] = enough(bound, sizes[q], least[n])
            query, node = query[kept], node[kept]
            if level:
                below = len(self.levels[level - 1][0])
                child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query = np.repeat(query, FANOUT)[child < below]
                node = child[child < below]
        return query, self.order[node]


class Points:
    """Points of some nodes, by the number of groups that suits their size."""

    def __init__(self, points: list[np.ndarray]):
        self.points = points
        self.sizes = np.array([len(p) for p in points], np.int64)
        self.groups = np.array([groups_of(len(p)) for p in points], np.int64)

    def of(self, *groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Indices, vectors of the first number of groups, and sizes."""
        at = np.flatnonzero(np.isin(self.groups, groups))
        counts = [counts_of(self.points[i], groups[0]) for i in at]
        return at, np.array(counts, np.int32).reshape(len(at), groups[0]), self.sizes[at]


def possible_pairs(a: Points, b: Points | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a point of `a` and one of `b`, or of two of `a`, that may link; each once."""
    found = [(np.zeros(0, np.int64),) * 2]
    for groups in np.unique(a.groups).tolist():
        at, counts, sizes = a.of(groups)
        other, *tree = (b or a).of(groups, 2 * groups)
        if len(other):
            query, point = CountTree(*tree).possible(counts, sizes)
            left, right = at[query], other[point]
            once = (left < right) | (a.groups[right] > groups) if b is None else slice(None)
            found.append((left[once], right[once]))
        if b is not None:  # what is only found from the side of fewer groups
            at, counts, sizes = b.of(groups // 2)
            if len(at):
                other, *tree = a.of(groups // 2, groups)
                more = a.groups[other] == groups
                query, point = CountTree(*(t[more] for t in tree)).possible(counts, sizes)
                found.append((other[more][point], at[query]))
    left, right = (np.concatenate(side) for side in zip(*found))
    last = b or a
    close = np.array([
        enough(bound(a.points[i], last.points[j]), len(a.points[i]), len(last.points[j]))
        for i, j in zip(left, right)
    ], bool)
    return left[close], right[close]


# ---------------------------------------------------------------- nodes and meeting places


def _nodes(docs: DataFrame, common: Common) -> DataFrame:
    """(node, body, first, n, needs, rare, common) of each different set; `first` is its least id.

    Its meeting places are rare and common shingles; it `needs` so many that others have too.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["body", "n", "needs", "rare", "common"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            ids, rows = [], []
            for i, shingles in enumerate(shingle_sets(batch.column("text"))):
                if len(shingles):
                    ids.append(i)
                    rare, last = common.prefix(shingles)
                    rows.append((
                        xxhash.xxh3_128_digest(shingles.tobytes()), len(shingles),
                        least_shared(len(shingles)), rare.view(np.int64), last.view(np.int64),
                    ))
            if rows:
                kinds = [pa.binary(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                first = batch.column("doc_id").take(pa.array(ids))
                yield pa.RecordBatch.from_arrays([first, *columns], ["doc_id", *names])

    found = docs.mapInArrow(
        run, f"doc_id {kind}, body binary, n long, needs long, rare array<long>, "
             "common array<long>"
    )
    return found.groupBy("body").agg(
        F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in names[1:]]
    ).withColumn("node", F.monotonically_increasing_id())


def _members(nodes: DataFrame) -> DataFrame:
    """(place, node, n) of nodes that share as many places as a link needs, in shared places.

    Rare shingles are counted where they meet, which is in one task per shingle: less than
    1/COMMON of all.  The common ones are known to be shared.
    """
    rare = nodes.select("node", F.explode("rare").alias("place")).withColumn(
        "size", F.count("*").over(Window.partitionBy("place"))
    ).where("size > 1").select("place", "node")
    common = nodes.select(F.explode("common").alias("place"), "node")
    met = materialise(rare.unionByName(common), "met")
    # Without those that share too few, others share fewer places; the rest is for the points.
    for _ in range(PRUNINGS):
        able = met.groupBy("node").agg(F.count("*").alias("shared")).join(
            nodes.select("node", "n", "needs"), "node"
        ).where("shared >= needs").select("node", "n")
        left = materialise(met.select("place", "node").join(able, "node"), "able")
        met = left.join(_shared(left), "place", "left_semi")
    return met


def _shared(met: DataFrame) -> DataFrame:
    return met.groupBy("place").agg(F.count("*").alias("size")).where("size > 1")


def _places(nodes: DataFrame) -> DataFrame:
    """(place, node, n, size, hub, hub_n) of each member of a place with more than one.

    Of places with the same members, as the shingles of one passage are, one is left.
    """
    met = materialise(_members(nodes), "members")
    alike = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in range(2)]
    different = met.groupBy("place").agg(F.count("*").alias("size"), *alike).where(
        "size > 1"
    ).groupBy("size", "x0", "x1").agg(F.min("place").alias("place")).select("place", "size")
    members = materialise(met.join(different, "place"), "different")
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    known = members.join(weight, "node")
    hubs = known.groupBy("place").agg(
        F.max(F.struct("weight", "node", "n")).alias("hub")
    ).select("place", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    return known.join(hubs, "place").select("place", "node", "n", "size", "hub", "hub_n")


# ---------------------------------------------------------------- sets of some nodes


def _read_again(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, form, name: str) -> DataFrame:
    """(node, `name`) of the wanted nodes: `form` of their sets, from the texts with a wanted id.

    A bitmap of hashed ids, of fixed size, spares the other texts; what it lets through beyond
    the wanted nodes is dropped by the join that follows.
    """
    of = materialise(
        nodes.select("node", "body", "first").join(wanted.distinct(), "node"), "wanted"
    )
    slot = lambda column: F.pmod(F.xxhash64(column), F.lit(SLOTS)).cast("int")
    bits = np.zeros(SLOTS // 8, np.uint8)
    found = of.select(slot("first").alias("slot")).distinct().toPandas()["slot"].to_numpy()
    np.bitwise_or.at(bits, found >> 3, (1 << (found & 7)).astype(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("slot").to_numpy()
            asked = pa.array((bits[at >> 3] >> (at & 7)) & 1 == 1)
            for part in slices(iter([batch.filter(asked)]), ROWS):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays([
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([form(s).tobytes() for s in sets], pa.binary()),
                ], ["body", name])

    read = docs.select("text", slot("doc_id").alias("slot")).mapInArrow(
        run, f"body binary, {name} binary"
    )
    # A node's rows may repeat its smallest id.
    return materialise(
        read.join(of.select("node", "body"), "body").groupBy("node").agg(
            F.first(name).alias(name)
        ), name
    )


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    return _read_again(docs, nodes, wanted, lambda shingles: shingles, "shingles")


def _points(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    return _read_again(docs, nodes, wanted, point_of, "point")


# ---------------------------------------------------------------- links


def _both(pairs: DataFrame, values: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with `columns` of both nodes, as a_... and b_..."""
    for side in ("a", "b"):
        pairs = pairs.join(
            values.select(F.col("node").alias(side),
                          *[F.col(c).alias(f"{side}_{c}") for c in columns]), side
        )
    return pairs


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (a, b) whose points leave a link possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            good = []
            for x, y in zip(*(batch.column(c).to_pylist() for c in ("a_point", "b_point"))):
                one, other = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
                good.append(enough(bound(one, other), len(one), len(other)))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return _both(pairs, points, "point").mapInArrow(run, "a long, b long")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return bool(enough(int((both[1:] == both[:-1]).sum()), len(a), len(b)))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, good) of the pairs: whether they link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            left, right = (batch.column(c).to_pylist() for c in ("a_shingles", "b_shingles"))
            good = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                    for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())],
                ["a", "b", "good"],
            )

    return _both(pairs, sets, "shingles").mapInArrow(run, "a long, b long, good boolean")


_UNIT = ["place", "first", "second"]


def _units(members: DataFrame) -> DataFrame:
    """Members (place, node, n, label) in units of work: a block, or two blocks.

    Members with the label that most of a place have are settled: they need not meet each other,
    so a unit has at least one block of others.
    """
    most = members.groupBy("place", "label").agg(F.count("*").alias("rows")).groupBy("place").agg(
        F.max_by("label", F.struct("rows", "label")).alias("main"), F.count("*").alias("labels")
    ).where("labels > 1")
    members = members.join(most, "place").withColumn("settled", F.col("label") == F.col("main"))

    def blocks(settled: Column) -> Column:
        rows, size = F.count(F.when(settled, 1)), F.sum(F.when(settled, F.col("n")))
        return F.ceil(
            F.greatest(rows / BLOCK, F.coalesce(size, F.lit(0)) * 8 / BLOCK_BYTES)
        ).cast("int")

    counted = members.groupBy("place").agg(
        blocks(~F.col("settled")).alias("open"), blocks(F.col("settled")).alias("closed")
    ).where("open > 0")
    spread = F.xxhash64("node")
    own = F.when(
        F.col("settled"), F.col("open") + F.pmod(spread, F.greatest("closed", F.lit(1)))
    ).otherwise(F.pmod(spread, F.col("open"))).cast("int")
    others = F.when(F.col("settled"), F.col("open")).otherwise(F.col("open") + F.col("closed"))
    return members.join(counted, "place").select(
        "*", own.alias("block"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other")
    ).select(
        "place", F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"), "block", "node", "n", "label",
    )


def _met(unit: tuple, members: list[dict]) -> tuple:
    """The members that meet one of another label and of about their size."""
    size = np.array([m["n"] for m in members])
    label = np.array([m["label"] for m in members])
    side = np.array([m["block"] for m in members])
    order = np.argsort(size, kind="stable")
    size, label, side = size[order], label[order], side[order]
    low = np.searchsorted(100 * size, PERCENT * size)
    high = np.searchsorted(PERCENT * size, 100 * size, "right")
    # Runs of others of that size: all of one label, and in the same block of two, or not.
    same = np.zeros(len(size), bool)
    for values, matters in ((label, True), (side, unit[1] != unit[2])):
        if matters:
            change = np.concatenate([[0], np.cumsum(values[1:] != values[:-1])])
            same |= change[low] == change[high - 1]
    kept = [members[i] for i in np.sort(order[~same])]
    return [unit[0]] * len(kept), [unit[1]] * len(kept), [unit[2]] * len(kept), *(
        [m[c] for m in kept] for c in ("block", "node", "n", "label")
    )


def _in_units(units: DataFrame, work, schema: str) -> DataFrame:
    """`work` on the rows of each unit; it returns rows of `schema` as columns."""
    names = [part.split()[0] for part in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, ROWS):
            yield from batch.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, group in groupby(rows(batches), lambda r: tuple(r[c] for c in _UNIT)):
            columns = work(unit, list(group))
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names
                )

    return units.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "node").mapInArrow(run, schema)


def _pairs_of_unit(unit: tuple, members: list[dict], points) -> tuple[np.ndarray, np.ndarray]:
    """Possible pairs of the unit, as indices of its members; none of one label.

    points: gives the points of the members with these indices.
    """
    side = np.array([m["block"] for m in members])
    label = np.array([m["label"] for m in members])
    size = np.array([m["n"] for m in members])
    sides = [np.flatnonzero(side == block) for block in sorted({unit[1], unit[2]})]
    one, other = sides[0], sides[-1]
    # Who has nobody of about its size to meet needs no point.
    ordered = np.sort(size)
    if not len(one) or not len(other) or (
        len(size) < 2 or (100 * ordered[:-1] < PERCENT * ordered[1:]).all()
    ):
        return one[:0], one[:0]
    first = Points(points(one))
    left, right = possible_pairs(first, Points(points(other)) if len(sides) > 1 else None)
    left, right = one[left], other[right]
    apart = label[left] != label[right]
    return left[apart], right[apart]


def _forest(members: list[dict], pairs: tuple, good) -> tuple[list, list]:
    """Those of the pairs that connect members not connected before, if they are good."""
    parent = {m["label"]: m["label"] for m in members}

    def root(label):
        while parent[label] != label:
            parent[label] = label = parent[parent[label]]
        return label

    a, b = [], []
    for i, j in zip(*(side.tolist() for side in pairs)):
        x, y = root(members[i]["label"]), root(members[j]["label"])
        if x != y and good(i, j):
            parent[x] = y
            a.append(members[i]["node"])
            b.append(members[j]["node"])
    return a, b


def _unit_candidates(unit: tuple, members: list[dict]) -> tuple:
    """Possible pairs of the unit, and whether these are all.

    Where there are many, only those that would connect all that may be similar.
    """
    pairs = _pairs_of_unit(unit, members, lambda at: [
        np.frombuffer(members[i]["point"], np.uint16) for i in at
    ])
    all_ = len(pairs[0]) <= PAIRS * len(members)
    if all_:
        a, b = ([members[i]["node"] for i in side] for side in pairs)
    else:
        a, b = _forest(members, pairs, lambda i, j: True)
    return [unit[0]] * len(a), a, b, [int(all_)] * len(a)


def _unit_links(unit: tuple, members: list[dict]) -> tuple:
    """Links that connect what is similar among the members."""
    sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
    pairs = _pairs_of_unit(unit, members, lambda at: [point_of(sets[i]) for i in at])
    return _forest(members, pairs, lambda i, j: linked(sets[i], sets[j]))


def _checked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """(a, b, good) of pairs, from their sets."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    return materialise(_verified(pairs, _sets(docs, nodes, ends)), name)


def _links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes that are connected by any."""
    places = materialise(_places(nodes), "places")
    sized = (100 * F.least("n", "hub_n")) >= (PERCENT * F.greatest("n", "hub_n"))
    pairs = places.where((F.col("node") != F.col("hub")) & sized).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")
    ).distinct()
    points = _points(docs, nodes, places.select("node"))
    close = materialise(_bounded(pairs, points), "close_pairs")
    links = _checked(docs, nodes, close, "hub_links").where("good").select("a", "b")

    # What else may link: members of a place with different labels.  Places with the same hub have
    # much the same members, as the shingles of similar texts do, and are one from here on.
    labels = components(links)

    # All pairs with the hub have been looked at.
    members = materialise(
        places.where("size > 2 AND node != hub").select(
            F.col("hub").alias("place"), "node", "n"
        ).distinct().join(labels, "node", "left").select(
            "place", "node", "n", F.coalesce("label", "node").alias("label")
        ), "known"
    )
    unit = "place long, first long, second long, block long, node long, n long, label long"
    met = _in_units(_units(members), _met, unit)
    candidates = materialise(_in_units(
        met.join(points, "node"), _unit_candidates, "place long, a long, b long, whole long"
    ), "candidates")
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    more = _checked(docs, nodes, candidates.select(*ordered).distinct(), "more_links")
    links = links.unionByName(more.where("good").select("a", "b"))

    # Where a possible pair turns out to be no link, others may stand in for it: these few
    # places are compared by their sets.
    wrong = candidates.where("whole = 0").select("place", *ordered).join(
        more.where("NOT good"), ["a", "b"], "left_semi"
    ).select("place").distinct()
    rest = materialise(members.join(wrong, "place"), "rest")
    if not rest.limit(1).count():
        return links
    sets = _sets(docs, nodes, rest.select("node"))
    last = _in_units(_units(rest).join(sets, "node"), _unit_links, "a long, b long")
    return links.unionByName(materialise(last, "last_links"))


def shingle_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id."""
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )
    rows = materialise(_rows(named), "rows")
    nodes = materialise(_nodes(named, _common(rows)), "nodes")
    labels = components(_links(named, nodes)).toDF("node", "label")
    labelled = nodes.select("node", "body", "first").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of_body = labelled.join(least, "label").select("body", "component_id")
    documents = rows.where("shingle IS NULL").select("doc_id", "body", "n")
    # Null component ids are of rows without a set, which are on their own, or without any id.
    return documents.join(of_body, "body", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
