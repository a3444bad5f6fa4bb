"""Operator 10: near duplicates by Order MinHash, verified by banded alignment.

A text is its words in lower case; its k-mers are runs of five words, each labelled with the
number of times it occurred before, so that every labelled k-mer is unique in its text (a
text of fewer words is one k-mer).  Two texts are near duplicates if their k-mer sequences
align with at least `SIMILARITY`: matched pairs in common order, over all k-mers of either.

1. Texts with the same words are one text from here on, the one with the smallest id.
2. Order MinHash: each of `SKETCHES` hash functions samples the `SAMPLED` smallest labelled
   k-mers; these, in the order in which they stand in the text, are a bucket.  Texts as
   similar as `SIMILARITY` miss each other in all buckets about once in a million.
3. Each bucket has a hub, its member that shares most buckets with others.  Members are
   aligned with their hub: one pair per member, each pair once.
4. Buckets in which members are not connected to their hub by then are compared completely,
   inside tasks: members meet in blocks of at most `BLOCK` texts, exact k-mer overlaps of a
   block are one matrix product, and pairs that overlap enough are aligned.  So no link among
   candidates is lost, no pair leaves a task but verified links, and no group is unbounded.
5. Connected components over the verified links are the classes, by joins of labels.

Alignment is banded: labelled k-mers are unique, so matches are pairs of places, and the
longest chain of matches in common order is a longest increasing subsequence; matches farther
off the diagonal than the allowed differences can shift them are not looked at.

Defined results: a class's id is its smallest document id, which stays; null ids come last.
Null text is the empty text; texts without words are compared by their signs, and empty ones
are equal.  Of rows that repeat the staying id with the same text one stays.  An empty table
gives an empty result.  Other columns of the input are not looked at.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendlens.llm.common import Cache, slices, strings, tidy
from vendlens.session import materialise

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 20
SAMPLED = 3
BLOCK = 512
CACHED = 150_000
ROWS = 256

_WORD = re.compile(r"\w+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(10).integers(1, 2**63, SKETCHES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(chunk: str) -> bytes:
    """64-bit hashes of the words of a run of characters without white space."""
    return b"".join([xxhash.xxh3_64_digest(w) for w in _WORD.findall(chunk)])


class Shingler:
    """Word hashes and labelled k-mers of texts, with a bounded cache of words."""

    def __init__(self):
        self.of_chunk = Cache(_hash_words, CACHED)

    def words(self, text: str) -> np.ndarray:
        chunks = text.lower().split()
        joined = b"".join(map(self.of_chunk.__getitem__, chunks))
        if not joined:  # no letter or digit
            joined = b"".join([xxhash.xxh3_64_digest(c) for c in chunks])
        return np.frombuffer(joined, np.uint64)

    def kmers(self, words: np.ndarray) -> np.ndarray:
        """Labelled k-mers in text order; all different."""
        if not len(words):
            return np.zeros(0, np.uint64)
        length = max(1, len(words) - WORDS + 1)
        hashes = np.full(length, np.uint64(min(len(words), WORDS)))
        for i in range(min(len(words), WORDS)):
            hashes = _mix(hashes * _PRIME + words[i:i + length])
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        if new.all():
            return hashes
        place = np.arange(length)
        label = np.empty(length, np.uint64)
        label[order] = place - np.maximum.accumulate(np.where(new, place, 0))
        return np.where(label > 0, _mix(hashes + label * _PRIME), hashes)


def sketch(kmers: np.ndarray) -> np.ndarray:
    """One bucket per hash function: its smallest labelled k-mers in text order."""
    buckets = np.zeros(SKETCHES, np.uint64)
    sampled = min(SAMPLED, len(kmers))
    for i, seed in enumerate(_SEEDS):
        values = _mix(kmers ^ seed)
        if len(kmers) > sampled:
            at = np.sort(np.argpartition(values, sampled - 1)[:sampled])
        else:
            at = np.arange(sampled)
        combined = seed
        for kmer in kmers[at]:
            combined = _mix(np.array([combined * _PRIME + kmer], np.uint64))[0]
        buckets[i] = combined
    return buckets.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sequences of labelled k-mers align well enough."""
    total = len(a) + len(b)
    if not total:
        return True
    needed = similarity * total / (1 + similarity) - 1e-9  # matches
    if min(len(a), len(b)) < needed:
        return False
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = total - 2 * needed
    near = np.abs(at_a - at_b) <= band
    if near.sum() < needed:
        return False
    at_b = at_b[near][np.argsort(at_a[near])]
    if (np.diff(at_b) > 0).all():
        return True
    ends: list[int] = []  # smallest last place of a chain of each length
    for place in at_b.tolist():
        at = bisect.bisect_left(ends, place)
        ends[at:at + 1] = [place]
    return len(ends) >= needed


# ---------------------------------------------------------------- texts and buckets


def _sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, body, n, buckets): `body` is a 128-bit hash of all words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        with np.errstate(over="ignore"):
            for batch in slices(batches, ROWS):
                bodies, sizes, buckets = [], [], []
                for text in strings(batch, "text"):
                    words = shingler.words(text)
                    kmers = shingler.kmers(words)
                    bodies.append(xxhash.xxh3_128_digest(words.tobytes()))
                    sizes.append(len(kmers))
                    buckets.append(sketch(kmers) if len(kmers) else [])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(bodies, pa.binary()),
                    pa.array(sizes, pa.int64()), pa.array(buckets, pa.list_(pa.int64())),
                ], ["doc_id", "body", "n", "buckets"])

    return docs.mapInArrow(tidy(run), f"doc_id {kind}, body binary, n long, buckets array<long>")


def _kmers_of(docs: DataFrame) -> DataFrame:
    """(body, kmers) of each different text; labelled k-mers as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        with np.errstate(over="ignore"):
            for batch in slices(batches, ROWS):
                words = [shingler.words(text) for text in strings(batch, "text")]
                kmers = [shingler.kmers(w).astype(np.uint32).tobytes() for w in words]
                bodies = [xxhash.xxh3_128_digest(w.tobytes()) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bodies, pa.binary()), pa.array(kmers, pa.binary())],
                    ["body", "kmers"],
                )

    return docs.mapInArrow(tidy(run), "body binary, kmers binary").dropDuplicates(["body"])


def _unique(kmers: bytes) -> np.ndarray:
    """K-mers of a text; 32-bit numbers that collide within it are dropped but for one."""
    found = np.frombuffer(kmers, np.uint32)
    values, first = np.unique(found, return_index=True)
    return found if len(values) == len(found) else found[np.sort(first)]


def _alike(n, m):
    """Whether texts of n and m k-mers can be similar at all."""
    return F.least(n, m) >= SIMILARITY * F.greatest(n, m)


# ---------------------------------------------------------------- links


def _verified(pairs: DataFrame, kmers: DataFrame) -> DataFrame:
    """The pairs (a, b) of texts that align."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            good = [aligned(_unique(x), _unique(y)) for x, y in zip(left, right)]
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    left, right = kmers.toDF("a", "left"), kmers.toDF("b", "right")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a binary, b binary"
    )


def _block_links(members: list[dict]) -> list[tuple]:
    """Links between components among the texts of one unit; see the module's description."""
    cross = members[0]["first"] != members[0]["second"]
    sides = np.array([m["block"] for m in members])
    kmers = [_unique(m["kmers"]) for m in members]
    sizes = np.array([len(k) for k in kmers], float)
    owner = np.repeat(np.arange(len(kmers)), sizes.astype(int))
    values, column, held_by = np.unique(
        np.concatenate(kmers), return_inverse=True, return_counts=True
    )
    # Overlaps by matrix products, for the k-mers that more than one text has.
    shared = np.flatnonzero(held_by > 1)
    number = np.full(len(values), -1)
    number[shared] = np.arange(len(shared))
    overlap = np.zeros((len(kmers), len(kmers)), np.float32)
    at = number[column]
    for start in range(0, len(shared), 4096):
        inside = (at >= start) & (at < start + 4096)
        part = np.zeros((len(kmers), 4096), np.float32)
        part[owner[inside], at[inside] - start] = 1
        overlap += part @ part.T
    similar = overlap >= SIMILARITY * (sizes[:, None] + sizes[None, :] - overlap) - 1e-6
    parent: dict = {m["label"]: m["label"] for m in members}

    def root(label):
        while parent[label] != label:
            parent[label] = label = parent[parent[label]]
        return label

    links = []
    for i, j in np.argwhere(np.triu(similar, 1)):
        if cross and sides[i] == sides[j]:
            continue
        x, y = root(members[i]["label"]), root(members[j]["label"])
        if x != y and aligned(kmers[i], kmers[j]):
            parent[x] = y
            links.append((members[i]["label"], members[j]["label"]))
    return links


def _complete(members: DataFrame, kmers: DataFrame) -> DataFrame:
    """Links (a, b) between labels, from comparing all members of each bucket.

    members: (bucket, body, label, size).  A bucket is cut into blocks of about BLOCK, and
    each pair of blocks is a unit of work.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("body"), blocks).cast("int")
    units = members.select("*", own.alias("block"), blocks.alias("blocks")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "bucket", "body", "label", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
    )
    unit = ["bucket", "first", "second"]
    ordered = units.join(kmers, "body").repartition(*unit).sortWithinPartitions(*unit, "body")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, ROWS):
            yield from batch.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows(batches), lambda r: tuple(r[c] for c in unit)):
            links = _block_links(list(group))
            if links:
                ends = [pa.array(side, pa.binary()) for side in zip(*links)]
                yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return ordered.mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b); label is the component's smallest node.

    Labels are lowered along links, then replaced by their own labels, until none changes;
    each round is stored, so a lost executor costs no earlier round.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = materialise(both.toDF("a", "b"), "links")
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
            "node", F.least("node", "b").alias("label")
        ), "labels"
    )
    while True:
        lower = both.join(
            labels.select(F.col("node").alias("b"), "label"), "b"
        ).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("lowest"))
        lowered = labels.join(lower, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "lowest").alias("label")
        )
        up = lowered.select(F.col("node").alias("label"), F.col("label").alias("above"))
        after = materialise(
            lowered.join(up, "label").select(
                "node", F.least("label", "above").alias("label"), "old"
            ), "labels"
        )
        labels = after.select("node", "label")
        if not after.where("label != old").limit(1).count():
            return labels


# ---------------------------------------------------------------- the operator


def with_body(docs: DataFrame, name: str) -> DataFrame:
    """`docs` with the hash of the words of `text`, by which `decisions` knows a text."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, ROWS):
            words = [shingler.words(text) for text in strings(batch, "text")]
            bodies = pa.array([xxhash.xxh3_128_digest(w.tobytes()) for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, bodies], [*columns, name])

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema, T.StructField(name, T.BinaryType())]))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, class_size, kept."""
    # Rows that repeat an id with the same text are counted, and given back one by one.
    return decisions(docs, id_col, text_col).select(
        "*", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")
    ).select(
        "doc_id", "class_id", "class_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept")
    )


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per id and text: doc_id, body, copies, class_id, class_size, stays.

    `copies` rows have the id and the text; if it `stays`, one of them does.
    """
    named = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    base = materialise(_sketched(named), "sketches")
    # Rows with the same words are one text, known by the hash of its words.
    same = materialise(
        base.groupBy("body").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"),
            F.first("n").alias("n"), F.first("buckets").alias("buckets"),
        ), "same"
    )
    entries = same.select("body", "doc_id", "n", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = materialise(entries.join(shared, "bucket"), "members")
    labels = components(_links(named, members)).toDF("body", "label")
    labelled = same.select("body", "doc_id", "rows").join(labels, "body", "left").withColumn(
        "label", F.coalesce("label", "body")
    )
    classes = labelled.groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.sum("rows").alias("class_size"),
        # The text that the staying row has, should other texts share its id.
        F.min_by("body", F.struct(F.col("doc_id").isNull(), "doc_id", "body")).alias("keeps"),
    )
    of_body = labelled.select("body", "label").join(classes, "label").drop("label")
    counted = base.groupBy("doc_id", "body").agg(F.count("*").alias("copies"))
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("body") == F.col("keeps"))
    return counted.join(of_body, "body").select(
        "doc_id", "body", "copies", "class_id", "class_size", stays.alias("stays")
    )


def _links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Verified links (a, b) that connect what is similar among members of buckets."""
    # K-mers of the texts that share a bucket with another.  A merge join whatever the sizes,
    # so that the step costs the same at every scale.
    ids = members.select(F.col("doc_id").alias("member")).distinct()
    wanted = docs.hint("merge").join(
        ids, F.col("doc_id").eqNullSafe(F.col("member")), "left_semi"
    )
    kmers = materialise(_kmers_of(wanted), "kmers")

    # A hub shares most buckets with others; the smaller id among equals.
    weight = members.groupBy("body").agg(F.sum("size").alias("weight"))
    rank = F.struct(-F.col("weight"), F.col("doc_id").isNull(), "doc_id", "body")
    hubs = members.join(weight, "body").groupBy("bucket").agg(
        F.min_by(F.struct("body", "n"), rank).alias("hub")
    ).select("bucket", F.col("hub.body").alias("hub"), F.col("hub.n").alias("hub_n"))
    placed = materialise(members.join(hubs, "bucket").drop("doc_id"), "placed")
    pairs = placed.where(
        (F.col("body") != F.col("hub")) & _alike(F.col("n"), F.col("hub_n"))
    ).select(
        F.least("body", "hub").alias("a"), F.greatest("body", "hub").alias("b")
    ).distinct()
    links = materialise(_verified(pairs, kmers), "hub_links")

    # Members that are not connected to their hub: their buckets are compared completely.
    labels = components(links)

    def labelled(df: DataFrame, column: str, name: str) -> DataFrame:
        of = labels.select(F.col("node").alias(column), F.col("label").alias(name))
        return df.join(of, column, "left").withColumn(name, F.coalesce(name, column))

    known = materialise(
        labelled(labelled(placed, "body", "label"), "hub", "hub_label"), "labelled"
    )
    open_ = known.where("size > 2").groupBy("bucket").agg(
        F.max(F.col("label") != F.col("hub_label")).alias("open")
    ).where("open").select("bucket")
    rest = known.join(open_, "bucket").select("bucket", "body", "label", "size")
    return links.unionByName(materialise(_complete(rest, kmers), "more_links"))
