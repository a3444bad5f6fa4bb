"""Operator 4: packing documents into sequences, large items first, then best fit.

Documents become ids, documents longer than a sequence are cut into pieces.  How pieces are
packed depends on their lengths alone, and there are no more lengths than a sequence has
tokens.  So the number of pieces of each length is counted, a plan is made from these counts
(bounded by the capacity, whatever the size of the corpus), and each piece finds its place
from its rank among the pieces of its length:

* lengths above a third of the capacity: at most two of them fit beside each other in any
  good packing, so each is matched greedily, longest first, with the longest partner that
  still fits;
* the rest, longest first, go to the tightest gap that holds them, then to new sequences.

Ranks are counted per bucket of documents and offset by the buckets before, so no length is
gathered in one task, however many pieces share it.

Defined results: null text is the empty text, whose only id is the end id.  Repeated rows are
packed as often as they occur.  An empty table gives no sequences.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendlens.llm.bpe import _kind, byte_characters, vocabulary
from vendlens.llm.common import Cache, slices, strings, tidy
from vendlens.session import materialise

CAPACITY = 4096
END_ID = 1
CACHED = 100_000         # words and parts a task remembers the ids of
CACHED_ALONE = 500_000   # the same where no other operator shares the executors
ROWS = 512
BUCKETS = 64  # groups of documents whose ranks are counted apart, per shuffle partition

# ---------------------------------------------------------------- ids


class WordEncoder:
    """Ids by a vocabulary that drops white space, word by word with a bounded cache."""

    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        specials = [t["content"] for t in json.loads(description)["added_tokens"]]
        self.special = os.path.commonprefix(specials)
        self.words = re.compile(r"[^ \t-\r]+")
        self.of_word = Cache(self._word, CACHED)
        self.of_part = Cache(self._part, CACHED)
        self.characters = byte_characters()
        self.letters = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")

    def remember(self, cached: int) -> None:
        self.of_word.entries = self.of_part.entries = cached

    def forget(self) -> None:
        self.of_word.clear()
        self.of_part.clear()

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        """Ids of a part that the vocabulary neither cuts nor changes but for lower case."""
        symbols = "".join([self.characters[b] for b in part.lower().encode("utf-8")])
        ids = [token.id for token in self.tokenizer.model.tokenize(symbols)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        """Ids of a word; signs after a word of Latin letters are a part of their own."""
        core = word.rstrip(",.")
        signs = word[len(core):]
        if self.letters.fullmatch(core):
            return self.of_part[core] + self.of_part[signs] if signs else self.of_part[core]
        return self._library(word)

    def encode(self, text: str) -> bytes:
        # White space is dropped and ends a word, so words can be encoded apart.  Lower case
        # comes first where it is certain to be what the vocabulary's normaliser does: not for a
        # final sigma, nor where it makes two characters of one, which are then put in order.
        if (
            self.special not in text and "Σ" not in text and "İ" not in text
            and unicodedata.is_normalized("NFC", text)
        ):
            text = text.lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            # White space for split(), but not for the vocabulary.
            words = self.words.findall(text)
        else:
            words = text.split()
        return b"".join(map(self.of_word.__getitem__, words))


@lru_cache(maxsize=2)
def _encoder(description: str) -> WordEncoder:
    return WordEncoder(description)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, checksums: bool = False,
           alone: bool = False) -> DataFrame:
    """Rows of doc_id, piece, start, length and ids (binary) for every piece.

    With `checksums`, `ids_crc32` takes the place of the ids.  `alone` says that no other
    operator shares the executors: more words are remembered, and from task to task.
    """
    shared = vocabulary(docs, path)
    kinds = {"ids": pa.binary(), "ids_crc32": pa.int64()}
    last = "ids_crc32" if checksums else "ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(shared.value), end_id.to_bytes(4, "little")
        encoder.remember(CACHED_ALONE if alone else CACHED)
        for batch in slices(batches, ROWS):
            rows, numbers, starts, ids = [], [], [], []
            for row, text in enumerate(strings(batch, "text")):
                whole = encoder.encode(text) + end
                for number, start in enumerate(range(0, len(whole) // 4, capacity)):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    ids.append(whole[4 * start:4 * (start + capacity)])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([zlib.crc32(i) for i in ids] if checksums else ids, kinds[last]),
            ], ["doc_id", "piece", "start", "length", last])
        if not alone:
            encoder.forget()

    named = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    return named.mapInArrow(
        run if alone else tidy(run), f"doc_id {_kind(named)}, piece int, start long, length long, "
        + ("ids_crc32 long" if checksums else "ids binary")
    )


# ---------------------------------------------------------------- the plan


class Plan:
    """Runs of equal pieces and where they go.

    A run says: of the pieces of `length`, those with rank `first` to `last` (excluded) go to
    sequences from `sequence` on, `each` to a sequence, the first of them at `offset`.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self._rank: dict[int, int] = defaultdict(int)
        # gap -> [(first sequence, how many)], and the gaps in order
        self._open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self._gaps: list[int] = []

    def _place(self, length: int, sequence: int, sequences: int, each: int, offset: int
               ) -> None:
        first = self._rank[length]
        last = first + sequences * each
        self.runs.append((length, first, last, sequence, each, offset))
        self._rank[length] = last

    def _new(self, sequences: int) -> int:
        self.sequences += sequences
        return self.sequences - sequences

    def _leave(self, sequence: int, sequences: int, gap: int) -> None:
        if gap:
            if not self._open[gap]:
                bisect.insort(self._gaps, gap)
            self._open[gap].append((sequence, sequences))

    def match(self, first: int, second: int | None, sequences: int) -> None:
        """New sequences that hold a piece of `first` and, if given, one of `second`."""
        start = self._new(sequences)
        self._place(first, start, sequences, 1, 0)
        if second is not None:
            self._place(second, start, sequences, 1, first)
        self._leave(start, sequences, self.capacity - first - (second or 0))

    def best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self._gaps, length)
            if at < len(self._gaps):
                gap = self._gaps[at]
                start, sequences = self._open[gap].pop()
                if not self._open[gap]:
                    del self._gaps[at]
            else:
                gap = self.capacity
                sequences = -(-count // (gap // length))
                start = self._new(sequences)
            # The sequence just used is now the tightest, so it takes as many as fit.
            each = gap // length
            filled = min(sequences, count // each)
            if filled:
                self._place(length, start, filled, each, self.capacity - gap)
                self._leave(start, filled, gap - each * length)
                count -= filled * each
            rest, start = sequences - filled, start + filled
            if rest and 0 < count < each:
                self._place(length, start, 1, count, self.capacity - gap)
                self._leave(start, 1, gap - count * length)
                rest, start, count = rest - 1, start + 1, 0
            if rest:
                self._leave(start, rest, gap)


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    """`counts`: pieces of each length; at most `capacity` entries."""
    plan, left = Plan(capacity), dict(counts)
    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        longest = large[-1]
        at = bisect.bisect_right(large, capacity - longest)
        partner = large[at - 1] if at else None
        if partner == longest and left[longest] == 1:
            partner = large[at - 2] if at > 1 else None
        if partner is None:
            number = left[longest]
        elif partner == longest:
            number = left[longest] // 2
        else:
            number = min(left[longest], left[partner])
        plan.match(longest, partner, number)
        for used in [longest] + [partner] * (partner is not None):
            left[used] -= number
        large = [length for length in large if left[length]]
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        plan.best_fit(length, left[length])
    return plan


# ---------------------------------------------------------------- placing


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`cut` (doc_id, piece, start, length, ...) with sequence_id and offset.

    `cut` is read more than once and has to be stored.
    """
    spark = cut.sparkSession
    counts = {
        row["length"]: row["count"] for row in cut.groupBy("length").count().collect()
    }  # at most `capacity` rows
    runs = make_plan(counts, capacity).runs
    plan = spark.createDataFrame(
        runs or [(0, 0, 0, 0, 1, 0)],
        "length long, first_rank long, last_rank long, first_sequence long, each long,"
        " first_offset long",
    )
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(buckets)).alias("bucket")
    split = cut.select("*", bucket)
    before = Window.partitionBy("length").orderBy("bucket")
    offsets = split.groupBy("length", "bucket").agg(F.count("*").alias("pieces")).select(
        "length", "bucket", (F.sum("pieces").over(before) - F.col("pieces")).alias("before")
    )
    others = [c for c in cut.columns if c not in ("doc_id", "piece", "start", "length")]
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", *others)
    ranked = split.withColumn("inside", F.row_number().over(inside)).join(
        offsets, ["length", "bucket"]
    ).withColumn("rank", F.col("before") + F.col("inside") - 1)
    # The plan has a few rows per length, and no more lengths than a sequence has tokens.
    placed = ranked.join(F.broadcast(plan), "length").where(
        "rank >= first_rank AND rank < last_rank"
    )
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        *cut.columns,
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("long")
        .alias("sequence_id"),
        (F.col("first_offset") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long")
        .alias("offset"),
    )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its ids, sequence and offset."""
    return place(materialise(pieces(docs, path, capacity=capacity), "pieces"), capacity)


def pack_places(docs: DataFrame, path: str, capacity: int = CAPACITY, alone: bool = False
                ) -> DataFrame:
    """As `pack`, with the ids' checksum in place of the ids, which are not moved."""
    cut = pieces(docs, path, capacity=capacity, checksums=True, alone=alone)
    return place(materialise(cut, "pieces"), capacity)
