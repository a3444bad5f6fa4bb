"""Operator 1: byte-pair encoding and decoding with a given vocabulary.

A text is cut at special tokens, then into chunks (a run of other characters with at most one
space before it, or white space), chunks into pieces, and pieces are merged: a heap holds
the rank of each adjacent pair of a doubly linked list of symbols; the lowest rank is merged
first, leftmost first among equals, and entries whose symbols have changed since are skipped.
Decoding concatenates the vocabulary's strings and reads them as UTF-8.

The vocabulary file is read on the driver and broadcast: its size is that of a tokenizer's
file.  It is checked against `MAX_VOCABULARY_BYTES`.  Tasks keep bounded caches of chunks and
pieces.

Defined results: null text is the empty text, which has no ids and decodes to the empty
text.  Rows are independent, so repeated rows and ids give repeated results.  Special tokens'
strings in a text become their ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendlens.llm.common import Cache, slices, strings

MAX_VOCABULARY_BYTES = 64 << 20
CACHED = 500_000  # entries of each cache in a task
ROWS = 512        # texts held as Python objects at a time

# Fixed value: how byte-level vocabularies of this format split text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the characters of Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# White space other than space and line feed.
_RARE_WHITE = re.compile("[\\t\\x0b-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def byte_characters() -> list[str]:
    """The character that stands for each byte in vocabularies of this format.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, for the
    characters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Codec:
    """A vocabulary, ready to encode and decode."""

    def __init__(self, description: str):
        parsed = json.loads(description)
        vocabulary: dict[str, int] = parsed["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        characters = byte_characters()
        byte_of = {c: b for b, c in enumerate(characters)}

        def raw(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        self.byte_ids = [vocabulary[c] for c in characters]
        # Per rank the ids of both symbols and of the merged one; ranks by both ids as one key.
        self.by_rank = [
            (vocabulary[left], vocabulary[right], vocabulary[left + right])
            for left, right in parsed["model"]["merges"]
        ]
        self.ranks = {left << 32 | right: r for r, (left, right, _) in enumerate(self.by_rank)}
        self.strings = [b""] * (1 + max([*vocabulary.values(), *specials.values()]))
        for token, token_id in vocabulary.items():
            self.strings[token_id] = raw(token)
        for token, token_id in specials.items():
            self.strings[token_id] = token.encode()
        self.special_ids = {t: np.uint32(i).tobytes() for t, i in specials.items()}
        longest_first = sorted(specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.pieces = regex.compile(PIECES)
        self.chunks = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self.of_piece = Cache(self.merge, CACHED)
        self.of_chunk = Cache(self._chunk, CACHED)
        # The same for a space and what follows it up to the next one.
        self.of_spaced = Cache(lambda word: self._chunk(" " + word), CACHED)

    def _chunk(self, chunk: str) -> bytes:
        found = self.pieces.findall(chunk)
        return b"".join([self.of_piece[piece] for piece in found])

    def merge(self, piece: str) -> bytes:
        """The ids of one piece, as little-endian unsigned 32-bit integers."""
        symbols = [self.byte_ids[b] for b in piece.encode("utf-8")]
        n, rank_of, by_rank = len(symbols), self.ranks.get, self.by_rank
        if n > 1:
            after = [*range(1, n), -1]
            before = [*range(-1, n - 1)]
            # Entries are a rank and the place of its left symbol in one number.
            heap = [
                rank << 32 | i for i in range(n - 1)
                if (rank := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None
            ]
            heapify(heap)
            while heap:
                entry = heappop(heap)
                i = entry & 0xFFFFFFFF
                left, right, merged = by_rank[entry >> 32]
                j = after[i]
                if j < 0 or symbols[i] != left or symbols[j] != right:
                    continue  # stale: one of the two symbols is gone or has grown
                symbols[i], symbols[j] = merged, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    rank = rank_of(merged << 32 | symbols[k])
                    if rank is not None:
                        heappush(heap, rank << 32 | i)
                h = before[i]
                if h >= 0:
                    rank = rank_of(symbols[h] << 32 | merged)
                    if rank is not None:
                        heappush(heap, rank << 32 | h)
            symbols = [s for s in symbols if s >= 0]
        return pack(f"<{len(symbols)}I", *symbols)

    def _plain(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        if (
            "  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or _RARE_WHITE.search(text)
        ):
            return b"".join(map(self.of_chunk.__getitem__, self.chunks.findall(text)))
        # White space is single spaces and line feeds, so chunks are what lies between.
        encoded, feed = [], self.of_chunk["\n"]
        for line in text.split("\n"):
            words = line.split(" ")
            if words[0]:
                encoded.append(self.of_chunk[words[0]])
            encoded.extend(map(self.of_spaced.__getitem__, words[1:]))
            encoded.append(feed)
        return b"".join(encoded[:-1])

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        parts = self.special.split(text) if self.special_ids else [text]
        return b"".join(
            self.special_ids[part] if i % 2 else self._plain(part)
            for i, part in enumerate(parts)
        )

    def decode(self, ids: bytes) -> str:
        symbols = np.frombuffer(ids, dtype="<u4").tolist()
        joined = b"".join(map(self.strings.__getitem__, symbols))
        return joined.decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def _codec(description: str) -> Codec:
    return Codec(description)


def vocabulary(docs: DataFrame, path: str) -> Broadcast:
    """The vocabulary file, broadcast; refused beyond a fixed size."""
    with open(path, encoding="utf-8") as file:
        description = file.read(MAX_VOCABULARY_BYTES)
        if file.read(1):
            raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY_BYTES} bytes: {path}")
    return docs.sparkSession.sparkContext.broadcast(description)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """Rows of id and `ids` (binary, little-endian unsigned 32-bit integers).

    With `decoded`, also the text that `decode` makes of the ids, in the same pass.
    """
    shared = vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in slices(batches, ROWS):
            ids = [codec.encode(text) for text in strings(batch, "text")]
            columns = {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary())}
            if decoded:
                columns["text"] = pa.array([codec.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    named = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    schema = f"doc_id {_kind(named)}, ids binary" + ", text string" * decoded
    return named.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows of id, `ids` and the decoded `text`; the inverse of `encode`."""
    shared = vocabulary(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in slices(batches, ROWS):
            texts = [codec.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                ["doc_id", "ids", "text"],
            )

    named = encoded.select("doc_id", "ids")
    return named.mapInArrow(run, f"doc_id {_kind(named)}, ids binary, text string")


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests of ids and decoded texts."""
    return decoded.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )
