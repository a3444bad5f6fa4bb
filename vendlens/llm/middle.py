"""Operator 13: fill-in-middle, with cuts found by a wavelet matrix over character classes.

A text is cut into units; each ends with a character of certain classes, the last one perhaps
without.  Two draws from the hash of the id name the units after which prefix and middle end,
and the three parts are written in one of two orders behind marks.

The characters of a slice of texts, as classes, are one wavelet matrix: a bit vector with
counts per bit of the class, each level stably sorted by the bit above.  The boundaries before
a place are the ranks of the ending classes there, added up; a cut is the first place at which
they reach the drawn unit, found for all texts of the slice at once by bisection on ranks.

A text that already holds a mark, and an empty one, stay as they are (`plain`), so that
`restored` gives back every text exactly.

Defined results: null text is the empty text; a null id draws as the empty id; rows that
repeat an id draw alike.  Units of a very long text cost no more memory than its characters.
An empty table gives an empty result.  Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"  # fixed values: the marks
SEED = 7

# Character classes, and the classes that end a unit.
OTHER, NEWLINE, SPACE, STOP = range(4)
_BITS = 2
UNITS = {
    "lines": (NEWLINE,),
    "words": (NEWLINE, SPACE),
    "sentences": (NEWLINE, STOP),
    "characters": (OTHER, NEWLINE, SPACE, STOP),
}
_CLASS_OF = np.zeros(65536, np.uint8)  # the last entry stands for all characters beyond
_CLASS_OF[[ord(c) for c in " \t\x0b\x0c\r"]] = SPACE
_CLASS_OF[[ord(c) for c in ".!?。！？"]] = STOP
_CLASS_OF[ord("\n")] = NEWLINE

_SLICE_CHARS = 1 << 20  # characters of one wavelet matrix; a longer text has its own
_WORD = 64


class BitVector:
    """Bits with a count before each 64 of them."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(len(bits) // _WORD * 8 + 8, np.uint8)
        small = np.packbits(bits, bitorder="little")
        packed[:len(small)] = small
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = place // _WORD, (place % _WORD).astype(np.uint64)
        part = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(part)


class WaveletMatrix:
    """Ranks of symbols of `bits` bits in a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int = _BITS):
        self.bits, self.levels = bits, []
        for shift in reversed(range(bits)):
            bit = (symbols >> shift) & 1
            vector = BitVector(bit)
            zeros = len(symbols) - int(bit.sum())
            self.levels.append((vector, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before each place."""
        first = np.zeros(1, np.int64)
        for level, (vector, zeros) in enumerate(self.levels):
            if symbol >> (self.bits - 1 - level) & 1:
                first, place = zeros + vector.ones(first), zeros + vector.ones(place)
            else:
                first, place = first - vector.ones(first), place - vector.ones(place)
        return place - first

    def boundaries(self, symbols: tuple[int, ...], place: np.ndarray) -> np.ndarray:
        """How often any of the symbols occurs before each place."""
        return sum(self.rank(symbol, place) for symbol in symbols)

    def reach(self, symbols: tuple[int, ...], count: np.ndarray, low: np.ndarray,
              high: np.ndarray) -> np.ndarray:
        """The first place from low to high before which there are `count` boundaries."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            middle = (low + high) // 2
            enough = self.boundaries(symbols, middle) >= count
            high = np.where(enough, middle, high)
            low = np.where(enough | (low >= high), low, middle + 1)
        return high


def locate(texts: list[str], draws: list[np.ndarray],
           ends: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and where prefix and middle end, in characters of the text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    classes = _CLASS_OF[np.minimum(points, len(_CLASS_OF) - 1)]
    length = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(length)
    start = stop - length
    matrix = WaveletMatrix(classes)
    before = matrix.boundaries(ends, start)
    units = matrix.boundaries(ends, stop) - before
    ended = np.zeros(len(texts), bool)
    some = length > 0
    ended[some] = np.isin(classes[stop[some] - 1], ends)
    units += some & ~ended
    after = np.sort([draw % (units + 1) for draw in draws], axis=0)
    # The last unit may have no boundary: then its end, `stop`, is what bisection arrives at.
    cuts = [matrix.reach(ends, before + k, start, stop) - start for k in after]
    return units, cuts[0], cuts[1]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in runs of rows whose texts have about `_SLICE_CHARS` characters."""
    for batch in batches:
        first, chars, texts = 0, 0, []
        for row, value in enumerate(batch.column("text")):
            text = value.as_py() or ""
            if texts and chars + len(text) > _SLICE_CHARS:
                yield batch.slice(first, row - first), texts
                first, chars, texts = row, 0, []
            texts.append(text)
            chars += len(text)
        if texts:
            yield batch.slice(first), texts


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   unit: str = "lines", seed: int = SEED, percent: int = 100,
                   spm_percent: int = 50) -> DataFrame:
    """One row per row of `docs`: doc_id, n, form, prefix_chars, middle_chars, output.

    Of 100 texts about `percent` are transformed, and of these about `spm_percent` have the
    suffix first; the others stay plain or have the prefix first.
    """
    ends = UNITS[unit]
    digest = F.sha2(F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    ).cast("binary"), 256)
    draws = [
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
        for i in range(4)
    ]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _pieces(batches):
            h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in range(1, 5))
            units, first, second = locate(texts, [h1, h2], ends)
            forms, outputs = [], []
            for text, a, b, chance, side in zip(
                texts, first.tolist(), second.tolist(), h3 % 100, h4 % 100
            ):
                marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
                if not text or marked or chance >= percent:
                    forms.append("plain")
                    outputs.append(text)
                elif side < spm_percent:
                    forms.append("spm")
                    outputs.append("".join(
                        [SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]]
                    ))
                else:
                    forms.append("psm")
                    outputs.append("".join(
                        [PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]]
                    ))
            plain = np.array(forms) == "plain"
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(units, pa.int64()), pa.array(forms),
                pa.array(first, pa.int64(), mask=plain),
                pa.array(second - first, pa.int64(), mask=plain), pa.array(outputs, pa.string()),
            ], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *draws
    ).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, "
             "output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from; its parts hold no mark, so they fall apart at marks."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(
        form == "spm", F.concat(parts[2], parts[3], parts[1])
    ).otherwise(output)


def digests(formed: DataFrame) -> DataFrame:
    """The same rows with hashes of the output and of the text rebuilt from it."""
    return formed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256)
        .alias("restored_sha256"),
    )


# DuckDB SQL for the query over `documents`.
SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
    FROM documents),
numbered AS (
    SELECT doc_id, text, lines, len(lines) AS n,
           ('0x' || substr(h, 1, 8))::BIGINT % (len(lines) + 1) AS k1,
           ('0x' || substr(h, 9, 8))::BIGINT % (len(lines) + 1) AS k2,
           ('0x' || substr(h, 25, 8))::BIGINT % 100 AS side
    FROM drawn),
cut AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                  OR contains(text, '<M>') THEN 'plain'
                WHEN side < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(lines[1:least(k1, k2)], '') AS p,
           array_to_string(lines[least(k1, k2) + 1:greatest(k1, k2)], '') AS m,
           array_to_string(lines[greatest(k1, k2) + 1:], '') AS s
    FROM numbered)
SELECT doc_id, n, form,
       CASE WHEN form != 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form != 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
