"""Operator 2: language-model scores by Brown class n-grams.

Words get classes by exchange clustering, and a text's probability is the product, over its
tokens, of the probability of the token's class after the two classes before it (smoothed
with shorter contexts, Witten-Bell) and of the word within its class.

The work is laid out for a vocabulary that grows with the corpus and fits nowhere whole:

1. Texts are tokenised once into chunks of about `CHUNK_BYTES`: each has its own vocabulary
   and its tokens as places in it.  Later passes read chunks, not texts.
2. Words are counted over all training text.
3. The `SEEDS` most frequent words are clustered by exchange on the driver: each word moves
   to the class that raises the likelihood of the class bigrams most, until none moves.  Their
   bigram counts are a table of at most (SEEDS + 2)^2 numbers, whatever the corpus.
4. Every other word makes one exchange step against these classes: each chunk finds the class
   that suits the word's neighbours in the chunk best and votes for it with the word's count;
   votes are summed per word and class.
5. Count and class of each chunk's words come from a join of chunk vocabularies with the word
   table.  This gives the classes of every text, from which class transitions are counted (a
   table bounded by the number of classes) and scores are made.

A word without count is the unknown word, one event as in the base score.  Its probability
after a class is estimated from the words of count one, so probabilities add up to one.

Defined results: null text is the empty text, which is one end token.  Without training rows
every token but none is unknown, and all scores are 0.  Repeated rows count as often as they
occur.  An empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendlens.llm.common import slices, strings
from vendlens.session import materialise

CHUNK_BYTES = 8 << 20
SEEDS = 1024
CLASSES = 32
ROUNDS = 12       # most rounds of exchange over the seeds
ROWS = 256
# Classes beyond those of words: the end of a text (also what stands before its first
# token), and the unknown word.
END, UNKNOWN = CLASSES, CLASSES + 1
SYMBOLS = CLASSES + 2
_RARE = 128       # added to the class of a token whose word has count one


def tokens(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case (bytes know no other letters and white space)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def _pack_ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, byte planes apart, as high bytes are mostly zero."""
    return _pack(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


# ---------------------------------------------------------------- chunks


def _chunks(docs: DataFrame) -> DataFrame:
    """docs (doc_id, held_out, text) as chunks: see the module's description."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, lengths, places, size = [], [], [], [], 0
        vocabulary: dict[bytes, int] = {}

        def chunk(id_type) -> pa.RecordBatch:
            sequence = np.concatenate(places) if places else np.zeros(0, np.int64)
            train = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(sequence[train], minlength=len(vocabulary))
            return pa.RecordBatch.from_arrays([
                pa.array([uuid.uuid4().int >> 65]), pa.array([ids], pa.list_(id_type)),
                pa.array([held], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int32())),
                pa.array([_pack_ints(sequence)]), pa.array([_pack(b" ".join(vocabulary))]),
                pa.array([_pack_ints(counts)]),
            ], ["chunk", "ids", "held", "lengths", "sequence", "words", "counts"])

        id_type = None
        for batch in slices(batches, ROWS):
            id_type = batch.column("doc_id").type
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(),
                       strings(batch, "text"))
            for doc_id, held_out, text in rows:
                words = tokens(text)
                place = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
                ids.append(doc_id)
                held.append(held_out)
                lengths.append(len(words))
                places.append(np.array(place, np.int64))
                size += len(text)
                if size > CHUNK_BYTES:
                    yield chunk(id_type)
                    ids, held, lengths, places, size = [], [], [], [], 0
                    vocabulary = {}
        if ids:
            yield chunk(id_type)

    return docs.mapInArrow(
        run, f"chunk long, ids array<{kind}>, held array<boolean>, lengths array<int>,"
        " sequence binary, words binary, counts binary"
    )


def _words_of(row: dict) -> list[bytes]:
    joined = _unpack(row["words"])
    return joined.split(b" ") if joined else []


def _vocabularies(chunks: DataFrame) -> DataFrame:
    """(chunk, place, word, count) of the words of each chunk; count is in training text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            words, counts = _words_of(row), _unpack_ints(row["counts"])
            for at in range(0, len(words), 50_000):
                part = words[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), row["chunk"], np.int64)),
                    pa.array(np.arange(at, at + len(part), dtype=np.int32)),
                    pa.array(part, pa.binary()), pa.array(counts[at:at + len(part)]),
                ], ["chunk", "place", "word", "count"])

    return chunks.select("chunk", "words", "counts").mapInArrow(
        run, "chunk long, place int, word binary, count long"
    )


def _train_sequence(row: dict, of_word: np.ndarray, end: int):
    """`of_word` of every training token, with `end` before, between and after the texts.

    Also the place of each token in the chunk's vocabulary, -1 for the ends.
    """
    sequence = _unpack_ints(row["sequence"])
    lengths = np.array(row["lengths"], np.int64)
    train = ~np.array(row["held"], bool)
    chosen = sequence[np.repeat(train, lengths)]
    after = np.cumsum(lengths[train])
    places = np.insert(chosen, np.concatenate([[0], after]), -1)
    return np.where(places < 0, end, of_word[places] if len(of_word) else end), places


# ---------------------------------------------------------------- classes of the seeds


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """`rows` (place int, count long) summed into an array of `size`, which bounds them."""
    found = rows.groupBy("place").agg(F.sum("count").alias("count")).toArrow().to_pandas()
    result = np.zeros(size)
    result[found["place"].to_numpy(np.int64)] = found["count"]
    return result


def _seed_bigrams(chunks: DataFrame, seeds: list[bytes]) -> np.ndarray:
    """Counts of adjacent seeds; two more symbols stand for other words and for ends."""
    size = len(seeds) + 2
    shared = chunks.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(seeds)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = shared.value
        total = np.zeros(size * size, np.int64)
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            of_word = np.array([place_of.get(w, size - 2) for w in _words_of(row)], np.int64)
            symbols, _ = _train_sequence(row, of_word, size - 1)
            total += np.bincount(symbols[:-1] * size + symbols[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "count"]
        )

    columns = chunks.select("held", "lengths", "sequence", "words")
    counted = columns.mapInArrow(run, "place int, count long")
    return _summed(counted, size * size).reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of the first len(bigrams) - 2 symbols by exchange clustering.

    The last two symbols, other words and ends, stay in classes of their own.
    """
    words = len(bigrams) - 2
    of = np.concatenate([np.arange(words) % classes, [classes, classes + 1]])
    size = classes + 2
    member = np.zeros((len(bigrams), size))
    member[np.arange(len(bigrams)), of] = 1
    table = member.T @ bigrams @ member
    for _ in range(rounds):
        moved = 0
        for w in range(words):
            old = of[w]
            own = bigrams[w, w]
            after = np.bincount(of, bigrams[w], minlength=size)
            before = np.bincount(of, bigrams[:, w], minlength=size)
            after[old] -= own
            before[old] -= own
            table[old, :] -= after
            table[:, old] -= before
            table[old, old] -= own
            row, column = table.sum(axis=1), table.sum(axis=0)
            base = _xlogx(table)
            rows_gain = _xlogx(table + after[None, :]) - base
            columns_gain = _xlogx(table + before[:, None]) - base
            diagonal = np.diagonal(table)
            gain = (
                rows_gain.sum(axis=1) - np.diagonal(rows_gain)
                + columns_gain.sum(axis=0) - np.diagonal(columns_gain)
                + _xlogx(diagonal + after + before + own) - _xlogx(diagonal)
                - _xlogx(row + after.sum() + own) + _xlogx(row)
                - _xlogx(column + before.sum() + own) + _xlogx(column)
            )[:classes]
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            moved += new != old
            of[w] = new
            table[new, :] += after
            table[:, new] += before
            table[new, new] += own
        if not moved:
            break
    return of[:words]


# ---------------------------------------------------------------- classes of all words


def _votes(chunks: DataFrame, seeds: list[bytes], of_seed: np.ndarray, bigrams: np.ndarray
           ) -> DataFrame:
    """(word, class, count): for which class each chunk votes, and how often it has the word."""
    of = np.concatenate([of_seed, [CLASSES, CLASSES + 1]])
    member = np.zeros((len(bigrams), SYMBOLS))
    member[np.arange(len(bigrams)), of] = 1
    table = member.T @ bigrams @ member + 0.1
    # How likely a class (column) is to have this neighbour (row) before it, and after it.
    before = np.log(table / table.sum(axis=0, keepdims=True))[:, :CLASSES]
    after = np.log(table / table.sum(axis=1, keepdims=True)).T[:, :CLASSES]
    known = dict(zip(seeds, of_seed.tolist()))
    shared = chunks.sparkSession.sparkContext.broadcast(
        (known, before.astype(np.float32), after.astype(np.float32))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, left, right = shared.value
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            words = _words_of(row)
            # Class of seeds; CLASSES stands for other words, CLASSES + 1 for ends.
            of_word = np.array([class_of.get(w, CLASSES) for w in words], np.int64)
            symbols, places = _train_sequence(row, of_word, CLASSES + 1)
            at = np.flatnonzero(symbols == CLASSES)
            fits = np.zeros((len(words), CLASSES), np.float32)
            for start in range(0, len(at), 1 << 16):
                part = at[start:start + (1 << 16)]
                part = part[np.argsort(places[part], kind="stable")]
                word, first = np.unique(places[part], return_index=True)
                suits = left[symbols[part - 1]] + right[symbols[part + 1]]
                fits[word] += np.add.reduceat(suits, first, axis=0)
            chosen = np.where(of_word < CLASSES, of_word, fits.argmax(axis=1))
            counts = _unpack_ints(row["counts"])
            seen = np.flatnonzero(counts)
            for start in range(0, len(seen), 50_000):
                part = seen[start:start + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([words[i] for i in part], pa.binary()),
                    pa.array(chosen[part].astype(np.int32)), pa.array(counts[part]),
                ], ["word", "class", "count"])

    columns = chunks.select("held", "lengths", "sequence", "words", "counts")
    return columns.mapInArrow(run, "word binary, class int, count long")


def _word_table(votes: DataFrame) -> DataFrame:
    """(word, count, class) of every word of the training text."""
    summed = votes.groupBy("word", "class").agg(F.sum("count").alias("votes"))
    # Most votes, then the smaller class.
    best = F.max(F.struct("votes", (-F.col("class")).alias("class")))
    return summed.groupBy("word").agg(F.sum("votes").alias("count"), best.alias("best")).select(
        "word", "count", (-F.col("best.class")).alias("class")
    )


# ---------------------------------------------------------------- texts as classes


@dataclass
class Totals:
    """What the scores need of the whole corpus; a bounded number of figures."""

    tokens: int          # training tokens, ends included
    distinct: int        # different ones
    texts: int           # training texts, the count of the end token
    of_class: np.ndarray


def _classed(chunks: DataFrame, words: DataFrame, totals: Totals) -> DataFrame:
    """Per text: its counts, base score, log10 of words within classes, and class bytes."""
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    wanted = _vocabularies(chunks).select("chunk", "place", "word")
    found = wanted.join(words, "word").select("chunk", "place", "count", "class")
    n, v, ends = totals.tokens, totals.distinct, totals.texts
    of_class = totals.of_class

    def run(chunk: pd.DataFrame, looked_up: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "within", "classes"]
        if not len(chunk):
            return pd.DataFrame(columns=names)
        row = chunk.iloc[0]
        size = len(_words_of(row))
        count, classes = np.zeros(size, np.int64), np.full(size, UNKNOWN, np.int64)
        place = looked_up["place"].to_numpy(np.int64)
        count[place] = looked_up["count"]
        classes[place] = looked_up["class"]
        base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
        within = np.where(count > 0, np.log10(np.maximum(count, 1) / of_class[classes]), 0.0)
        stored = (classes + _RARE * (count == 1)).astype(np.uint8)
        end_base = np.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        sequence = _unpack_ints(row["sequence"])
        rows, at = [], 0
        for doc_id, held, length in zip(row["ids"], row["held"], row["lengths"]):
            own = sequence[at:at + length]
            at += length
            rows.append((
                doc_id, held, length + 1, int((count[own] > 0).sum()) + (ends > 0),
                float(base[own].sum() + end_base), float(within[own].sum()),
                stored[own].tobytes(),
            ))
        return pd.DataFrame(rows, columns=names)

    grouped = chunks.select("chunk", "ids", "held", "lengths", "sequence", "words")
    return grouped.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInPandas(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double,"
        " within double, classes binary"
    )


# ---------------------------------------------------------------- transitions


def _events(classes: bytes):
    """Of each token and the end: its class, the two contexts before it, and whether rare.

    A context is a class, END before the first token; a word of count one or none is UNKNOWN
    as a context.
    """
    stored = np.frombuffer(classes, np.uint8).astype(np.int64)
    rare = stored >= _RARE
    own = np.where(rare, stored - _RARE, stored)
    context = np.concatenate([[END, END], np.where(rare, UNKNOWN, own)])
    return np.append(own, END), context[:-1], context[1:], np.append(rare, False)


def _transitions(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class trigram counts of training texts, and rare words' counts by the class before."""
    size = SYMBOLS ** 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + SYMBOLS, np.int64)
        for batch in slices(batches, ROWS):
            for classes in batch.column("classes").to_pylist():
                own, second, first, rare = _events(classes)
                np.add.at(total, (second * SYMBOLS + first) * SYMBOLS + own, 1)
                np.add.at(total, size + first[rare], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "count"]
        )

    train = texts.where("NOT held_out").select("classes")
    found = _summed(train.mapInArrow(run, "place int, count long"), size + SYMBOLS)
    return found[:size].reshape(SYMBOLS, SYMBOLS, SYMBOLS), found[size:]


def transition_logs(trigrams: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """log10 P(class | two contexts); the last class is the unknown word.

    For each pair of contexts the probabilities of all classes add up to one.
    """
    known = SYMBOLS - 1  # the unknown word is no event of training text

    def blend(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        total = counts.sum(axis=-1, keepdims=True)
        kinds = (counts > 0).sum(axis=-1, keepdims=True)
        return (counts + kinds * shorter) / np.maximum(total + kinds, 1) + (total == 0) * shorter

    events = trigrams[..., :known]
    uniform = np.full(known, 1 / known)
    one = blend(events.sum(axis=(0, 1)), uniform)
    two = blend(events.sum(axis=0), one)
    three = blend(events, two)
    seen = events.sum(axis=(0, 2))
    overall = (rare.sum() + 1) / (seen.sum() + 2)
    unknown = (rare + 10 * overall) / (seen + 10)
    unknown = np.broadcast_to(unknown[None, :, None], (SYMBOLS, SYMBOLS, 1))
    return np.log10(np.concatenate([three * (1 - unknown), unknown], axis=-1))


# ---------------------------------------------------------------- the operator


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text"
              ) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The model learns from the rows for which `held_out` is false.
    """
    named = docs.select(
        F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text")
    )
    chunks = materialise(_chunks(named), "chunks")
    counted = _vocabularies(chunks).where("count > 0").groupBy("word").agg(
        F.sum("count").alias("count")
    )
    seeds = [bytes(r["word"]) for r in counted.orderBy(F.desc("count"), "word").limit(SEEDS)
             .collect()]
    bigrams = _seed_bigrams(chunks, seeds)
    of_seed = exchange(bigrams)
    words = materialise(_word_table(_votes(chunks, seeds, of_seed, bigrams)), "words")

    texts = chunks.select(F.size(F.filter("held", lambda h: ~h)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0))
    ).first()[0]
    by_class = words.groupBy("class").agg(F.sum("count").alias("n"), F.count("*").alias("v"))
    of_class, distinct = np.ones(SYMBOLS), int(texts > 0)
    total = texts
    for row in by_class.collect():
        of_class[row["class"]] = row["n"]
        distinct += row["v"]
        total += row["n"]
    totals = Totals(total, distinct, texts, of_class)

    classed = materialise(_classed(chunks, words, totals), "texts")
    logs = transition_logs(*_transitions(classed))
    shared = docs.sparkSession.sparkContext.broadcast(logs)
    kind = named.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, ROWS):
            scores = []
            for classes, within in zip(batch.column("classes").to_pylist(),
                                       batch.column("within").to_pylist()):
                own, second, first, _ = _events(classes)
                scores.append(float(table[second, first, own].sum() + within) if total else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")]
                + [pa.array(np.full(batch.num_rows, total, np.int64)),
                   batch.column("base_score"), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                 "score"],
            )

    return classed.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double"
    )
