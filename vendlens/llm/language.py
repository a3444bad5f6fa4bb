"""Operator 3: language identification by interpolated Kneser-Ney character models.

Each language has a character model of order `ORDER` over words (runs of letters, lower case,
with marks for their start and end).  N-grams are counted over all training text by tasks
that first count words, so each different word of a task is cut into n-grams once.  Counts
are summed by Spark, per language and hash of the n-gram; the hash has `BITS` bits, so a model
has at most ORDER x 2^BITS n-grams, however much text there was.  That bounds what reaches the
driver and what is broadcast; the number of languages is checked.

Per order, the hashes of all languages are one sorted array, with a row of log probabilities
and backoff weights per hash, so one binary search serves all languages.

A text's score in a language is its cross-entropy per character; the language with the lowest
is chosen (the first by name among equals).  On all training documents, two numbers are
calibrated: the sharpness that turns cross-entropies into a probability, and per language the
cross-entropy beyond which a text is rejected as none of the languages.  That is half-way from a
high quantile of the language's different texts to a text of random symbols.  The quantile is
over the texts that state the language and are found to be in it, or, if there are none, over all
that state it; it comes from counts per step of `STEP`, which Spark sums.

Defined results: a text that is null or has no letter is `und`, score 0, rejected.  Training
rows without text or language are left out; without any training row all texts are `und`.
Repeated rows count as often as they occur.  An empty table gives an empty result.  Other
columns are kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendlens.llm.common import free_name, slices, strings, tidy
from vendlens.session import materialise

ORDER = 5
BITS = 20
MAX_LANGUAGES = 64
REJECT_QUANTILE = 0.999  # of the different texts of a language
STEP = 1 / 256           # of the cross-entropies that the quantile is taken of
SHARPNESSES = np.geomspace(1, 100, 25)
CACHED = 150_000         # words whose scores a task keeps
CACHED_ALONE = 400_000   # the same where no other operator shares the executors
COUNTED = 200_000        # words a task counts before it cuts them into n-grams
CUT = 20_000             # of these at a time
ROWS = 512
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+")
_START, _END = 1, 2  # code points that are in no word
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(any(c.isalpha() for c in word) for word in words)


# ---------------------------------------------------------------- n-grams of words


def _symbols(words: list[str]):
    """Code points of all words with their marks, and the place of each in its word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    joined = "".join([f"\x01{w}\x02" for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    return codes, place, np.repeat(np.arange(len(words)), lengths)


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order, the hash of the n symbols that end at each position, unmixed."""
    found = [codes * _PRIME]
    for _ in range(1, order):
        shorter = np.concatenate([[np.uint64(0)], found[-1][:-1]])
        found.append((shorter ^ (shorter >> np.uint64(29))) * _PRIME + codes * _PRIME)
    return found


def _key(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def _grams(words: list[str], weights: np.ndarray):
    """(order, key, prefix's key, suffix's key, whether initial, weight) of words' n-grams.

    A few words at a time, so that little memory is needed; their sums are merged.
    """
    parts = [[] for _ in range(ORDER)]
    for at in range(0, len(words), CUT):
        for n, found in enumerate(_cut(words[at:at + CUT], weights[at:at + CUT])):
            parts[n].append(found)
    for n, found in enumerate(parts, start=1):
        key, prefix, suffix, initial, total = map(np.concatenate, zip(*found))
        key, first, back = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(back, total, minlength=len(key)).astype(np.int64)
        yield n, key, prefix[first], suffix[first], initial[first], total


def _cut(words: list[str], weights: np.ndarray):
    codes, place, word = _symbols(words)
    keys = [_key(h) for h in _hashes(codes, ORDER)]
    for n in range(1, ORDER + 1):
        at = np.flatnonzero(place >= max(n - 1, 1))  # the start mark is never predicted
        prefix = keys[n - 2][at - 1] if n > 1 else np.zeros(len(at), np.int64)
        suffix = keys[n - 2][at] if n > 1 else np.zeros(len(at), np.int64)
        key, first, back = np.unique(keys[n - 1][at], return_index=True, return_inverse=True)
        total = np.bincount(back, weights[word[at]], minlength=len(key)).astype(np.int64)
        # No symbol can stand before an n-gram that begins with the start mark.
        yield key, prefix[first], suffix[first], (place[at] == n - 1)[first], total


def _gram_counts(train: DataFrame) -> DataFrame:
    """(lang, n, key, prefix, suffix, initial, count) over all of `train` (text, lang)."""
    schema = "lang string, n int, key int, prefix int, suffix int, initial boolean, count long"

    def emit(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in counts.items():
            words = list(counter)
            if not words:
                continue
            weights = np.fromiter(counter.values(), np.float64, len(words))
            for n, key, prefix, suffix, initial, total in _grams(words, weights):
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(key), pa.string()),
                    pa.array(np.full(len(key), n, np.int32)),
                    *[pa.array(a.astype(np.int32)) for a in (key, prefix, suffix)],
                    pa.array(initial), pa.array(total),
                ], ["lang", "n", "key", "prefix", "suffix", "initial", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in slices(batches, ROWS):
            for text, lang in zip(strings(batch, "text"), batch.column("lang").to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > COUNTED:
                yield from emit(counts)
                counts = {}
        yield from emit(counts)

    return train.mapInArrow(tidy(run), schema).groupBy("lang", "n", "key").agg(
        F.min("prefix").alias("prefix"), F.min("suffix").alias("suffix"),
        F.min("initial").alias("initial"), F.sum("count").alias("count"),
    )


_START_KEY = int(_key(_hashes(np.array([_START], np.uint64), 1)[0])[0])


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """Sorted hash arrays per order, for all languages together."""

    languages: list[str]
    keys: list[np.ndarray]      # per order, sorted
    log_p: list[np.ndarray]     # per order, keys x languages; NaN where not seen
    backoff: list[np.ndarray]   # per order, log weight of the next order's backoff
    unknown: np.ndarray         # per language, log probability of an unseen symbol
    sharpness: float = 10.0
    limits: np.ndarray | None = None

    def score(self, words: list[str]) -> np.ndarray:
        """Words x (languages + 1): natural log probabilities, then predicted symbols."""
        codes, place, word = _symbols(words)
        size = len(self.languages)
        log_p = np.tile(self.unknown, (len(codes), 1))
        context = None
        for n, hashes in enumerate(_hashes(codes, ORDER), start=1):
            keys = self.keys[n - 1]
            wanted = _key(hashes)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            held = (keys[at] == wanted) & (place >= n - 1)
            found = np.where(held[:, None], self.log_p[n - 1][at], np.nan)
            if n > 1:
                weight = np.zeros_like(log_p)
                weight[1:] = context[:-1]
                log_p = log_p + weight * (place >= n - 1)[:, None]
            log_p = np.where(np.isnan(found), log_p, found)
            context = np.where(held[:, None], self.backoff[n - 1][at], 0.0)
        log_p[place == 0] = 0.0
        result = np.empty((len(words), size + 1))
        for i in range(size):
            result[:, i] = np.bincount(word, log_p[:, i], minlength=len(words))
        result[:, size] = np.bincount(word, place > 0, minlength=len(words))
        return result


def _kneser_ney(rows: dict[int, dict[str, np.ndarray]]):
    """One language: per order (keys, log p, backoff), and the unseen symbol's log p."""
    space = 1 << BITS
    continued = {}
    for n in range(1, ORDER):  # in how many different ways an n-gram is continued to the left
        continued[n] = np.bincount(rows[n + 1]["suffix"], minlength=space)
    tables, lower, unknown = [], None, 0.0
    for n in range(1, ORDER + 1):
        key, prefix, suffix = (rows[n][c] for c in ("key", "prefix", "suffix"))
        count = rows[n]["count"].astype(float)
        if n < ORDER:
            left = continued[n][key]
            count = np.where((left > 0) & ~rows[n]["initial"], left, count)
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.1, ones / max(1.0, ones + 2.0 * twos)))
        total = np.bincount(prefix, count, minlength=space)
        kinds = np.bincount(prefix, minlength=space)
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(total > 0, discount * kinds / total, 1.0)
        if n == 1:
            unknown = weight[0] / (len(key) + 1)
            below = np.full(len(key), 1 / (len(key) + 1))
        else:
            below = np.maximum(lower[suffix], unknown)
            # The weight belongs to the prefix, an n-gram of the order below.
            tables[-1][2] = np.log(weight[tables[-1][0]])
        p = (count - discount) / total[prefix] + weight[prefix] * below
        lower = np.zeros(space)
        lower[key] = p
        tables.append([key, np.log(p), np.zeros(len(key))])
        if n == 1 and not (key == _START_KEY).any():
            # The start mark is a context, but never predicted.
            at = np.searchsorted(key, _START_KEY)
            tables[0] = [np.insert(c, at, v) for c, v in zip(tables[0], (_START_KEY, np.nan, 0))]
    return tables, np.log(unknown)


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang",
        calibrated: bool = True) -> Model | None:
    """A model of all rows of `train` that have text and language; None if there are none.

    Its limits come from scoring these texts, unless it is to be `calibrated` later.
    """
    named = train.selectExpr(f"`{text_col}` AS text", f"CAST(`{lang_col}` AS string) AS lang")
    named = named.where("text IS NOT NULL AND lang IS NOT NULL")
    # At most ORDER x 2^BITS rows per language.
    counted = _gram_counts(named).toArrow().to_pandas()
    languages = sorted(counted["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages, more than {MAX_LANGUAGES}")
    made, kept = {}, []
    for lang in languages:
        mine = counted[counted["lang"] == lang].sort_values(["n", "key"])
        rows = {n: {c: g[c].to_numpy() for c in ("key", "prefix", "suffix", "initial", "count")}
                for n, g in mine.groupby("n")}
        empty = {c: np.zeros(0, bool if c == "initial" else np.int64)
                 for c in ("key", "prefix", "suffix", "initial", "count")}
        made[lang] = _kneser_ney({n: rows.get(n, empty) for n in range(1, ORDER + 1)})
        kept.append(lang)
    if not kept:
        return None
    keys, log_p, backoff = [], [], []
    for n in range(ORDER):
        union = np.unique(np.concatenate([made[lang][0][n][0] for lang in kept] + [[0]]))
        p = np.full((len(union), len(kept)), np.nan, np.float32)
        b = np.zeros((len(union), len(kept)), np.float32)
        for i, lang in enumerate(kept):
            own, values, weights = made[lang][0][n]
            at = np.searchsorted(union, own)
            p[at, i], b[at, i] = values, weights
        keys.append(union.astype(np.int64))
        log_p.append(p)
        backoff.append(b)
    unknown = np.array([made[lang][1] for lang in kept])
    model = Model(kept, keys, log_p, backoff, unknown)
    if calibrated:
        _calibrate(model, named)
    return model


def _calibrate(model: Model, train: DataFrame) -> None:
    """Sharpness and limits from cross-entropies of all training documents.

    train: (text, lang), or (hash, entropies, lang) of texts that are scored already.
    """
    # SHARPNESSES, and at most 2 x languages x steps of cross-entropies.
    summed = _cross_entropies(train, model).toArrow().to_pandas().sort_values("step")
    losses = summed[summed["kind"] == _LOSS]["amount"].to_numpy()
    if len(losses):
        model.sharpness = float(SHARPNESSES[losses.argmin()])
    model.limits = np.empty(len(model.languages))
    for i in range(len(model.languages)):
        mine = summed[summed["lang"] == i]
        texts = mine[mine["kind"] == mine["kind"].max()]
        usual = 0.0  # of a language whose texts have no letter
        if len(texts):
            upto = texts["amount"].cumsum().to_numpy()
            last = np.searchsorted(upto, REJECT_QUANTILE * upto[-1])
            usual = texts["step"].iloc[last] * STEP
        random = np.log(1 + np.isfinite(model.log_p[0][:, i]).sum())
        model.limits[i] = max(usual, (usual + random) / 2)


_LOSS, _STATED, _FOUND = 0, 1, 2


def _cross_entropies(train: DataFrame, model: Model) -> DataFrame:
    """(kind, lang, step, amount): what is known of the documents' cross-entropies.

    _LOSS: the sum of all documents' losses, per sharpness.  _FOUND and _STATED: the number of
    different texts that state a language, per step of their cross-entropy in it, where it is
    the chosen one and where it is not.
    """
    shared = train.sparkSession.sparkContext.broadcast(model)
    known = "entropies" in train.columns
    columns = ["kind", "lang", "step", "hash", "amount"]

    def made(kind, lang, step, hashes, amount) -> pa.RecordBatch:
        ints = [pa.array(a.astype(np.int32)) for a in (kind, lang, step)]
        return pa.RecordBatch.from_arrays([*ints, hashes, pa.array(amount)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        number = {lang: i for i, lang in enumerate(shared.value.languages)}
        losses = None
        for batch in slices(batches, ROWS):
            if known:
                found = batch.column("entropies").to_pylist()
            else:
                found = scorer.entropies(strings(batch, "text"))
            held = [i for i, e in enumerate(found) if e is not None]
            if not held:
                continue
            batch = batch.take(pa.array(held))
            entropies = np.array([found[i] for i in held])
            row = np.arange(len(held))
            stated = np.array([number[lang] for lang in batch.column("lang").to_pylist()])
            if losses is None:
                losses = np.zeros(len(SHARPNESSES))
            for i, sharpness in enumerate(SHARPNESSES):
                logits = -sharpness * entropies
                logits -= logits.max(axis=1, keepdims=True)
                losses[i] += (np.log(np.exp(logits).sum(axis=1)) - logits[row, stated]).sum()
            kind = np.where(entropies.argmin(axis=1) == stated, _FOUND, _STATED)
            step = np.ceil(entropies[row, stated] / STEP)
            yield made(kind, stated, step, batch.column("hash"), np.ones(len(held)))
        if losses is not None:
            at = np.arange(len(losses))
            none = np.full(len(losses), -1)
            yield made(np.full(len(losses), _LOSS), none, at, pa.array(none), losses)

    named = train if known else train.select("text", "lang", F.xxhash64("text").alias("hash"))
    scored = named.mapInArrow(
        tidy(run), "kind int, lang int, step int, hash long, amount double"
    )
    # Copies of a text are one.
    texts = scored.groupBy("kind", "lang", "step", "hash").agg(F.sum("amount").alias("amount"))
    amount = F.when(F.col("kind") == _LOSS, F.col("amount")).otherwise(1.0)
    return texts.groupBy("kind", "lang", "step").agg(F.sum(amount).alias("amount"))


# ---------------------------------------------------------------- scoring


class Scorer:
    """Scores of words, kept for the next texts."""

    def __init__(self, model: Model, cached: int | None = None):
        self.model, self.cached = model, cached
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.languages) + 1))

    def entropies(self, texts: list[str]) -> list[np.ndarray | None]:
        """Cross-entropy per character in each language; None for texts without a letter."""
        split = [words_of(text) for text in texts]
        new = list(set().union(*split) - self.place.keys())
        if len(self.place) + len(new) > (self.cached or CACHED):
            self._reset()
            new = list(set().union(*split))
        start = len(self.place)
        while start + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            self.table[start + at:start + at + len(part)] = self.model.score(part)
        self.place.update(zip(new, range(start, start + len(new))))
        result = []
        for words in split:
            if not has_letter(words):
                result.append(None)
                continue
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            total = self.table[at].sum(axis=0)
            result.append(-total[:-1] / total[-1])
        return result


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred, score (0 to 1) and rejected appended.

    A column of `docs` that has one of these names keeps it; the new one gets an underscore.
    """
    names = [free_name(docs, c) for c in ("lang_pred", "score", "rejected")]
    if model is None:
        return docs.withColumns(dict(zip(names, (F.lit(UNKNOWN), F.lit(0.0), F.lit(True)))))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        scorer = Scorer(known)
        for batch in slices(batches, ROWS):
            yield _decided(batch, scorer.entropies(strings(batch, text_col)), known, names)

    return docs.mapInArrow(tidy(run), _with_decision(docs, names))


def _with_decision(docs: DataFrame, names: list[str]) -> T.StructType:
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    return T.StructType([*docs.schema, *[T.StructField(n, k) for n, k in zip(names, kinds)]])


def _decided(batch: pa.RecordBatch, found: list, model: Model, names: list[str]):
    """The batch with language, score and rejection, from the cross-entropies of its rows."""
    rows = []
    for entropies in found:
        if entropies is None:
            rows.append((UNKNOWN, 0.0, True))
            continue
        best = int(entropies.argmin())
        odds = np.exp(-model.sharpness * (entropies - entropies[best]))
        rows.append((model.languages[best], float(1 / odds.sum()),
                     bool(entropies[best] > model.limits[best])))
    langs, scores, rejected = zip(*rows)
    return pa.RecordBatch.from_arrays([
        *batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
        pa.array(rejected, pa.bool_()),
    ], [*batch.schema.names, *names])


def learn_and_identify(docs: DataFrame, train: Column, id_col: str = "doc_id",
                       text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, trained, lang_pred, score, rejected) of each row, by a model of the rows `train`.

    Each text is scored once: its cross-entropies are stored without it, and both the limits and
    the decisions come from them.
    """
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("trained"),
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
    )
    model = fit(named.where("trained"), calibrated=False)
    kept = ["doc_id", "trained", "lang_pred", "score", "rejected"]
    if model is None:
        return identify(named, None).select(*kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, CACHED_ALONE)
        for batch in slices(batches, ROWS):
            found = scorer.entropies(strings(batch, "text"))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in narrow),
                pa.array([None if e is None else e.tolist() for e in found],
                         pa.list_(pa.float64())),
            ], [*narrow, "entropies"])

    narrow = ["doc_id", "trained", "lang", "hash"]
    hashed = named.withColumn("hash", F.xxhash64("text"))
    schema = T.StructType([*hashed.select(*narrow).schema,
                           T.StructField("entropies", T.ArrayType(T.DoubleType()))])
    scored = materialise(hashed.select(*narrow, "text").mapInArrow(score, schema), "entropies")
    _calibrate(model, scored.where("trained AND lang IS NOT NULL").select(
        "lang", "hash", "entropies"
    ))
    limits = SimpleNamespace(
        languages=model.languages, sharpness=model.sharpness, limits=model.limits
    )
    names = ["lang_pred", "score", "rejected"]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            found = [None if e is None else np.array(e)
                     for e in batch.column("entropies").to_pylist()]
            yield _decided(batch, found, limits, names)

    return scored.mapInArrow(decide, _with_decision(scored, names)).select(*kept)
