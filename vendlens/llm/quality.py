"""Operator 6: document quality by a classifier and hierarchical empirical Bayes.

The classifier is a logistic regression on a few figures of a text: shares of upper case and
signs, repetition, word lengths, and how strongly its words point to rejected documents.  The
latter come from counts, per hash of a word or of the beginning of a longer word, of the
labelled documents that hold it; hashes have `BITS` bits, so the table is bounded.  The classifier is fitted on a bounded sample of
`TRAIN_ROWS` labelled documents; their own counts are left out of their figures.

Sites come in levels, such as host, then path within host.  At each level the classifier's
evidence is summed per site over all documents, by grouped aggregation.  A site's posterior
shares of good documents is shrunk towards that of the level above, the first towards the
global share, with a strength taken from how much sites differ beyond chance.  So sparse sites
follow their parent.  A document's odds are then corrected by its own site's odds over the
global odds.

Defined results: null text is the empty text.  A null site is a site of its own.  A label row
without quality is left out; of several for one document the worst counts.  Without labels of
both kinds nothing is known, and every document is kept with score 0.5.  Repeated rows are
scored alike.  An empty table gives an empty result.  Other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendlens.llm.common import Cache, bounded_sample, free_name, slices, strings, tidy
from vendlens.session import materialise

TRAIN_ROWS = 20_000   # most labelled documents the classifier is fitted on
BITS = 18             # of a word's hash
PRIOR_DOCS = 5.0      # documents of evidence against a word's telling anything
STEM = 5              # letters of a longer word that are looked up as its beginning
TELLING = (1.0, 2.0)  # log odds from which a word counts as a sign, and as a strong one
KEEP_FROM = 0.5       # posterior from which a document is kept
CACHED = 150_000
ROWS = 512

_WORD = re.compile(r"\w+")
# Classes of characters up to U+024F; others count as lower-case letters.
_UPPER, _LOWER, _DIGIT, _SPACE, _SIGN = range(5)


def _classes() -> np.ndarray:
    classes = np.full(0x251, _SIGN, np.int8)
    for code in range(0x250):
        c = chr(code)
        if c.isspace():
            classes[code] = _SPACE
        elif c.isupper():
            classes[code] = _UPPER
        elif c.isalpha():
            classes[code] = _LOWER
        elif c.isdigit():
            classes[code] = _DIGIT
    classes[0x250] = _LOWER
    return classes


_CLASSES = _classes()


def bucket(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - BITS)


def words_in(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def buckets(word: str) -> tuple[int, ...]:
    """The buckets of a word and, if it is longer, of its beginning."""
    return (bucket(word), bucket(word[:STEM] + "-")) if len(word) > STEM else (bucket(word),)


def shape(text: str) -> list[float]:
    """Figures of a text that need no counts."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.bincount(_CLASSES[np.minimum(codes, 0x250)], minlength=5)
    letters = max(1, found[_UPPER] + found[_LOWER])
    visible = max(1, len(codes) - found[_SPACE])
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    longest = run = 0
    before = None
    for word in words:
        run = run + 1 if word == before else 1
        longest, before = max(longest, run), word
    most = max(counts.values(), default=0)
    bare = sum(v for w, v in counts.items() if len(w) < 4 and not any(map(str.isalnum, w)))
    return [
        np.log1p(len(words)), found[_UPPER] / letters, found[_SIGN] / visible,
        found[_DIGIT] / visible, len(counts) / n, np.log1p(len(counts)) / np.log1p(n),
        longest / n, np.log1p(longest), most / n, bare / n, visible / n / 10,
        found[_UPPER] / n,
    ]


def signs(odds: np.ndarray) -> list[float]:
    """How strongly a text's words, given their log odds, point to rejected documents."""
    top = np.zeros(8)
    highest = np.sort(odds)[-8:]
    top[8 - len(highest):] = highest
    counts = [np.log1p((odds > least).sum()) for least in TELLING]
    return [top[-1], top[-3:].mean(), top.mean(), *counts]


def log_odds(bad: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
    """Shrunken log odds of a rejected document given a word, over the odds without it."""
    p = (bad + PRIOR_DOCS * share) / (bad + good + PRIOR_DOCS)
    return np.log(p / (1 - p)) - np.log(share / (1 - share))


# ---------------------------------------------------------------- fitting


@dataclass
class Model:
    bad: np.ndarray     # per bucket, rejected training documents with a word of it
    good: np.ndarray
    share: float        # of rejected documents
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, figures: np.ndarray) -> np.ndarray:
        x = np.clip((figures - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.ones(len(x)), x, x * x]) @ self.weights


def label_table(labels: DataFrame) -> DataFrame:
    """(doc_id, good): good is quality without toxicity."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min(
            ((F.col("quality") > 0) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
        ).alias("good")
    )


def _word_counts(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        places = Cache(buckets, CACHED)
        for batch in slices(batches, ROWS):
            for text, good in zip(strings(batch, "text"), batch.column("good").to_pylist()):
                held = {at for w in words_in(text) for at in places[w]}
                counts[good, np.fromiter(held, np.int64, len(held))] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(counts[0, at]), pa.array(counts[1, at])],
            ["bucket", "bad", "good"],
        )

    summed = train.mapInArrow(tidy(run), "bucket int, bad long, good long").groupBy("bucket").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    ).toArrow().to_pandas()  # at most 2^BITS rows
    bad, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bad[summed["bucket"]], good[summed["bucket"]] = summed["bad"], summed["good"]
    return bad, good


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
        ) -> Model | None:
    """A classifier from a bounded sample of labelled documents; None without both kinds."""
    sample = bounded_sample(label_table(labels), F.col("doc_id"), TRAIN_ROWS)
    texts = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    # At most TRAIN_ROWS pairs of numbers.
    train = materialise(texts.join(F.broadcast(sample), "doc_id").select("text", "good"), "train")
    kinds = {r["good"]: r["count"] for r in train.groupBy("good").count().collect()}
    if len(kinds) < 2:
        return None
    share = kinds[0] / (kinds[0] + kinds[1])
    bad, good = _word_counts(train)
    shared = train.sparkSession.sparkContext.broadcast((bad, good))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_bad, all_good = shared.value
        places = Cache(buckets, CACHED)
        for batch in slices(batches, ROWS):
            found = []
            truth = batch.column("good").to_pylist()
            for text, is_good in zip(strings(batch, "text"), truth):
                pairs = [(p[0], p[-1]) for p in map(places.__getitem__, words_in(text))]
                at = np.array(pairs, np.int64).reshape(-1, 2)
                odds = log_odds(all_bad[at] - (not is_good), all_good[at] - is_good, share)
                odds = odds.max(axis=1)
                found.append(shape(text) + signs(odds))
            yield pa.RecordBatch.from_arrays([
                pa.array(found, pa.list_(pa.float64())), pa.array(truth, pa.int32()),
            ], ["figures", "good"])

    table = train.mapInArrow(tidy(run), "figures array<double>, good int").toArrow().to_pandas()
    figures = np.array(table["figures"].tolist())
    order = np.lexsort(figures.T)  # the same sums whatever order the rows came in
    figures, truth = figures[order], table["good"].to_numpy()[order]
    mean, scale = figures.mean(axis=0), figures.std(axis=0) + 1e-6
    model = Model(bad, good, share, mean, scale, np.zeros(1 + 2 * figures.shape[1]))
    x = np.clip((figures - mean) / scale, -8, 8)
    model.weights = _logistic(np.column_stack([np.ones(len(x)), x, x * x]), truth)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method with step halving."""
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(w):
        z = x @ w
        return np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(penalty * w * w)

    now = loss(weights)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        move = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-4 and (then := loss(weights - size * move)) > now:
            size /= 2
        if size <= 1e-4 or now - then < 1e-9 * abs(now):
            break
        weights, now = weights - size * move, then
    return weights


# ---------------------------------------------------------------- scoring


def evidence(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """`docs` with the classifier's log odds of a good document as column `name`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        table = log_odds(known.bad, known.good, known.share)
        odds = Cache(lambda word: max(table[at] for at in buckets(word)), CACHED)
        for batch in slices(batches, ROWS):
            figures = []
            for text in strings(batch, text_col):
                words = words_in(text)
                figures.append(shape(text) + signs(
                    np.fromiter(map(odds.__getitem__, words), np.float64, len(words))
                ))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(known.logit(np.array(figures)))], [*columns, name]
            )

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema, T.StructField(name, T.DoubleType())]))


def _logit(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(bounded / (1 - bounded))


def _posteriors(scored: DataFrame, logit: str, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Per site of the last level: its columns as s0, s1, ..., and `posterior`."""
    p = 1 / (1 + F.exp(-F.col(logit)))
    names = [f"s{i}" for i in range(len(levels[-1]))]
    finest = materialise(
        scored.groupBy(*[F.col(c).alias(n) for c, n in zip(levels[-1], names)]).agg(
            F.count("*").alias("n"), F.sum(p).alias("good")
        ), "sites"
    )
    overall = finest.agg(F.sum("good") / F.sum("n")).first()[0]
    parents = None
    for level in levels:
        own = names[:len(level)]
        sites = finest.groupBy(*own).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if parents is None:
            sites = sites.withColumn("parent", F.lit(overall))
        else:
            up = names[:parents[1]]
            above = parents[0].select(
                *[F.col(c).alias(f"up_{c}") for c in up], F.col("posterior").alias("parent")
            )
            sites = sites.join(
                above, [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in up]
            ).drop(*above.columns[:-1])
        # Variance of sites around their parents beyond that of the draw of their documents.
        apart = F.col("good") / F.col("n") - F.col("parent")
        chance = F.col("parent") * (1 - F.col("parent")) / F.col("n")
        between, spread = sites.agg(
            F.sum(F.col("n") * (apart * apart - chance)) / F.sum("n"),
            F.sum(F.col("n") * F.col("parent") * (1 - F.col("parent"))) / F.sum("n"),
        ).first()
        strength = float(np.clip(spread / between - 1, 1, 1e6)) if between and between > 0 else 1e6
        sites = sites.withColumn(
            "posterior",
            (F.col("good") + strength * F.col("parent")) / (F.col("n") + strength),
        )
        parents = (sites, len(level))
    return parents[0].select(*names, "posterior").withColumn("overall", F.lit(overall))


def classify(docs: DataFrame, model: Model | None, levels: Sequence[Sequence[str]],
             text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """`docs` with classifier_score, site_score, score and kept appended.

    `levels` names the columns of each level of sites, each level a prefix of the next.  A
    column of `docs` that has one of the new names keeps it; the new one gets an underscore.
    """
    names = [
        free_name(docs, c) for c in ("classifier_score", "site_score", "score", "kept")
    ]
    if model is None:
        return docs.withColumns(
            dict(zip(names, (F.lit(0.5), F.lit(0.5), F.lit(0.5), F.lit(True))))
        )
    logit = free_name(docs, "logit")
    scored = materialise(evidence(docs, model, logit, text_col), "evidence")
    sites = _posteriors(scored, logit, levels)
    match = [free_name(docs, f"site_{i}") for i in range(len(levels[-1]))]
    posterior, overall = free_name(docs, "posterior"), free_name(docs, "overall")
    sites = sites.toDF(*match, posterior, overall)
    joined = scored.join(
        sites, [F.col(c).eqNullSafe(F.col(s)) for c, s in zip(levels[-1], match)]
    )
    total = F.col(logit) + _logit(F.col(posterior)) - _logit(F.col(overall))
    values = {
        names[0]: 1 / (1 + F.exp(-F.col(logit))), names[1]: F.col(posterior),
        names[2]: 1 / (1 + F.exp(-total)),
    }
    return joined.select(
        *[F.col(c) for c in docs.columns], *[v.alias(n) for n, v in values.items()],
        (values[names[2]] >= keep_from).alias(names[3]),
    )
