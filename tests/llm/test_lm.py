"""Class n-grams: base scores by brute force, probabilities that add up, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendlens.llm import lm, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def plain(rows):
    """[(id, held out, tokens, known, N, base score)]"""
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            counts.update([*split(text), None])
    n, v = sum(counts.values()), len(counts)
    result = []
    for doc_id, text in rows:
        tokens = [*split(text), None]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        known = sum(counts[t] > 0 for t in tokens)
        result.append((doc_id, held_out(doc_id), len(tokens), known, n, round(base, 6)))
    return sorted(result, key=repr)


def ours(df):
    return sorted([
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in df.collect()
    ], key=repr)


def write(spark, rows, folder):
    spark.createDataFrame(
        [(i, t, "x") for i, t in rows], "doc_id long, text string, classes string"
    ).write.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("chunk", [300, lm.CHUNK_BYTES])
def test_odd_rows(spark, samples, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(lm, "CHUNK_BYTES", chunk)
    rows = [*enumerate(samples), (3, "again"), (3, "again"), (None, "no id"), (99, "w " * 30000)]
    write(spark, rows, tmp_path)
    assert ours(queries.op2_lm(spark, str(tmp_path))) == plain(rows)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet")
            .select("doc_id", "text").collect()]
    df = queries.op2_lm(spark, small)
    assert ours(df) == plain(rows)
    sums = {r.held_out: (r.score, r.base) for r in df.groupBy("held_out").agg(
        F.sum("score").alias("score"), F.sum("base_score").alias("base")).collect()}
    assert sums[True][0] > sums[True][1] and sums[False][0] > sums[False][1]


def test_empty_tables(spark, tmp_path):
    write(spark, [], tmp_path)
    assert queries.op2_lm(spark, str(tmp_path)).count() == 0
    only_held_out = [(i, "some words") for i in range(30) if held_out(i)]
    df = spark.createDataFrame(only_held_out, "doc_id long, text string")
    found = lm.lm_scores(df, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in found} == {(0, 0, 0, 0)}


def test_probabilities_add_up():
    rng = np.random.default_rng(1)
    trigrams = rng.poisson(0.3, (lm.SYMBOLS,) * 3).astype(float)
    trigrams[..., lm.UNKNOWN] = 0
    trigrams[3] = 0
    logs = lm.transition_logs(trigrams, rng.poisson(5, lm.SYMBOLS).astype(float))
    assert np.allclose((10 ** logs).sum(axis=-1), 1)
    empty = lm.transition_logs(np.zeros((lm.SYMBOLS,) * 3), np.zeros(lm.SYMBOLS))
    assert np.allclose((10 ** empty).sum(axis=-1), 1)


def likelihood(bigrams, of, classes):
    of = np.concatenate([of, [classes, classes + 1]])
    table = np.zeros((classes + 2, classes + 2))
    np.add.at(table, (of[:, None], of[None, :]), bigrams)
    return (lm._xlogx(table).sum() - lm._xlogx(table.sum(axis=0)).sum()
            - lm._xlogx(table.sum(axis=1)).sum())


def test_exchange_finds_planted_classes_and_a_local_optimum():
    rng = random.Random(2)
    words, classes = 30, 3
    bigrams = np.zeros((words + 2, words + 2))
    state = 0
    for _ in range(20000):  # words of class c are followed by words of class c + 1
        after = rng.choice([w for w in range(words) if w % classes == (state + 1) % classes])
        bigrams[state, after] += 1
        state = after
    shuffled = rng.sample(range(words), words) + [words, words + 1]
    bigrams = bigrams[np.ix_(shuffled, shuffled)]
    of = lm.exchange(bigrams, classes)
    assert len({(shuffled[w] % classes, of[w]) for w in range(words)}) == classes
    best = likelihood(bigrams, of, classes)
    for w in range(words):
        for c in range(classes):
            other = of.copy()
            other[w] = c
            assert likelihood(bigrams, other, classes) <= best + 1e-6
