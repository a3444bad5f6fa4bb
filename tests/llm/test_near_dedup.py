"""Near duplicates against a comparison of all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from vendlens.llm import near_dedup, queries
from vendlens.llm.near_dedup import Shingler, aligned, sketch

LETTERS = random.Random(8)
VOCABULARY = ["".join(LETTERS.choices("abcdefghij", k=5)) for _ in range(3000)]


def text(rng, n):
    return " ".join(rng.choices(VOCABULARY, k=n))


def changed(rng, original, share):
    return " ".join(rng.choice(VOCABULARY) if rng.random() < share else w
                    for w in original.split())


def words(value):
    found = re.findall(r"\w+", (value or "").lower())
    return tuple(found or (value or "").lower().split())


def plain_similarity(a, b):
    """Longest common subsequence of labelled k-mers over all k-mers, by the full table."""
    def kmers(w):
        runs = [w[i:i + 5] for i in range(max(1, len(w) - 4))] if w else []
        seen = defaultdict(int)
        result = []
        for run in runs:
            result.append((run, seen[run]))
            seen[run] += 1
        return result

    x, y = kmers(a), kmers(b)
    row = [0] * (len(y) + 1)
    for p in x:
        diagonal = 0
        for j, q in enumerate(y, 1):
            diagonal, row[j] = row[j], diagonal + 1 if p == q else max(row[j], row[j - 1])
    common = row[-1]
    return common / max(1, len(x) + len(y) - common)


def plain(rows):
    """{text as words: class id} by comparing all pairs."""
    bodies = sorted({words(t) for _, t in rows})
    parent = list(range(len(bodies)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(bodies):
        for j in range(i):
            near = min(len(a), len(bodies[j])) > 0.7 * max(len(a), len(bodies[j]))
            if near and set(a) & set(bodies[j]) and plain_similarity(a, bodies[j]) >= 0.8:
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for doc_id, t in rows:
        ids[root(bodies.index(words(t)))].append(doc_id)
    result = []
    for members in ids.values():
        keep = min((i for i in members if i is not None), default=None)
        result += [(i, keep, len(members)) for i in members]
    return sorted(result, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    found = near_dedup.near_dedup(df).collect()
    # One row of each class stays, the one with its id.
    assert all(r.doc_id == r.class_id for r in found if r.kept)
    assert abs(sum(1 / r.class_size for r in found) - sum(r.kept for r in found)) < 1e-6
    return sorted([(r.doc_id, r.class_id, r.class_size) for r in found], key=repr)


@pytest.mark.parametrize("block", [512, 3])
def test_same_classes_as_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for _ in range(12):
        original = text(rng, rng.randint(30, 200))
        rows.append(original)
        for _ in range(rng.randint(0, 6)):
            rows.append(changed(rng, original, rng.choice([0.005, 0.02, 0.05])))
        if rng.random() < 0.5:
            rows.append(f"{rows[-1]} {text(rng, 8)}")
    base = text(rng, 120)  # a hub and copies that are farther from each other
    rows += [base] + [changed(rng, base, 0.03) for _ in range(40)]
    passage = text(rng, 60)
    rows += [f"{text(rng, 60)} {passage} {text(rng, 60)}" for _ in range(20)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark, samples):
    rows = [*enumerate(samples), (50, None), (51, ""), (52, "a"), (52, "a"), (53, "!!! ??"),
            (54, "??? !!!"), (55, "one two three"), (56, "One, two: THREE"), (57, "one two"),
            (58, "x " * 500), (59, "x " * 505), (None, "no id " * 40), (60, "y " * 20000),
            (61, "one two three four five six"), (55, "another text under a known id")]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_dedup(df).count() == 0


def test_order_matters_to_sketches():
    shingler = Shingler()
    a, b = text(random.Random(1), 60), text(random.Random(2), 60)
    with np.errstate(over="ignore"):
        forward = shingler.kmers(shingler.words(f"{a} {b}"))
        backward = shingler.kmers(shingler.words(f"{b} {a}"))
        same = (sketch(forward) == sketch(backward)).mean()
    assert not aligned(forward, backward) and same < 0.6
    assert aligned(forward, forward)


def test_long_chain_of_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)],
                                  "a long, b long")
    found = {r.node: r.label for r in near_dedup.components(links).collect()}
    assert set(found.values()) == {0, 1000} and len(found) == 303


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet")
            .select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1]) < 4000]
    assert run(spark, rows) == plain(rows)
    assert queries.op10_near_dedup(spark, small).count() == spark.read.parquet(
        f"{small}/documents.parquet").count()
