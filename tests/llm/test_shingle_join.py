"""The join of shingle sets against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from vendlens.llm import shingle_join as module
from vendlens.llm.shingle_join import CountTree, Points, bound, possible_pairs, shingle_join


def plain(rows):
    sets = []
    for _, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words
                    else set())
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
            old, new = group[i], group[j]
            group = [new if g == old else g for g in group]
    result = []
    for (doc_id, _), found, mine in zip(rows, sets, group):
        ids = [r[0] for r, g in zip(rows, group) if g == mine and r[0] is not None]
        result.append((doc_id, len(found), min(ids, default=None)))
    return sorted(result, key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "k long, body string, n string")
    found = shingle_join(docs, "k", "body")
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted([tuple(r) for r in found.collect()], key=repr)


def families(seed, families_=12, copies=9):
    """Texts that are changed more or less, around the threshold, with a passage all share."""
    draw = random.Random(seed)
    words = [f"v{i}" for i in range(3000)]
    passage = " ".join(draw.choices(words, k=40))
    rows = []
    for _ in range(families_):
        base = draw.choices(words, k=draw.choice([8, 30, 90, 300, 700]))
        for _ in range(copies):
            text = list(base)
            for _ in range(round(len(base) * draw.choice([0, 0.01, 0.02, 0.03, 0.05]))):
                text[draw.randrange(len(text))] = draw.choice(words)
            at = draw.randrange(len(text))
            joined = [*text[:at], passage, *text[at:]] if draw.random() < 0.5 else text
            rows.append((draw.randrange(10 ** 6), "  ".join(joined).upper()))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_families_around_the_threshold(spark, seed):
    rows = families(seed)
    assert run(spark, rows) == plain(rows)


def test_small_blocks_and_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 3)
    monkeypatch.setattr(module, "PAIRS", 0)
    rows = families(7)
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark, samples):
    rows = [*enumerate(samples), (100, None), (101, " \n"), (102, "A b"), (103, "a B"), (104, "a"),
            (5, "one two three four five six"), (5, "One two three four five six"),
            (None, "one two three four five six"), (None, "only without an id"),
            (105, "z" * 500 + " " + "y" * 100_000), (106, "Z" * 500 + "\t" + "y" * 100_000)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_bounds_hold_and_the_tree_loses_nothing():
    draw = random.Random(3)
    texts = [t.encode() for _, t in families(3, 10, 6)]
    sets = module.shingle_sets(pa.array(texts))
    points = [module.point_of(s) for s in sets]
    links, bounded = set(), set()
    for i, j in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        assert both <= bound(points[i], points[j])
        if module.enough(both, len(sets[i]), len(sets[j])):
            links.add((i, j))
        if module.enough(bound(points[i], points[j]), len(points[i]), len(points[j])):
            bounded.add((i, j))
    ordered = {tuple(sorted(p)) for p in zip(*(s.tolist() for s in possible_pairs(
        Points(points), None)))}
    assert links and links <= bounded == ordered
    half = len(points) // 2
    across = set(zip(*(s.tolist() for s in possible_pairs(
        Points(points[:half]), Points(points[half:])))))
    assert across == {(i, j - half) for i, j in bounded if i < half <= j}
    counts = np.array([[draw.randrange(5) for _ in range(16)] for _ in range(600)], np.int32)
    sizes = counts.sum(1).astype(np.int64)
    query, point = CountTree(counts, sizes).possible(counts, sizes)
    overlap = np.minimum(counts[:, None], counts[None]).sum(2)
    good = module.enough(overlap, sizes[:, None], sizes[None])
    good &= 100 * np.minimum(sizes[:, None], sizes) >= 80 * np.maximum(sizes[:, None], sizes)
    assert set(zip(query.tolist(), point.tolist())) == set(zip(*np.nonzero(good)))


def test_words_are_hashed_alike_wherever_they_stand():
    texts = [b"x", b"", b"a " * 200_000 + b"x", b" y" * 3 + b"q" * 300_000 + b" x"]
    hashes, counts = module.word_hashes(texts)
    assert counts.tolist() == [1, 0, 200_001, 4]
    assert hashes[0] == hashes[200_001] == hashes[-1] and len(np.unique(hashes)) == 4
