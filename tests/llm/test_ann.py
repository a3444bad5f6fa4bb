"""Nearest neighbours against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendlens.llm import ann, queries


def brute(rows, k, wanted):
    """{query id: [(vec id, score)]} of valid rows."""
    valid = {}
    for i, v in rows:
        if i is None or not v or None in v or not np.isfinite(v).all() or not any(v):
            continue
        valid.setdefault(i, []).append(np.array(v, float))
    result = {}
    for q in filter(wanted, valid):
        scores = [
            (max(float((a * b).sum()) for a in valid[q] for b in vs), i)
            for i, vs in valid.items() if i != q
        ]
        result[q] = [(i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return result


def found(df):
    result = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        result[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(result[r.query_id])
    return result


def recall(ours, true):
    hits = sum(len({i for i, _ in ours.get(q, [])} & {i for i, _ in t}) for q, t in true.items())
    return hits / max(1, sum(map(len, true.values())))


def test_query_recall(spark, tmp_path):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    true = brute(rows, 20, lambda i: i % 20 == 0)
    ours = found(queries.op8_ann(spark, folder))
    assert set(ours) == set(true)
    assert all(len(v) == 20 for v in ours.values())
    assert recall(ours, true) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, neighbours in ours.items():
        scores = [s for _, s in neighbours]
        assert scores == sorted(scores, reverse=True)
        for i, s in neighbours:
            assert s == pytest.approx(float((vectors[q] * vectors[i]).sum()), abs=1e-15)


def test_lengths_differ(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(16) * rng.lognormal(0, 0.7)])
            for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    true = brute(rows, 20, lambda i: i % 100 == 0)
    ours = found(ann.nearest(df, F.col("vec_id") % 100 == 0))
    assert recall(ours, true) >= 0.9


def test_near_copies_on_the_smallest_ids(spark):
    """They do not decide how far the other queries look."""
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((12_000, 32))
    vectors[:1200] = vectors[0] + 1e-4 * rng.standard_normal((1200, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    true = brute(rows, 5, lambda i: i >= 1200 and i % 200 == 0)
    ours = found(ann.nearest(df, (F.col("vec_id") >= 1200) & (F.col("vec_id") % 200 == 0), k=5))
    assert recall(ours, true) >= 0.9


@pytest.mark.parametrize("shard", [50, 16_384])
def test_copies_and_odd_rows(spark, monkeypatch, shard):
    monkeypatch.setattr(ann, "SHARD", shard)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    same = [1.0, 2.0, -1.0, 0.5]
    rows = [(i, same) for i in range(0, 900, 3)]
    rows += [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(1, 900, 3)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 4), (2003, [1.0, None, 1.0, 1.0]),
             (2004, [float("nan")] * 4), (2005, [float("inf"), 0.0, 0.0, 0.0]), (None, same),
             (2006, [1.0, 2.0]), (0, same), (1, [9.0, 9.0, 9.0, 9.0])]
    df = spark.createDataFrame(
        [(i, v, 1, "t") for i, v in rows],
        "vec_id long, embedding array<float>, rank int, `table` string",
    )
    true = brute([r for r in rows if r[0] != 2006], 20, lambda i: i % 20 == 0)
    ours = found(ann.nearest(df, F.col("vec_id") % 20 == 0))
    assert set(ours) == set(true)
    # Copies tie, and ties go to the smaller ids, exactly.
    near = {q for q in true if q % 3 == 0 and true[q][-1][1] == true[q][-5][1]}
    assert near
    for q in near:
        tied = [i for i, s in true[q] if s == true[q][-1][1]]
        assert [i for i, s in ours[q] if s == true[q][-1][1]][:len(tied)] == tied
    assert recall(ours, true) >= 0.9


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (20, [-1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, -5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ours = found(ann.nearest(df, F.col("vec_id") % 20 == 0))
    assert ours == brute(rows, 20, lambda i: i % 20 == 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(alone, F.col("vec_id") % 20 == 0).count() == 0
