"""Quality: held-out accuracy, site posteriors by hand, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendlens.llm import quality, queries


def test_held_out_accuracy(spark):
    """Learn from two thirds of the labels, test on the rest."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", "text", "source", "lang"
    )
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    train, test = labels.where("doc_id % 3 != 0"), labels.where("doc_id % 3 = 0")
    model = quality.fit(docs, train)
    tested = docs.join(F.broadcast(quality.label_table(test)), "doc_id")
    rows = quality.classify(tested, model, queries.SITES).collect()
    good = [r.kept for r in rows if r.good]
    bad = [r.kept for r in rows if not r.good]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.05 * len(bad)


def test_query(spark, small):
    found = queries.op6_quality(spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert sorted(r.doc_id for r in found.collect()) == sorted(
        r.doc_id for r in docs.collect()
    )
    assert all(r.kept == (r.score >= quality.KEEP_FROM) for r in found.collect())


def test_sites_shrink_towards_their_parents(spark):
    rng = np.random.default_rng(5)
    share = {"good": 0.95, "bad": 0.1, "mixed": 0.5}
    rows = []
    for host, p in share.items():
        for path, n in (("a", 400), ("b", 2)):
            rows += [(host, path, float(x)) for x in np.where(rng.random(n) < p, 6.0, -6.0)]
    rows += [("new", "a", 6.0), (None, None, -6.0)]
    scored = spark.createDataFrame(rows, "host string, path string, z double")
    found = {(r.s0, r.s1): r.posterior for r in
             quality._posteriors(scored, "z", [["host"], ["host", "path"]]).collect()}
    assert len(found) == 8
    for host, p in share.items():
        assert found[host, "a"] == pytest.approx(p, abs=0.07)
        # Two documents tell little: the path follows its host.
        assert found[host, "b"] == pytest.approx(found[host, "a"], abs=0.15)
    overall = np.mean([1 / (1 + np.exp(-z)) for _, _, z in rows])
    assert overall < found["new", "a"] < 0.95
    assert 0.05 < found[None, None] < overall


def test_same_sites_change_nothing(spark):
    rows = [("s", str(i % 2), 2.0 if i % 4 else -2.0) for i in range(400)]
    scored = spark.createDataFrame(rows, "host string, path string, z double")
    for r in quality._posteriors(scored, "z", [["host"], ["host", "path"]]).collect():
        assert r.posterior == pytest.approx(r.overall, abs=0.3)


def test_labels(spark):
    rows = [(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, None), (5, None, 0), (None, 1, 0),
            (6, 1, 0), (6, 0, 0), (7, 1, 0), (7, 1, 0)]
    found = quality.label_table(
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    ).collect()
    assert {r.doc_id: r.good for r in found} == {1: 1, 2: 0, 3: 0, 4: 1, 6: 0, 7: 1}


def test_odd_rows(spark, samples):
    rows = [(i, t, None if i % 3 else "s", "kept?") for i, t in enumerate(samples)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(25)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    found = quality.classify(docs, model, [["source"]])
    assert found.columns[:4] == docs.columns and "_kept" in found.columns
    result = found.collect()
    assert len(result) == len(rows)
    by_id = {}
    for r in result:
        assert 0 <= r.score <= 1 and 0 < r.site_score < 1
        assert by_id.setdefault(r.doc_id, r.score) == pytest.approx(r.score, abs=1e-9)


def test_without_labels_all_are_kept(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "s", "en")],
                                 "doc_id long, text string, source string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, none) is None
    assert quality.classify(docs, None, queries.SITES).first().kept
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    none.write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.op6_quality(spark, str(tmp_path)).count() == 0
