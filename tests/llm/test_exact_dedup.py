"""Exact duplicates against SQL and a plain grouping."""

import hashlib
import re
from collections import defaultdict

from vendlens.llm import queries
from vendlens.llm.exact_dedup import exact_dedup


def plain(rows):
    groups = defaultdict(list)
    normal = [re.sub(r"[\x20\x09-\x0d]+", " ", text or "") for _, text in rows]
    for (doc_id, _), text in zip(rows, normal):
        groups[text].append(doc_id)
    result = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        given = False
        for doc_id in ids:
            kept = doc_id == keep and not given
            given |= kept
            digest = hashlib.sha256(text.encode()).hexdigest()
            result.append((doc_id, keep, len(ids), kept, digest))
    return sorted(result, key=repr)


def run(spark, rows, tmp_path):
    spark.createDataFrame(
        [(i, t, "x") for i, t in rows], "doc_id long, text string, n string"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op9_exact_dedup(spark, str(tmp_path))


def test_odd_rows(spark, samples, tmp_path):
    rows = [*enumerate(samples), (100, None), (101, "don't stop now"), (5, "Hello\t\nworld"),
            (5, "Hello world"), (None, "no id"), (None, "no id"), (None, "Hello world"),
            (7, "x" * 300 + "a"), (8, "x" * 300 + "b"), (9, "x" * 300 + "a"), (9, "other")]
    result = run(spark, rows, tmp_path)
    assert sorted([tuple(r) for r in result.collect()], key=repr) == plain(rows)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_only_possible_copies_are_read_in_full(spark):
    docs = spark.createDataFrame(
        [(1, "a b"), (2, "a  b"), (3, "cd"), (4, "efg")], "id long, body string"
    )
    found = {r.doc_id: r for r in exact_dedup(docs, "id", "body").collect()}
    assert found[1].keep_id == found[2].keep_id == 1 and found[2].group_size == 2
    assert found[1].text_sha256 and found[3].text_sha256 is None and found[4].text_sha256 is None


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path).count() == 0


def test_one_group_of_a_third_of_all_rows(spark, tmp_path):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    found = run(spark, rows, tmp_path).collect()
    assert sum(r.kept for r in found) == 2001
    assert {r.group_size for r in found} == {1, 1000}


def test_groups_are_the_same_with_and_without_digests(spark, samples):
    rows = [*enumerate(samples), (100, None), (5, "Hello world"), (None, "Hello world")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    with_digests = exact_dedup(docs, digests=True)
    without = exact_dedup(docs)
    assert sorted(map(str, with_digests.select(*columns).collect())) == \
        sorted(map(str, without.select(*columns).collect()))
    assert with_digests.where("text_sha256 IS NULL").count() == 0
