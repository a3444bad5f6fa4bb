"""The pipeline's stages against their operators, on small and on odd tables."""

import collections

import pytest

import corpus_pipeline
from vendlens.llm import queries

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def run_stages(spark, folder, docs=None):
    docs = docs if docs is not None else spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        sizes.append(len(rows))
        if name != "packing":
            assert docs.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    return rows, sizes


def test_stages(spark, small):
    rows, sizes = run_stages(spark, small)
    whole = corpus_pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in rows
    )
    # Quality and near copies drop some documents, languages and lines nearly none.
    assert sizes[0] > sizes[1] > 0.6 * sizes[0]
    assert sizes[1] >= sizes[2] >= 0.97 * sizes[1]
    assert sizes[2] == sizes[3] >= sizes[4]
    assert len({r.doc_id for r in rows}) == sizes[4]


def test_rejected_documents_are_gone(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_filter(spark, docs, small).collect()}
    decided = {r.doc_id: r.kept for r in queries.op6_quality(spark, small).collect()}
    assert kept == {i for i, k in decided.items() if k}


def test_near_copies_keep_one_of_each_class(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    left = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect()]
    kept = {r.doc_id for r in queries.op10_near_dedup(spark, small).collect() if r.kept}
    assert len(left) == len(set(left)) and set(left) == kept


@pytest.fixture
def odd(spark, samples, tmp_path):
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 3 else "s", i)
            for i, t in enumerate(samples)]
    rows += [(1, "a second row of one id", "en", "s", 1), (2, samples[2], "en", "s", 2),
             (None, "a row without an id", None, None, None), (None, None, None, None, None),
             (60, "same words here", "en", "s", 1), (60, "same words here", "en", "s", 1)]
    spark.createDataFrame(rows, KIND + "").selectExpr(
        "*", "text AS kept", "doc_id AS class_id", "lang AS score", "1 AS n_lines"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(20)] + [(3, None, None), (None, 1, 1), (4, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    return str(tmp_path)


def test_odd_rows(spark, odd):
    run_stages(spark, odd)
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    left = corpus_pipeline.drop_near_copies(spark, docs, odd).collect()
    ids = collections.Counter(r.doc_id for r in left)
    assert ids[60] == 1 and ids[2] <= 1


def test_which_text_of_an_id_stays(spark):
    """Rows that share an id, null or not, stay or go by their own text."""
    b, z, y = (" ".join(f"{c}{i}" for i in range(30)) for c in "bzy")
    rows = [(3, b, 1), (None, b, 2), (None, z, 3), (None, z.upper(), 4), (None, None, 5),
            (7, z, 6), (7, y, 7), (7, y, 8), (8, "  " + y, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    left = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.n_chars for r in left) == [1, 5, 6, 7]
    alone = [(3, b, 1), (None, b, 2), (None, y, 3), (None, y.upper(), 4), (None, z, 5)]
    docs = spark.createDataFrame(alone, "doc_id long, text string, n_chars long")
    left = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.n_chars for r in left) == [1, 4, 5]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
