"""Languages: held-out accuracy, the model's probabilities, odd rows."""

import zlib

import numpy as np
import pytest

from vendlens.llm import language, queries


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op3_language(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(truth)
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.99 * len(unseen)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.005 * len(rows)


def test_only_text_decides(spark, tmp_path):
    rows = [(i, "guten morgen welt" if i % 2 else "good morning world",
             "de" if i % 2 else "en", "s") for i in range(40)]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    swapped = [(i, t, lang if not held_out(i) else "xx", "other") for i, t, lang, _ in rows]
    spark.createDataFrame(swapped, schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    a, b = (
        {r.doc_id: (r.lang_pred, r.score) for r in
         queries.op3_language(spark, f"{tmp_path}/{x}").collect()} for x in "ab"
    )
    assert a == b
    assert all(a[i][0] == lang for i, _, lang, _ in rows)


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the cat sat on the mat and the dog ran", "en"), ("der hund und die katze", "de"),
            ("le chat et le chien", "fr"), ("a", "en"), (None, "en"), ("x", None), ("", "fr")]
    return language.fit(spark.createDataFrame(rows * 3, "text string, lang string"))


def test_probabilities_add_up(model):
    """After any context, the symbols of a language, its end and an unseen one sum to one."""
    letters = "abcdefghijklmnopqrstuvwxyzäöüß"
    codes = np.array([ord(c) for c in letters], np.uint64)
    keys = language._key(language._hashes(codes, 1)[0])
    at = np.minimum(np.searchsorted(model.keys[0], keys), len(model.keys[0]) - 1)
    seen = (model.keys[0][at] == keys)[:, None] & ~np.isnan(model.log_p[0][at])
    for start in ("", "t", "th", "chat", "zzz", "katz"):
        base = prefix_log(model, start)
        after = np.array([np.exp(prefix_log(model, start + c) - base) for c in letters])
        end = np.exp(model.score([start])[0, :3] - base) if start else 0
        unseen = np.exp(prefix_log(model, start + "@") - base)
        total = np.where(seen, after, 0).sum(axis=0) + end + unseen
        assert (total <= 1 + 1e-4).all()
        assert (total > 0.9).all() or not start


def prefix_log(model, prefix):
    """log P of the symbols of a prefix, without the word's end."""
    if not prefix:
        return np.zeros(3)
    codes, place, word = language._symbols([prefix])
    marked = np.where(codes == 2, 3, codes)  # the end is never reached: ignore its factor
    whole = score_symbols(model, marked, place)
    return whole[1:-1].sum(axis=0)


def score_symbols(model, codes, place):
    log_p, context = np.tile(model.unknown, (len(codes), 1)), None
    for n, hashes in enumerate(language._hashes(codes.astype(np.uint64), language.ORDER), 1):
        wanted, keys = language._key(hashes), model.keys[n - 1]
        new = log_p.copy()
        now = np.zeros_like(log_p)
        for i in range(len(codes)):
            at = np.searchsorted(keys, wanted[i])
            held = at < len(keys) and keys[at] == wanted[i] and place[i] >= n - 1
            for lang in range(log_p.shape[1]):
                if n > 1 and place[i] >= n - 1:
                    new[i, lang] = log_p[i, lang] + context[i - 1, lang]
                if held and not np.isnan(model.log_p[n - 1][at, lang]):
                    new[i, lang] = model.log_p[n - 1][at, lang]
            if held:
                now[i] = model.backoff[n - 1][at]
        log_p, context = new, now
    return log_p


def test_vectorised_scores_equal_the_plain_ones(model):
    words = ["the", "katze", "x", "zzzz", "chatte", "über"]
    found = model.score(words)
    for i, word in enumerate(words):
        codes, place, _ = language._symbols([word])
        plain = score_symbols(model, codes, place)[1:].sum(axis=0)
        assert np.allclose(found[i, :3], plain, atol=1e-4)
        assert found[i, 3] == len(word) + 1


def test_odd_rows(spark, samples, model):
    rows = [(i, t, "keep") for i, t in enumerate(samples)] + [(0, None, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = language.identify(docs, model)
    assert found.columns == ["doc_id", "text", "score", "lang_pred", "_score", "rejected"]
    for r in found.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters
        assert r.lang_pred in ("und", "en", "de", "fr") and 0 <= r._score <= 1
        assert letters or (r.rejected and r._score == 0)


def test_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op3_language(spark, str(tmp_path)).count() == 0
    docs = spark.createDataFrame([(1, "no languages", None)], schema)
    assert language.fit(docs) is None
    assert language.identify(docs, None).first().lang_pred == "und"


def test_caches_may_start_anew(model, monkeypatch):
    monkeypatch.setattr(language, "CACHED", 3)
    texts = ["the cat", "der hund und die katze", "le chat", "the cat"]
    small, large = language.Scorer(model), language.Scorer(model)
    apart = [small.entropies([t])[0] for t in texts]
    assert np.allclose(apart, large.entropies(texts))


def test_a_rare_language_rejects_too(spark):
    """Two documents among thousands, and one text that most rows are copies of."""
    rng = np.random.default_rng(4)
    words = {"en": "the cat sat on a mat and then some dog ran over that green hill".split(),
             "de": "der hund und die katze laufen heute nicht mehr durch den wald".split()}
    rows = [(" ".join(rng.choice(words[lang], 12)), lang) for lang in words for _ in range(6000)]
    rows += [(" ".join(words["en"]), "en")] * 9000
    rare = [("kissa istuu matolla ja koira juoksee", "fi"), ("kissa nukkuu sohvalla", "fi")]
    model = language.fit(spark.createDataFrame(rows + rare, "text string, lang string"))
    assert np.isfinite(model.limits).all()
    foreign = ["собака бежит по лесу", "η γάτα κάθεται", "日本語の文章です", "xqzj wvkpq zzxq jjqw",
               "qwrtp zxcvb", "猫が座る", "ŵŷ ĉĝ ĥĵ"]
    docs = [(t, True) for t in foreign] + [(t, False) for t, _ in rare + rows[::600]]
    found = language.identify(spark.createDataFrame(docs, "text string, strange boolean"), model)
    assert [r for r in found.collect() if r.rejected != r.strange] == []


def test_scoring_once_gives_the_same(spark, small):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").union(
        spark.createDataFrame([(-1, None, "en"), (-2, "123", None), (None, "a b", "en")],
                              "doc_id long, text string, lang string"))
    train = F.col("doc_id") % 3 == 0
    model = language.fit(docs.where(train))
    names = ["doc_id", "lang_pred", "score", "rejected"]
    twice = language.identify(docs, model).select(*names).collect()
    once = language.learn_and_identify(docs, train).select(*names).collect()
    assert sorted(once, key=repr) == sorted(twice, key=repr)
    none = language.learn_and_identify(docs, F.lit(False))
    assert {(r.lang_pred, r.rejected) for r in none.collect()} == {("und", True)}
