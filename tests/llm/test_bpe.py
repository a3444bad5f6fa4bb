"""Encoding and decoding against the public tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vendlens.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(encoded):
    return np.frombuffer(encoded, "<u4").tolist()


def test_same_ids_and_texts_as_the_library(codec, library, samples):
    for text in samples:
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids(codec.encode(text or "")) == expected, repr(text)[:80]
        assert codec.decode(codec.encode(text or "")) == library.decode(
            expected, skip_special_tokens=False
        )


def test_random_texts(codec, library):
    letters = random.Random(5)
    alphabet = "aeth 's\n\t.,!1é日́🙂  \u0085\x1c|<>AΣ"
    for _ in range(600):
        text = "".join(letters.choices(alphabet, k=letters.randint(0, 60)))
        assert ids(codec.encode(text)) == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(codec.encode(text)) == text


def test_caches_may_start_anew(library):
    small = bpe.Codec(open(PATH, encoding="utf-8").read())
    small.of_chunk.entries = small.of_piece.entries = 2
    text = "one two three one two three, four"
    assert ids(small.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_broken_utf8_is_replaced(codec, library):
    tokens = library.encode("日", add_special_tokens=False).ids[:1]
    assert codec.decode(np.array(tokens, "<u4").tobytes()) == library.decode(tokens)


def test_query_over_samples(spark, samples, tmp_path, library):
    rows = [(i, text, "extra") for i, text in enumerate(samples)] + [(0, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    result = queries.op1_bpe(spark, str(tmp_path)).collect()
    assert len(result) == len(rows)
    for row in result:
        text = samples[row.doc_id] or ""
        expected = library.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(expected)
        data = np.array(expected, "<u4").tobytes()
        assert row.ids_sha256 == hashlib.sha256(data).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_decode_is_the_inverse_of_encode(spark, samples):
    rows = [(i, text) for i, text in enumerate(samples)]
    docs = spark.createDataFrame(rows, "id long, body string")
    back = bpe.decode(bpe.encode(docs, PATH, "id", "body"), PATH).collect()
    assert {r.doc_id: r.text for r in back} == {i: text or "" for i, text in rows}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert queries.op1_bpe(spark, str(tmp_path)).count() == 0


def test_vocabulary_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY_BYTES", 1000)
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), PATH)
