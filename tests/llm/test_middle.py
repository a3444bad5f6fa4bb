"""Fill-in-middle against regular expressions and a round trip."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendlens.llm import queries
from vendlens.llm.middle import UNITS, WaveletMatrix, fill_in_middle, locate, restored

ENDS = {"lines": "\n", "words": r"\n\t\x0b\x0c\r ", "sentences": "\n.!?。！？"}


def units_of(text, unit):
    if unit == "characters":
        return list(text)
    ends = ENDS[unit]
    return re.findall(f"[^{ends}]*[{ends}]|[^{ends}]+", text)


def plain(doc_id, text, unit="lines"):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = units_of(text, unit)
    first, second = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:first]), "".join(units[first:second]), "".join(units[second:])
    if not text or re.search("<[PSM]>", text):
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ROWS = [
    "one\ntwo\nthree\n", "one\ntwo\nlast", "\n", "\n\n\n", "no line end", "a<P>b\n", "<S", "x<M>",
    "<<P\n>\n<S\n>", "é\n日本\n🙂🙂\n", "a. b! c? d。\ne f\tg", "\r\n\r\n", "x" * 5000 + "\n" + "y" * 70,
]


@pytest.mark.parametrize("unit", list(UNITS))
def test_every_unit(spark, samples, unit):
    rows = [*enumerate([*samples, *ROWS]), (5, "repeated\nid"), (5, None), (None, "no\nid\n")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "k long, body string, n string")
    formed = fill_in_middle(docs, "k", "body", unit=unit)
    found = sorted([tuple(r) for r in formed.collect()], key=repr)
    assert found == sorted([plain(i, t, unit) for i, t in rows], key=repr)
    back = formed.select(restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in rows)


def test_query_and_rates(spark, tmp_path):
    rows = [(i, f"line {i}\n" * (i % 9)) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = {r.doc_id: r for r in queries.op13_fill_in_middle(spark, str(tmp_path)).collect()}
    for doc_id, text in rows:
        row, (_, n, form, _, _, output) = found[doc_id], plain(doc_id, text)
        assert (row.n, row.form) == (n, form)
        assert row.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    forms = [r.form for r in fill_in_middle(docs, percent=50, spm_percent=0).collect()]
    assert "spm" not in forms and 100 < forms.count("psm") < 250


def test_wavelet_matrix():
    symbols = np.random.default_rng(0).integers(0, 4, 1000).astype(np.uint8)
    matrix = WaveletMatrix(symbols)
    places = np.arange(1001)
    for symbol in range(4):
        counts = np.concatenate([[0], np.cumsum(symbols == symbol)])
        assert (matrix.rank(symbol, places) == counts).all()
    assert (matrix.boundaries((0, 1, 2, 3), places) == places).all()


def test_a_slice_of_texts_without_any_character():
    units, first, second = locate(["", ""], [np.array([3, 4]), np.array([1, 9])], UNITS["lines"])
    assert units.tolist() == first.tolist() == second.tolist() == [0, 0]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert fill_in_middle(docs).count() == 0
