"""Packing against the library's ids, the contract's invariants and a plain best fit."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vendlens.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_same_ids_as_the_library(library, samples):
    encoder = packing.WordEncoder(open(PATH, encoding="utf-8").read())
    letters = random.Random(3)
    alphabet = "aethNG 's\n\t.,!1éÉ日́🙂  \u0085\x1c|<>AΣİ"
    texts = samples + ["".join(letters.choices(alphabet, k=40)) for _ in range(500)]
    for text in texts:
        expected = library.encode(text or "", add_special_tokens=False).ids
        found = np.frombuffer(encoder.encode(text or ""), "<u4").tolist()
        assert found == expected, repr(text)[:80]


def test_marks_composed_or_not(library):
    encoder = packing.WordEncoder(open(PATH, encoding="utf-8").read())
    letters = random.Random(4)
    alphabet = "aeiIİıOoÅå\u030a\u0301\u0307\u0327\u0323éṩſßΣσ ,."
    texts = ["I\u0307\u0327stanbul", "\u0130\u0327stanbul", "o\u0323\u0307 \u1e69"]
    texts += ["".join(letters.choices(alphabet, k=12)) for _ in range(5000)]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected, repr(text)


def plain_best_fit(lengths, capacity):
    """Best fit decreasing, one item at a time."""
    gaps, used = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        used += at >= len(gaps) and gap == capacity
        if gap > length:
            bisect.insort(gaps, gap - length)
    return used


def unpack(plan):
    """Every piece's (sequence, offset, length)."""
    return [
        (first_sequence + i // each, first_offset + i % each * length, length)
        for length, first, last, first_sequence, each, first_offset in plan.runs
        for i in range(last - first)
    ]


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_valid_and_tight(seed):
    rng = random.Random(seed)
    top = rng.choice([100, 40, 60, 34])
    lengths = [min(100, max(1, int(rng.lognormvariate(2.5, 1)))) % top + 1 for _ in range(800)]
    plan = packing.make_plan(Counter(lengths), 100)
    places = unpack(plan)
    assert Counter(p[2] for p in places) == Counter(lengths)
    by_sequence = defaultdict(list)
    for sequence, offset, length in places:
        by_sequence[sequence].append((offset, length))
    for items in by_sequence.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= 100
        assert sum(3 * length > 100 for _, length in items) <= 2
    assert set(by_sequence) == set(range(plan.sequences))
    assert plan.sequences <= plain_best_fit(lengths, 100) * 1.03 + 1


def test_large_items_are_matched_in_pairs():
    plan = packing.make_plan({60: 3, 40: 2, 35: 2}, 100)
    assert plan.sequences == 4  # 60+40, 60+40, 60+35, 35


def check(rows, docs, library, capacity=packing.CAPACITY):
    expected = Counter()
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start:start + capacity]
            crc = zlib.crc32(np.array(cut, "<u4").tobytes())
            expected[doc_id, piece, start, len(cut), crc] += 1
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == expected
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for items in by_sequence.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_query(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op4_packing(spark, small).collect()
    used = check(rows, docs, library)
    lengths = [r.length for r in rows]
    assert used <= plain_best_fit(lengths, packing.CAPACITY) * 1.02 + 1


def test_odd_rows(spark, samples, library, tmp_path):
    docs = [*enumerate(samples), (3, samples[3]), (None, "no id"), (7, "y " * 9000)]
    spark.createDataFrame(
        [(i, t, i) for i, t in docs], "doc_id long, text string, length long"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    check(queries.op4_packing(spark, str(tmp_path)).collect(), docs, library)


def test_pack_returns_the_ids(spark, library):
    docs = spark.createDataFrame([(1, "one two three four five")], "doc_id long, text string")
    rows = sorted(packing.pack(docs, PATH, capacity=4).collect(), key=lambda r: r.piece)
    ids = [i for r in rows for i in np.frombuffer(bytes(r.ids), "<u4").tolist()]
    assert ids == library.encode("one two three four five", add_special_tokens=False).ids + [1]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert queries.op4_packing(spark, str(tmp_path)).count() == 0


def test_no_words_stay_in_a_worker_that_other_operators_share(spark):
    """The pipeline's next task finds the memory free; on its own, packing goes on with its words."""
    import pyarrow as pa

    def workers_with(word):
        shared = packing.vocabulary(docs, PATH)

        def probe(batches):
            for batch in batches:
                held = word in packing._encoder(shared.value).of_word
                yield pa.RecordBatch.from_arrays([pa.array([held] * batch.num_rows)], ["held"])

        rows = spark.range(0, 64, 1, 64).mapInArrow(probe, "held boolean").collect()
        return sum(r.held for r in rows)

    docs = spark.createDataFrame([(1, "sharedword x"), (2, "sharedword y")],
                                 "doc_id long, text string").coalesce(1)
    alone = spark.createDataFrame([(1, "loneword x")], "doc_id long, text string").coalesce(1)
    for _ in range(3):
        ids = packing.pieces(docs, PATH).collect()
        assert not workers_with("sharedword")
    lone = packing.pieces(alone, PATH, alone=True).collect()
    assert workers_with("loneword")
    assert len(ids) == 2 and len(lone) == 1


def test_the_memory_of_words_is_bounded():
    encoder = packing.WordEncoder(open(PATH, encoding="utf-8").read())
    encoder.remember(10)
    text = " ".join(f"w{i}" for i in range(100))
    whole = encoder.encode(text)
    assert len(encoder.of_word) <= 10
    encoder.forget()
    assert not encoder.of_word and encoder.encode(text) == whole
