"""Ranked search against a plain ranking of all documents."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from vendlens.llm import search as module
from vendlens.llm.search import search


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    result = []
    for item_id, text in items:
        ranked = []
        for (doc_id, bag), size in zip(bags, sizes):
            score = 0
            for term in terms(text):
                if bag[term]:
                    df = sum(term in b for _, b in bags)
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    m = 25 + 75 * size * n // total
                    score += w * (1000000000 * bag[term] // (1000 * bag[term] + 8 * m))
            if score > 0:
                ranked.append((-score, doc_id is None, doc_id or 0, doc_id))
        ranked = sorted(ranked)[:k]
        result += [(item_id, i + 1, r[3], -r[0]) for i, r in enumerate(ranked)]
    return sorted(result, key=repr)


def run(spark, docs, items, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, m string")
    items = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    found = search(docs, items, **options)
    return sorted([tuple(r) for r in found.collect()], key=repr)


def corpus(rows, seed=1):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 30))) for _ in range(rows)]
    return [(i, draw.choice(texts) if i % 3 else "W1, w2 the same.") for i in range(rows)]


ITEMS = [(1, "w1 w2 w2 w3"), (2, "w59 W58"), (3, None), (4, "absent words"), (5, ""),
         (6, "w10 " * 40), (None, "w7 w8"), (1, "w4")]


def test_ties_copies_and_odd_rows(spark, samples):
    docs = [*corpus(400), *[(500 + i, t) for i, t in enumerate(samples)],
            (None, "w59 w59"), (None, "w59 w59"), (7, "w58"), (7, "w58")]
    items = [*ITEMS, (9, "日本語 İstanbul x 🙂🙂 Hello")]
    assert run(spark, docs, items) == plain(docs, items)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = corpus(150, seed=2)
    monkeypatch.setattr(module, "VOCABULARY", 12)
    monkeypatch.setattr(module, "BLOCK_BYTES", 400)
    assert run(spark, docs, ITEMS, k=3) == plain(docs, ITEMS, 3)


def test_classes_are_scored_once(spark):
    docs = spark.createDataFrame(corpus(300), "doc_id long, text string").withColumn(
        "text", F.col("text").cast("binary")
    )
    number = {b"w1": 0, b"w2": 1}
    bags = module._bags(docs, number)
    assert bags.count() == 300
    same = bags.where("n = 4").select("bag").distinct().count()
    assert same < bags.where("n = 4").count()


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, corpus(5), []) == []
    assert run(spark, [(1, None), (2, "...")], ITEMS) == []
