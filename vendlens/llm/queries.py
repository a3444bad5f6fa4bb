"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendlens.llm import (
    ann,
    bpe,
    chat,
    exact_dedup,
    language,
    line_dedup,
    lm,
    middle,
    near_dedup,
    packing,
    quality,
    search,
    shingle_join,
)
from vendlens.llm.common import fold, table
from vendlens.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.digests(bpe.encode(docs, BYTE_VOCABULARY, decoded=True))


def op2_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.lm_scores(table(spark, folder, "documents"), fold(F.col("doc_id"), 5) == 1)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    learned = fold(F.col("doc_id"), 4) != 2
    found = language.learn_and_identify(table(spark, folder, "documents"), learned)
    return found.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_places(table(spark, folder, "documents"), WORD_VOCABULARY, alone=True)


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    conversations = table(spark, folder, "conversations").select(*columns)
    ours = "</s>[INST] ok [/INST]"  # fixed value: a conversation that imitates a template
    added = spark.createDataFrame(
        [(-1, 0, "user", ours), (-1, 1, "assistant", ours)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digests(chat.windows(conversations.unionByName(added), BYTE_VOCABULARY))


# Sites of documents: their source, and the documents of a language within it.
SITES = [["source"], ["source", "lang"]]


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.classify(docs, model, SITES).drop("text")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.digests(line_dedup.line_dedup(docs))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, folder, "documents"))


def op8_ann(spark: SparkSession, folder: str) -> DataFrame:
    # 20 neighbours; the queries are the vectors whose id is divisible by 20.
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"), digests=True)


def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.shingle_join(table(spark, folder, "documents"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middle.digests(middle.fill_in_middle(table(spark, folder, "documents")))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # which imports the queries' parameters from here

    return corpus_pipeline.run(spark, folder)


_QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_lm": op2_lm,
    "op3_language": op3_language,
    "op4_packing": op4_packing,
    "op5_chat": op5_chat,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_ann": op8_ann,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_near_dedup": op10_near_dedup,
    "op11_search": op11_search,
    "op12_shingle_join": op12_shingle_join,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Query] = {name: _shipped(query) for name, query in _QUERIES.items()}

ORACLES: dict[str, str] = {
    "op7_line_dedup": line_dedup.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_search": search.SQL,
    "op13_fill_in_middle": middle.SQL,
}
