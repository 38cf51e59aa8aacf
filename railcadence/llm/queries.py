"""The operators of this subpackage over the driver's tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from railcadence.llm import (
    aho, archive, chat, content_sort, htmltext, importance, linecrf, packing, partenum, prefix_trie, shards, simhash,
    url_templates,
)
from railcadence.llm.common import table
from railcadence.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

N_SHARDS = 24
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]
MARKS = "<|im_end|><|im_start|>assistant ok"


def tokenizer() -> tuple[str, str]:
    """Ranks and pre-tokeniser of the vocabulary in ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", MARKS), (-1, 1, "assistant", MARKS)], turns.schema)
    formatted = chat.format_conversations(turns.unionByName(own))
    return chat.read_conversations(formatted).withColumn("conv_id", F.col("conv_id").cast("long"))


def op2_packing(spark: SparkSession, d: str) -> DataFrame:
    return pieces(packing.pack_documents(table(spark, d, "documents"), *tokenizer()))


def pieces(packed: DataFrame) -> DataFrame:
    return packed.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op3_sharding(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, d, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return shards.uniform_shards(rows, N_SHARDS).select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def fold_of(doc_id: Column) -> Column:
    """0, 1 or 2; labels of fold 1 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def quality_model(spark: SparkSession, documents: DataFrame, d: str) -> linecrf.Model:
    return linecrf.train(documents, table(spark, d, "labels"), usable=fold_of(F.col("doc_id")) != 1)


def op4_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "text")
    scored = linecrf.scored(documents, quality_model(spark, documents, d))
    return scored.select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return partenum.jaccard_components(table(spark, d, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )


def op6_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    return htmltext.extracted(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "text")
    hits = aho.contamination(documents, table(spark, d, "benchmark"))
    items = F.array_sort(F.transform("hits.items", lambda x: x.cast("string")))
    return hits.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def op8_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return content_sort.content_groups(table(spark, d, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op9_url_filters(spark: SparkSession, d: str) -> DataFrame:
    return url_templates.judge(table(spark, d, "pages"), URL_RULES).withColumnRenamed("id", "page_id").drop("template")


def op10_warc(spark: SparkSession, d: str) -> DataFrame:
    path = work_dir(spark, "warc")
    archive.write_archive(table(spark, d, "pages"), path)
    return archive.read_records(spark, path).select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


def op11_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    found = importance.resampled(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_components(table(spark, d, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op13_conversation_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, d, "conversations")).drop("last_ref")


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


def all_queries() -> dict[str, Query]:
    listed = [
        op1_chat_formatting, op2_packing, op3_sharding, op4_quality_classifier, op5_ngram_jaccard_join,
        op6_html_extraction, op7_benchmark_decontamination, op8_exact_dedup, op9_url_filters, op10_warc,
        op11_importance_resampling, op12_simhash_near_dedup, op13_conversation_trie, pipeline,
    ]
    return {q.__name__: q for q in listed}
