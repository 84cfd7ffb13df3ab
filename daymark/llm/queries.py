"""One registered query for each operator, over its whole table."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import chat, licences
from daymark.llm.backoff_lm import score_texts
from daymark.llm.decontaminate import contaminated, find_benchmark, hit_words
from daymark.llm.filter_audit import audit
from daymark.llm.line_dedup import deduplicate_lines
from daymark.llm.near_dedup import near_duplicates
from daymark.llm.neighbours import nearest
from daymark.llm.packing import cut_documents, pack
from daymark.llm.planes import read_ids, segment_starts, write_ids
from daymark.llm.quality import CUT, train, with_quality
from daymark.llm.repeats import remove_repeats
from daymark.llm.source_divergence import divergence
from daymark.llm.storage import shared_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=4)


def tokenizer(name: str) -> str:
    """The path of a public tokenizer's file, on the driver and on every executor."""
    return importlib.import_module("public_tokenizers").path(name)


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = cut_documents(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op3_projected_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def bucket_of_id(buckets: int) -> F.Column:
    """The remainder of the crc32 of an id as text, which splits rows to learn from and rows to test on."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % buckets


def op4_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"), bucket_of_id(7) == 2)


def op5_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = bucket_of_id(5) == 0
    model = train(docs, table(spark, folder, "labels"), ~held_out)
    return with_quality(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def op6_id_planes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    target = shared_path(docs, "ids")
    write_ids(docs, target, tokenizer("byte_bpe_50k.json"))
    found = read_ids(spark, target).select(
        "shard",
        "segment",
        "doc_id",
        "place",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return found.join(segment_starts(spark, target), ["shard", "segment"]).select(
        "doc_id", (F.col("segment_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, folder, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("found.items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit_words().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as raw transcripts: a speaker marker before each turn, but for one turn in four."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    place = F.concat_ws(":", "conv_id", "turn")
    marked = F.when(
        (F.crc32(place.cast("binary")) % 4 != 0) & F.col("role").isNotNull(),
        F.concat(F.initcap("role"), F.lit(": "), F.coalesce("text", F.lit(""))),
    )
    return turns.withColumn("text", F.coalesce(marked, "text"))


def op8_chat_roles(spark: SparkSession, folder: str) -> DataFrame:
    raw = transcripts(spark, folder)
    # The roles of every fifth conversation are not learned from.
    learned = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % 5 != 0
    return chat.format_chats(raw, chat.train(raw, learned))


def op9_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.train(spark)).filter("confirmed")
    of_doc = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("licences")
    )
    return docs.select("doc_id").join(of_doc, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).alias("n_licence_paragraphs"),
        F.coalesce("licences", F.lit("")).alias("licences"),
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return deduplicate_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(table(spark, folder, "documents"))


def op12_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, folder, "documents"))
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("left")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("left", 256).alias("kept_sha256"),
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_projected_neighbours": op3_projected_neighbours,
    "op4_backoff_lm": op4_backoff_lm,
    "op5_pairwise_quality": op5_pairwise_quality,
    "op6_id_planes": op6_id_planes,
    "op7_decontaminate": op7_decontaminate,
    "op8_chat_roles": op8_chat_roles,
    "op9_licence_scan": op9_licence_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_repeated_strings": op12_repeated_strings,
    "op13_filter_audit": op13_filter_audit,
}
