"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next one's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import quality
from daymark.llm.decontaminate import remove_documents
from daymark.llm.line_dedup import deduplicate_lines
from daymark.llm.near_dedup import near_duplicates
from daymark.llm.packing import cut_documents, pack
from daymark.llm.queries import bucket_of_id, table, tokenizer
from daymark.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking scores at its threshold or above."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), bucket_of_id(5) != 0)
    scored = quality.with_quality(docs, model, result="_score")
    return scored.filter(F.col("_score") >= quality.CUT).drop("_score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier line; a document left without a line with words goes."""
    counted = deduplicate_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    left = counted.filter(~emptied)
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    columns = {"n_chars": F.coalesce(chars, F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return left.withColumns(columns).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    groups = near_duplicates(docs, words=5, percent=80)
    gone = groups.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty stands in benchmark passages."""
    return remove_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents in pieces, each with its place in a sequence of at most 2048 ids."""
    return pack(cut_documents(docs, tokenizer("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
