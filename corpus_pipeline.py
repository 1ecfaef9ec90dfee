"""The corpus pipeline: from raw documents to token-budget batches.

``STAGES`` lists (name, function). A function takes ``(spark, docs, sf_dir)``, where ``docs`` is what its predecessor
kept, and works on all of it; all but the last return the columns of ``documents``. Between stages the kept
documents are written as Parquet to the cluster's shared folder, so a lost executor costs no more than one stage.

Columns of ``documents`` that are null pass through; a null text is an empty text to every stage. Rows that repeat a
``doc_id`` are one document to a stage where they share their text too. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm.common import cut, fresh, table
from finloom.llm.decontaminate import drop_leaked
from finloom.llm.line_dedup import dedup_lines
from finloom.llm.packing import pack
from finloom.llm.quality import score, train
from finloom.llm.simhash import keep_first


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds good; it learns from those of them that are labelled and not held out."""
    weights = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    own = fresh(docs, "quality_score")
    return score(docs, weights, name=own).where(F.col(own) >= 0.5).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that resemble an earlier one; those left without text by it go."""
    order = docs.columns
    counts = {"n_lines": fresh(docs, "lines_before"), "n_removed": fresh(docs, "lines_gone")}
    before = docs.withColumnsRenamed({name: new for name, new in counts.items() if name in docs.columns})
    kept = dedup_lines(before)
    changed = F.col("n_removed") > 0
    kept = kept.where(~changed | (F.trim(F.regexp_replace("text", r"[\x09-\x0D ]+", " ")) != ""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))
                               .cast(docs.schema["n_chars"].dataType))
    kept = kept.drop("n_lines", "n_removed").withColumnsRenamed({new: name for name, new in counts.items()})
    return kept.select(*order)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in a batch."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("packing", batches),
]

ORACLE_SQL = None  # the classifier has no form in SQL; tests hold every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
