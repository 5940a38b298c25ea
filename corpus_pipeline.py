"""Corpus pipeline over ``documents``: filter, clean, deduplicate, decontaminate, tokenize.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``docs``.  ``run`` writes what a stage returns to the
shared folder and reads it back as the next stage's input, so a lost executor
never costs more than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import decontaminate, line_dedup, quality_rules, simhash_dedup
from duelframe.llm.common import read_table, written
from duelframe.llm.queries import bpe_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    forest = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, forest, prefix="__").where("__kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text."""
    clean = line_dedup.drop_boilerplate(docs, n_lines="__lines_in", n_dropped="__lines_out")
    chars = F.when(F.col("__lines_out") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return simhash_dedup.keep_one(docs, shingle=3, max_bits=2).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and of what they decode to."""
    return bpe_digests(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("byte-level BPE", tokens)]

#: Forest, fingerprints and tokens can't be put in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
