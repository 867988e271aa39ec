"""Corpus pipeline: quality, near-dedup, decontamination, privacy, packing.

Each stage takes all rows its predecessor kept and returns the columns of
``documents``; the last returns the packed pieces. Between stages the rows are
written as Parquet into the shared folder and read again, so a lost executor
costs no more than a stage.

Defined results: each row is judged by its own text, whatever other rows have its
``doc_id``, null or not. Null and empty texts have too few words and go in the first
stage; of equal rows, and of each group of similar texts, one stays in the second;
a text that shares a window with the benchmark goes in the third; the fourth changes
texts and drops none; the last packs each row it gets. Texts of any length are taken
whole. Other columns, of any type and name, pass the first four stages unchanged. No
rows give no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import decontaminate, jaccard, packing, pii, quality
from threadloom.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_personal_data(docs, pii.session_key(spark)).drop("n_replaced")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("surrogates", privacy),
    ("packing", best_fit_packing),
]

#: SQL has no learned rules and no tokenizer: tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
