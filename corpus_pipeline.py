"""The corpus pipeline: documents in, the documents to train on and their copies out.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet to the
shared folder and read again as the next one's input, so a lost executor costs tasks of one
stage. All stages but the last return the columns of ``documents``.

No SQL stands in for the whole: MinHash and the random mix have none. The tests hold each
stage against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salestide.llm import decontaminate, line_dedup, mixing, ngram_join, quality_rules
from salestide.session import stored


def good_hosts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, of hosts that do."""
    return quality_rules.keep_good(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of similar lines; documents left without lines go."""
    return line_dedup.dedup(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return ngram_join.keep_one(docs)


def unseen_questions(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each source, with the number of copies."""
    return mixing.take(docs)


STAGES = [
    ("quality rules", good_hosts),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", unseen_questions),
    ("mixing sources to target weights", mixed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


query = run
