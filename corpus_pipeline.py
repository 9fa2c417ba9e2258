"""A training-data pipeline of five stages, each one of the operators in corpusforge.llm.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; a run writes it as Parquet and reads it again as
the next stage's docs. Stages but the last return the columns of documents; the last returns the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import decontamination, line_dedup, mixing, quality_cnn, wide_simhash
from corpusforge.session import delete, scratch, shared_dir, table, write


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network rejects go."""
    return quality_cnn.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; a document that loses every line goes with them."""
    cleaned = line_dedup.dedup_lines(docs, details=True).withColumn("n_chars", _length(docs))
    return cleaned.where("n_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").select(*docs.columns)


def _length(docs: DataFrame) -> Column:
    return F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return wide_simhash.near_dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each document the number of words taken from it, repeats counted; those not taken go."""
    mixed = mixing.mix(docs)
    return mixed.where("taken > 0").select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]
#: The network and the fingerprints' hash are beyond SQL; the tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; results between them are tables in the shared folder, deleted once the next has read them."""
    docs, before, last = table(spark, sf_dir, "documents"), None, len(STAGES) - 1
    for k, (name, stage) in enumerate(STAGES):
        if k == last:
            return stage(spark, docs, sf_dir)
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            write(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
