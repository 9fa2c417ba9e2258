"""The ten opN_ queries, each over the whole of its table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import decontamination, html_text, licenses, line_dedup, lm_scoring, mixing, quality_cnn, quality_rules, simhash, url_filter
from corpusforge.session import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), details=True).select("doc_id", "text", "n_lines", "n_removed")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select(F.col("doc_id").alias("id"))
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_places", "doc_start", "overlap", "matched")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (op1_line_dedup, op2_quality_rules, op3_simhash, op4_lm_scoring, op5_mixing, op6_url_filter, op7_quality_cnn, op8_decontamination, op9_html_text, op10_licenses)
    return {f.__name__: f for f in each}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE, "op5_mixing": mixing.ORACLE, "op6_url_filter": url_filter.oracle(), "op8_decontamination": decontamination.ORACLE}
