"""Sinks: JSON lines, rejects by step, source commits, upserts and resumable logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.sources.readers import exists


def origin_last(rows: DataFrame, column: str = "origen") -> DataFrame:
    return rows.select(*[c for c in rows.columns if c != column], *([column] if column in rows.columns else []))


def write_jsonl(rows: DataFrame, path: str) -> int:
    """Overwrites a folder of JSON lines; gives the number of rows, counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    origin_last(rows).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return int(seen.get["n"])


def write_rejects(rows: DataFrame, path: str, step: str = "step") -> None:
    """Replaces the rejects of the steps that rows hold, and those of no other step."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(step).parquet(path)


def commit_source(accepted: DataFrame, rejected: DataFrame, path: str, text: str = "text", seconds: str = "seconds") -> DataFrame:
    """A source's accepted rows, its rejects and one row of figures about them."""
    accepted.write.mode("overwrite").parquet(f"{path}/accepted")
    write_rejects(rejected, f"{path}/rejected")
    spark = accepted.sparkSession
    kept, lost = spark.read.parquet(f"{path}/accepted"), spark.read.parquet(f"{path}/rejected")
    cents = F.bround(F.col(seconds) * 100).cast("long")
    figures = kept.agg(F.count("*").alias("accepted"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars"), F.bround(F.coalesce(F.sum(cents), F.lit(0)) / 360_000, 2).alias("hours"))
    meta = figures.crossJoin(lost.agg(F.count("*").alias("rejected"))).withColumn("date", F.current_date())
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return spark.read.json(f"{path}/meta")


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def merge_into(rows: DataFrame, path: str, key: str) -> DataFrame:
    """New rows replace those of the same key; written beside and read from there, so a failed write loses nothing."""
    spark = rows.sparkSession
    version = 0
    while exists(spark, f"{path}/v{version}/_SUCCESS"):
        version += 1
    merged = rows if not version else spark.read.parquet(f"{path}/v{version - 1}").join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)
    merged.write.mode("overwrite").parquet(f"{path}/v{version}")
    return spark.read.parquet(f"{path}/v{version}")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    version = 0
    while exists(spark, f"{path}/v{version + 1}/_SUCCESS"):
        version += 1
    return spark.read.parquet(f"{path}/v{version}")


def results_in_order(rows: DataFrame, error: str = "error", rate: str = "rate", distance: str = "distance", key: str = "item") -> DataFrame:
    """Measured rows, the worst first, then those that failed."""
    return rows.orderBy(F.col(error).isNotNull(), F.desc(rate), F.desc(distance), key)


def write_by_folder(rows: DataFrame, path: str, folder: str) -> None:
    """Rows in a folder for each bucket; rows of a bucket are brought together first, so buckets have few files."""
    rows.repartition(folder).write.mode("overwrite").partitionBy(folder).parquet(path)


def write_sheet(rows: DataFrame, path: str, blanks: list[str]) -> None:
    """A CSV to be filled in by hand: the rows with empty columns added."""
    rows.withColumns({b: F.lit("") for b in blanks}).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
