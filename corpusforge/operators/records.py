"""Sentence records: their columns, corrections, fragments, buckets and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators.prefix import place_within

#: Clips in a folder; per mille of ids in the development split; rows a source may hold.
FOLDER, DEV_PER_MILLE, ROW_CAP, TEXT_CAP = 4000, 5, 50_000, 300


def with_measures(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, n_chars, seconds and hash of a text."""
    return rows.withColumns({"n_words": T.n_words(text), "n_chars": F.length(text), "seconds": T.seconds(text), "hash": T.identity_hash(text)})


def numbered(rows: DataFrame, source: str, order: list[str], text: str = "text") -> DataFrame:
    """Records with id source-0000000 on, counted within each source in the given order."""
    placed = place_within(rows, [source], order, "_place")
    return with_measures(placed.withColumn("id", F.format_string("%s-%07d", F.col(source), F.col("_place") - 1)).drop("_place"), text)


def capped(rows: DataFrame, source: str, order: list[str], cap: int = ROW_CAP) -> DataFrame:
    """At most cap rows a source, the first in order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("_n") <= cap).drop("_n")


def rejects(rows: DataFrame, step: int, text: str = "text", reason: str = "reason") -> DataFrame:
    """Rejected rows as they are logged: the text cut to 300 characters, the step's number."""
    return rows.withColumns({text: F.substring(text, 1, TEXT_CAP), "step": F.lit(step)})


def correct(rows: DataFrame, corrections: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """Applies corrections (key, new_text, remove): rows to remove go, texts are replaced and measured again."""
    fixes = corrections.select(F.col(key).alias("_k"), F.col("new_text").alias("_new"), F.coalesce(F.col("remove"), F.lit(False)).alias("_gone"))
    joined = rows.join(fixes, F.col(key) == F.col("_k"), "left").where("not coalesce(_gone, false)")
    patched = joined.withColumns({"corrected": F.col("_k").isNotNull(), text: F.coalesce("_new", text)})
    return with_measures(patched.drop("_k", "_new", "_gone"), text)


def fragments(rows: DataFrame, parts: Column, key: str = "id", text: str = "text") -> DataFrame:
    """One row for each part; the id gets -1, -2 ... where there are several."""
    exploded = rows.withColumn("_parts", parts).select(*[c for c in rows.columns if c != text], F.size("_parts").alias("_n"), F.posexplode("_parts").alias("_k", text))
    named = F.when(F.col("_n") > 1, F.concat(F.col(key), F.lit("-"), (F.col("_k") + 1).cast("string"))).otherwise(F.col(key))
    return exploded.withColumn(key, named).drop("_n", "_k")


def folder(key: Column | str, per_block: bool = True) -> Column:
    """The bucket folder of a clip id like name-0001234: name_first-last in steps of 4,000."""
    name = F.regexp_extract(key, r"^([a-z_]+)-(\d{7})(?:-\d+)?$", 1)
    n = F.regexp_extract(key, r"^([a-z_]+)-(\d{7})(?:-\d+)?$", 2).try_cast("long")
    start = F.floor(n / FOLDER) * FOLDER
    return F.when(name != "", F.format_string("%s_%06d-%06d", name, start, start + FOLDER - 1) if per_block else name)


def hash_number(key: Column | str, digits: int = 8) -> Column:
    """The leading hex digits of an id's SHA-256, as a whole number."""
    return F.conv(F.substring(F.sha2(T.col(key).cast("string"), 256), 1, digits), 16, 10).cast("decimal(20,0)")


def split_of(key: Column | str, per_mille: int = DEV_PER_MILLE) -> Column:
    """dev or train, by the id alone."""
    return F.when(hash_number(key) % 1000 < per_mille, "dev").otherwise("train")


def split_without_leaks(rows: DataFrame, key: str = "id", text: str = "text", per_mille: int = DEV_PER_MILLE) -> DataFrame:
    """Adds split: dev, train, or exclos for a train row whose text is also one of dev's."""
    marked = rows.withColumns({"split": split_of(key, per_mille), "_key": T.dedup_key(text)})
    dev = marked.where("split = 'dev'").select(F.col("_key").alias("_dev")).distinct()
    joined = marked.join(dev, F.col("_key") == F.col("_dev"), "left")
    return joined.withColumn("split", F.when((F.col("split") == "train") & F.col("_dev").isNotNull(), "exclos").otherwise(F.col("split"))).drop("_key", "_dev")


def stable_seed(*parts: Column | str, modulus: int = 2**31) -> Column:
    """A seed from the contents: the first eight bytes of the SHA-256 of the parts joined by |."""
    joined = F.concat_ws("|", *[T.col(p).cast("string") for p in parts])
    return (hash_number(joined, 16) % modulus).cast("long")


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the contents."""
    return stable_seed(*parts) / F.lit(float(2**31))


def training_view(manifest: DataFrame) -> DataFrame:
    """The columns that training reads, renamed."""
    return manifest.select("audio", "text", F.col("durada_s").alias("duration"), F.col("veu_id").alias("speaker"), F.col("entorn_id").alias("entorn"), "font", "id", "split")


def label_text(rows: DataFrame, text: str = "text", other: str = "transcript") -> DataFrame:
    """Training labels: text, else the transcript, cleaned; rows that have neither go, marks alone leave an empty label."""
    raw = F.coalesce(F.when(F.trim(text) != "", F.col(text)), F.col(other))
    return rows.withColumn("_raw", raw).where("trim(_raw) <> ''").withColumn("label", T.transcript("_raw")).drop("_raw")


def cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost of model calls from token counts and a price table (model, per_million_in, per_million_out)."""
    total = (F.col("tokens_in") * F.col("per_million_in") + F.col("tokens_out") * F.col("per_million_out")) / 1e6
    return usage.join(F.broadcast(prices), "model", "left").withColumn("cost", total)
