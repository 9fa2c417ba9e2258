"""Keyed dictionaries as tables (spelling, value, reviewed, source, pos), unique by lookup key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import gates

KEPT, WAITING, GIVEN = "sense_canvi", "pendent_fonetica", "amb_fonetica"


def keyed(entries: DataFrame, spelling: str = "spelling") -> DataFrame:
    return entries.withColumn("key", T.lookup_key(spelling))


def index(entries: DataFrame, order: str = "pos") -> DataFrame:
    """The first entry of each key, and whether others contradict it."""
    w = Window.partitionBy("key")
    placed = keyed(entries).withColumns({"_n": F.row_number().over(w.orderBy(order)), "_low": F.min("value").over(w), "_high": F.max("value").over(w)})
    return placed.where("_n = 1").withColumn("conflict", F.coalesce(F.col("_low") != F.col("_high"), F.lit(False))).drop("_n", "_low", "_high")


def lookup(rows: DataFrame, spelling: str, entries: DataFrame) -> DataFrame:
    """Adds said: the dictionary's value by key, else the spelling itself."""
    values = keyed(entries).select("key", F.col("value").alias("_v"))
    return rows.withColumn("key", T.lookup_key(spelling)).join(values, "key", "left").withColumn("said", F.coalesce("_v", spelling)).drop("_v", "key")


def upsert(entries: DataFrame, new: DataFrame) -> DataFrame:
    """New entries replace old ones of the same key; the old spelling stays."""
    old = keyed(entries)
    fresh = keyed(new).alias("n").join(old.select("key", F.col("spelling").alias("_was")), "key", "left")
    fresh = fresh.withColumn("spelling", F.coalesce("_was", "spelling")).drop("_was")
    return old.join(fresh.select("key"), "key", "left_anti").unionByName(fresh.select(*old.columns)).drop("key")


def upsert_values(entries: DataFrame, new: DataFrame) -> DataFrame:
    """As upsert, after empty and unchanged values have become decisions to keep the spelling."""
    same = (F.coalesce(F.trim("value"), F.lit("")) == "") | gates.same_spelling("spelling", "value")
    ready = new.withColumns({"state": F.when(same, KEPT).otherwise(GIVEN), "value": F.when(~same, F.col("value"))})
    return upsert(entries, ready)


def delete(entries: DataFrame, keys: DataFrame) -> DataFrame:
    """Entries without those whose spelling has one of the keys (spelling)."""
    return keyed(entries).join(keys.select(T.lookup_key("spelling").alias("key")).distinct(), "key", "left_anti").drop("key")


def merge(entries: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merges new values in; reviewed entries stay. Also the counts of new, updated and protected ones."""
    a, b = keyed(entries).alias("a"), keyed(new).alias("b")
    both = a.join(b, F.col("a.key") == F.col("b.key"), "full")
    outcome = (
        F.when(F.col("b.key").isNull(), "untouched").when(F.col("a.key").isNull(), "new").when(F.coalesce(F.col("a.reviewed"), F.lit(False)), "protected").when(F.col("a.value").eqNullSafe(F.col("b.value")), "same").otherwise("updated")
    )
    take = outcome.isin("new", "updated")
    pick = lambda c: F.when(take, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    spelling = F.coalesce(F.col("a.spelling"), F.col("b.spelling")).alias("spelling")
    merged = both.select(spelling, *[pick(c) for c in entries.columns if c != "spelling"])
    return merged.select(*entries.columns), both.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def subset(entries: DataFrame, active: DataFrame) -> DataFrame:
    """Entries whose key is among the active spellings; what is left out is the anti join."""
    return keyed(entries).join(active.select(T.lookup_key("spelling").alias("key")).distinct(), "key", "left_semi").drop("key")


def overrides(entries: DataFrame) -> DataFrame:
    """The flat view of spellings that have a value of their own."""
    return entries.where((F.col("state") == GIVEN) & F.col("value").isNotNull()).select("spelling", "value")


def invalidate(entries: DataFrame, changed: Column) -> DataFrame:
    """Without automatic, unreviewed entries by a model, where the rules' version changed."""
    stale = changed & ~F.coalesce(F.col("reviewed"), F.lit(False)) & F.col("source").startswith("llm")
    return entries.where(~F.coalesce(stale, F.lit(False)))


def load_cache(entries: DataFrame) -> DataFrame:
    """Entries of known states; a value that changes nothing becomes the decision to keep the spelling."""
    same = (F.col("state") == GIVEN) & gates.same_spelling("spelling", "value")
    known = entries.where(F.col("state").isin(KEPT, WAITING, GIVEN))
    return known.withColumns({"state": F.when(same, KEPT).otherwise(F.col("state")), "value": F.when(same, F.lit(None)).otherwise(F.col("value"))})


def needs_value(state: Column | str) -> Column:
    """Three-valued: true, false, or null where nothing is decided."""
    s = T.col(state)
    return F.when(s == WAITING, True).when(s.isin(KEPT, GIVEN), False)


def decision(suspicious: Column, reviewed: Column) -> Column:
    return F.when(reviewed, "validated").when(suspicious, "review").otherwise("rejected")
