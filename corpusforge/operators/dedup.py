"""Duplicates, templates and leaks: windows and semi or anti joins; losers can be asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T


def priority(source: Column | str, names: list[str]) -> Column:
    """The place of a source in a list; unknown ones come last."""
    chain = F.lit(len(names))
    for i, name in reversed(list(enumerate(names))):
        chain = F.when(T.col(source) == name, i).otherwise(chain)
    return chain


def by_priority(rows: DataFrame, key: Column | str, rank: Column, order: list[str], source: str = "source") -> DataFrame:
    """Adds place (1: the row that stays, 2: any other) and winner (the source whose copy stays).

    Winners are found by an aggregation that combines before it shuffles, so a key may hold any share of the rows;
    rows of equal rank and order are told apart by nothing else, order has to be unique within a key.
    """
    mine = F.struct("_rank", *order)
    placed = rows.withColumns({"_key": T.col(key), "_rank": rank}).withColumn("_mine", mine)
    best = placed.groupBy(F.col("_key").alias("_k")).agg(F.min(F.struct("_mine", F.col(source).alias("_s"))).alias("_best"))
    joined = placed.join(best, F.col("_key").eqNullSafe(F.col("_k")))
    first = F.when(F.col("_mine").eqNullSafe(F.col("_best._mine")), 1).otherwise(2)
    return joined.withColumns({"place": first, "winner": F.col("_best._s")}).select(*rows.columns, "place", "winner")


def keep_best(rows: DataFrame, key: Column | str, rank: Column, order: list[str]) -> DataFrame:
    """The rows that by_priority puts first, by one aggregation."""
    row = F.struct(*rows.columns)
    placed = rows.withColumns({"_key": T.col(key), "_rank": rank})
    best = placed.groupBy("_key").agg(F.min_by(row, F.struct("_rank", *order)).alias("_row"))
    return best.select("_row.*")


def winners(placed: DataFrame) -> DataFrame:
    return placed.where("place = 1").drop("place", "winner")


def losers(placed: DataFrame) -> DataFrame:
    """The rows that go, with the reason."""
    return placed.where("place = 2").withColumn("reason", F.concat(F.lit("duplicada (es queda la de "), F.col("winner"), F.lit(")"))).drop("place", "winner")


def first_of(rows: DataFrame, key: Column | str | list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an order; never an arbitrary one."""
    keys = key if isinstance(key, list) else [key]
    w = Window.partitionBy(*[T.col(k) for k in keys]).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def template_cap(rows: DataFrame, text: str, order: list, most: int = 20) -> DataFrame:
    """At most so many rows for each skeleton, the first in order."""
    w = Window.partitionBy("_skeleton").orderBy(*order)
    return rows.withColumn("_skeleton", T.skeleton(text)).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n", "_skeleton")


def without(rows: DataFrame, others: DataFrame, key: Column | str, other_key: Column | str) -> DataFrame:
    """Left anti join by a computed key."""
    keys = others.select(T.col(other_key).alias("_other")).distinct()
    return rows.withColumn("_key", T.col(key)).join(keys, F.col("_key") == F.col("_other"), "left_anti").drop("_key")


def only(rows: DataFrame, others: DataFrame, key: Column | str, other_key: Column | str) -> DataFrame:
    """Left semi join by a computed key; empty where nothing leaks."""
    keys = others.select(T.col(other_key).alias("_other")).distinct()
    return rows.withColumn("_key", T.col(key)).join(keys, F.col("_key") == F.col("_other"), "left_semi").drop("_key")


def containing(rows: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, gram: int = 5) -> DataFrame:
    """Pairs of a row and an item whose dedup key the row's key contains.

    The pairs to look at come from an equi-join: an item's first words, gram of them at most, hashed, against all
    word grams of that length in the rows; the containment is then checked as it is.
    """
    spread = items.select(F.col(item_id).alias("item_id"), T.dedup_key(item_text).alias("item_key")).where("item_key <> ''")
    spread = spread.withColumn("_w", F.split("item_key", " ")).withColumn("n", F.least(F.lit(gram), F.size("_w")))
    hashed = lambda w, i, n: F.xxhash64(F.lit(n), *[F.get(w, i + k) for k in range(n)])
    lengths = sorted(r[0] for r in spread.select("n").distinct().collect())  # gram numbers at most
    if not lengths:
        return rows.withColumn("item_id", F.lit(None).cast(items.schema[item_id].dataType)).where("false")
    first = F.coalesce(*[F.when(F.col("n") == n, hashed(F.col("_w"), F.lit(0), n)) for n in lengths])
    probe = spread.select("item_id", "item_key", first.alias("gram"))
    keyed = rows.withColumn("__key", T.dedup_key(text)).withColumn("__hash", F.xxhash64("__key"))
    words = keyed.where("__key is not null").select("__hash", F.split("__key", " ").alias("w"))
    # only hashes are multiplied, never texts
    at = words.select("__hash", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("i"))
    each = F.array(*[F.when(F.col("i") + n <= F.size("w"), hashed(F.col("w"), F.col("i"), n)) for n in lengths])
    grams = at.select("__hash", F.explode(each).alias("gram")).where("gram is not null")
    met = grams.join(probe, "gram").select("__hash", "item_id", "item_key").distinct()
    hit = keyed.join(met, "__hash")
    return hit.where(F.concat(F.lit(" "), F.col("__key"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("item_key"), F.lit(" ")))).drop("__key", "__hash", "item_key")


def semi_self(rows: DataFrame, key: str, role: str, first: str, second: str) -> DataFrame:
    """Rows of the second role whose key also occurs in the first: what one may not read because another has."""
    seen = rows.where(F.col(role) == first).select(F.col(key).alias("_seen")).distinct()
    return rows.where(F.col(role) == second).join(seen, F.col(key) == F.col("_seen"), "left_semi")


def pending(plan: DataFrame, done: DataFrame, key: str, finished: Column) -> DataFrame:
    """What a resumed run still has to do: rows of the plan without a finished record."""
    return plan.join(done.where(finished).select(key).distinct(), key, "left_anti")
