"""Operators over an order: running sums, budgets, rounds, lots, packs and runs.

Where an order runs over all rows or large groups (tiers, budgets, rounds) places and sums come from
corpusforge.operators.prefix, not from a window that would hold all of them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import col
from corpusforge.operators.prefix import global_place, place_within, running
from corpusforge.operators.records import hash_number


def hash_order(*parts: Column | str, seed: str = "42") -> Column:
    """A reproducible shuffle's sort key."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *[col(p).cast("string") for p in parts]), 256)


def interleave(rows: DataFrame, tier: str, value: str, order: list[str], rates: dict) -> DataFrame:
    """Adds turn: the running amount within a tier over the tier's rate; sorting by it interleaves the tiers."""
    chain = F.lit(1.0)
    for k, rate in rates.items():
        chain = F.when(F.col(tier) == k, F.lit(float(rate))).otherwise(chain)
    return running(rows, value, [tier], order, "_sum").withColumn("turn", F.col("_sum") / chain).drop("_sum")


def budget_cut(rows: DataFrame, value: str, group: list[str], order: list[str], target: float) -> DataFrame:
    """Rows until the running amount reaches the target, the one that crosses it included."""
    return running(rows, value, group, order, "_sum").where(F.col("_sum") - F.col(value) < target).drop("_sum")


def milestones(rows: DataFrame, value: str, group: list[str], order: list[str], marks: list[float], key: str) -> DataFrame:
    """For each group and mark the first row at which the running amount reaches it."""
    summed = running(rows, value, group, order, "_sum").withColumn("mark", F.explode(F.array(*[F.lit(float(m)) for m in marks])))
    return summed.where(F.col("_sum") >= F.col("mark")).groupBy(*group, "mark").agg(F.min_by(key, "_sum").alias(key), F.min("_sum").alias("reached"))


def lots(rows: DataFrame, place: str, voice: str, length: str, key: str, block: int = 2000, size: int = 4) -> DataFrame:
    """Adds block and lot: blocks of the plan's order, in each a voice's rows by length, so many to a lot."""
    blocked = rows.withColumn("block", F.floor(F.col(place) / block).cast("long"))
    n = F.row_number().over(Window.partitionBy("block", voice).orderBy(length, key)) - 1
    return blocked.withColumn("lot", F.floor(n / size).cast("long"))


def round_robin(rows: DataFrame, place: str, items: DataFrame, item: str, seed: str = "42") -> DataFrame:
    """Gives row number place an item: every lap deals all items once, in an order of its own.

    Counts differ by one at most. A lap has as many rows as there are items, so laps times items is no more than
    the rows themselves and one lap.
    """
    n = items.count()
    if not n:
        raise ValueError("no items to deal")
    laps = rows.select(F.floor(F.col(place) / n).cast("long").alias("_lap")).distinct()
    turned = laps.crossJoin(F.broadcast(items.select(item)) if n <= 10_000 else items.select(item))
    numbered = turned.withColumn("_seat", F.row_number().over(Window.partitionBy("_lap").orderBy(hash_order("_lap", item, seed=seed), item)) - 1)
    seated = rows.withColumns({"_lap": F.floor(F.col(place) / n).cast("long"), "_seat": (F.col(place) % n).cast("int")})
    return seated.join(numbered, ["_lap", "_seat"]).drop("_lap", "_seat")


def by_weight(items: DataFrame, weight: str, resolution: int = 10) -> DataFrame:
    """Items repeated by weight, each once at least; copy numbers them."""
    copies = F.greatest(F.lit(1), F.bround(F.col(weight) * resolution).cast("int"))
    return items.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))


def interleave_groups(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds round, the place within a group; sorting by (round, group) takes the groups in turn."""
    return place_within(rows, [group], order, "round")


def quota(rows: DataFrame, group: str, score: str, key: str, most: int) -> DataFrame:
    """The best so many of each group."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), key))
    return rows.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def stratified(rows: DataFrame, outer: str, inner: str, key: str, most: int, seed: str = "42") -> DataFrame:
    """At most so many rows of each outer group, spread over the inner ones: one of each before a second of any."""
    first = F.row_number().over(Window.partitionBy(outer, inner).orderBy(hash_order(key, seed=seed), key))
    spread = rows.withColumn("_r", first)
    n = F.row_number().over(Window.partitionBy(outer).orderBy("_r", hash_order(inner, outer, seed=seed), inner))
    return spread.withColumn("_n", n).where(F.col("_n") <= most).drop("_n", "_r")


def top_up(rows: DataFrame, chosen: DataFrame, group: str, key: str, least: int, seed: str = "42") -> DataFrame:
    """More rows for groups of which fewer than least were chosen."""
    have = chosen.groupBy(group).agg(F.count("*").alias("_have"))
    rest = rows.join(chosen.select(key), key, "left_anti").join(have, group, "left")
    n = F.row_number().over(Window.partitionBy(group).orderBy(hash_order(key, seed=seed), key))
    return rest.withColumn("_n", n).where(F.col("_n") + F.coalesce("_have", F.lit(0)) <= least).drop("_n", "_have")


def oversample(rows: DataFrame, condition: Column, times: int) -> DataFrame:
    """Rows that meet a condition so many times, the rest once; copy numbers them."""
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(condition, times).otherwise(1))))


def alternatives(rows: DataFrame, group: list[str], score: str, key: str, more: int = 3) -> DataFrame:
    """The best row of each group and the next ones as an array."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("_s"), F.col(key).alias("key"), F.col(score).alias("score"))))
    found = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(score), key))).where(F.col("_n") <= more + 1)
    grouped = found.groupBy(*group).agg(ordered.alias("_all"))
    rest = F.transform(F.slice("_all", 2, more), lambda x: x["key"])
    return grouped.select(*group, F.get("_all", 0)["key"].alias("best"), F.get("_all", 0)["score"].alias("score"), rest.alias("others"))


def nearest_then_best(rows: DataFrame, group: str, value: str, to: float, score: str, key: str, among: int = 10) -> DataFrame:
    """Among the so many rows nearest to a value, each group's best by score."""
    near = F.row_number().over(Window.partitionBy(group).orderBy(F.abs(F.col(value) - to), key))
    best = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), key))
    return rows.withColumn("_n", near).where(F.col("_n") <= among).withColumn("_b", best).where("_b = 1").drop("_n", "_b")


def runs(rows: DataFrame, group: list[str], order: list[str], value: str, at: str) -> DataFrame:
    """Maximal runs of equal neighbouring values: their number, value, first and last place and length."""
    w = Window.partitionBy(*group).orderBy(*order)
    change = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = rows.withColumn("_c", change).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return marked.groupBy(*group, "run").agg(F.first(value).alias(value), F.min(at).alias("start"), F.max(at).alias("end"), F.count("*").alias("n"))


def pack_sessions(rows: DataFrame, group: str, order: list[str], seconds: str, key: str, text: str, most: float = 28.0, gap: float = 0.5) -> DataFrame:
    """Greedy packs of neighbouring clips of a group: (group, pack, clips, text, duration, n).

    A clip that would take a pack over the limit, gaps counted, starts the next; packs of one clip are lost. A
    group's clips are folded in one pass over its sorted array.
    """
    items = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(seconds).cast("double").alias("d"), F.col(key).alias("k"), F.col(text).alias("t"))))
    fold = f"""aggregate(items, named_struct('pack', 0, 'dur', 0D, 'n', 0, 'out', cast(array() as array<int>)),
        (a, x) -> if(a.n > 0 and a.dur + x.d + {gap}D * a.n > {most}D,
                     named_struct('pack', a.pack + 1, 'dur', x.d, 'n', 1, 'out', concat(a.out, array(a.pack + 1))),
                     named_struct('pack', a.pack, 'dur', a.dur + x.d, 'n', a.n + 1, 'out', concat(a.out, array(a.pack)))), a -> a.out)"""
    packed = rows.groupBy(group).agg(items.alias("items")).withColumn("packs", F.expr(fold))
    each = packed.select(group, F.posexplode(F.arrays_zip("items", "packs")).alias("at", "z")).select(group, "at", "z.packs", "z.items.*")
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("at", F.col(c).alias("v")))), lambda s: s["v"])
    out = each.groupBy(group, F.col("packs").alias("pack")).agg(ordered("k").alias("clips"), F.array_join(ordered("t"), " ").alias("text"), F.sum("d").alias("duration"), F.count("*").alias("n"))
    return out.where("n >= 2")


def balanced_queue(rows: DataFrame, group: str, score: str, key: str, last: str = "unknown") -> DataFrame:
    """Adds queue: groups take turns by place, those of the last group after all others."""
    return global_place(place_within(rows, [group], [-F.col(score), key], "_n"), [(F.col(group) == last).cast("int"), "_n", group, key], "queue").drop("_n")


def equal_parts(n: Column, parts: Column | int, which: Column) -> tuple[Column, Column]:
    """First place and size of one of so many near-equal contiguous parts of n things."""
    k = F.lit(parts) if isinstance(parts, int) else parts
    base, extra = F.floor(n / k), n % k
    return which * base + F.least(which, extra), base + (which < extra).cast("int")


def greedy_cover(rows: DataFrame, key: str, categories: str, most: int) -> pd.DataFrame:
    """Examples that show the most categories not yet shown, then the rest in order; for a short list.

    All rows count: the driver gets the least row of each distinct set of categories, and the first most rows.
    """
    least = rows.where(F.col(categories).isNotNull()).groupBy(F.array_sort(F.array_distinct(categories)).alias("_set")).agg(F.min(F.struct(key, categories)).alias("_row"))
    left = list(least.select("_row.*").orderBy(key).toPandas().itertuples(index=False))
    seen: set = set()
    picked: list = []
    while left and len(picked) < most:
        at = max(range(len(left)), key=lambda k: len(set(left[k][1]) - seen))
        if not set(left[at][1]) - seen:
            break
        seen |= set(left[at][1])
        picked.append(left.pop(at))
    same = lambda r: (r[0], None if r[1] is None else tuple(r[1]))
    shown, rest = [same(r) for r in picked], []
    for r in rows.select(key, categories).orderBy(key, categories).limit(most).toPandas().itertuples(index=False):
        if same(r) in shown:
            shown.remove(same(r))
        else:
            rest.append(r)
    picked += rest[: most - len(picked)]
    return pd.DataFrame(picked, columns=[key, categories])


def hash_ratio_split(rows: DataFrame, key: str, ratio: float) -> DataFrame:
    """Adds part: train for the first rows in the order of the key's MD5, dev for the rest; the cut is by count."""
    total = rows.count()
    placed = global_place(rows, [F.md5(F.col(key).cast("string")), key], "_at")
    return placed.withColumn("part", F.when(F.col("_at") < int(total * ratio), "train").otherwise("dev")).drop("_at")


def per_mille_below(key: Column | str, n: int) -> Column:
    return hash_number(key) % 1000 < n
