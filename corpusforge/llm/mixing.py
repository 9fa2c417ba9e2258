"""Mixing sources to target weights, by DataFrame functions alone.

Every document gets a random key from a hash of its id and text. Within a source documents stand in key order; the uniform
key's leading digits cut the order into ranges of equal width, word counts are summed by range, the sums run over a
source's ranges, and only within its range is a document sorted. So the prefix sum of every document comes from
two small windows, and no window holds a source. A source's budget is met to the word: whole epochs first, then
documents in key order, the one at the cut in part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.session import materialize

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_EPOCHS = 2
#: Hex digits of the key that name its range: 16 ** digits ranges a source.
RANGE_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Rows (doc_id, source, size, key): the number of words and the hash-random key."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.md5(text_col), F.lit(""))))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Rows (source, source_size, target, budget) from a table (source, size).

    Shares go by weight; a source stops at most_epochs times its size and what it can't use is dealt again by
    weight, until none is above. The level at which that ends is found from a few sums, one short job a round.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # ranks by code point, null last: names are sorted in ranges, only the ranges' counts meet in one task
    order = by_source.repartitionByRange(F.col("source").isNull().cast("int"), F.col("source")).withColumn("part", F.spark_partition_id())
    order = materialize(order, "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = order.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(F.col("source").isNull().cast("int"), "source")
    rank = order.join(F.broadcast(parts), "part").withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = materialize(rank.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most_epochs).alias("most")), "ranked")
    level, total = 0.0, None
    while True:
        free = F.col("most") > F.lit(level) * F.col("weight")
        row = ranked.agg(F.sum("source_size"), F.sum(F.when(~free, F.col("most"))), F.sum(F.when(free, F.col("weight")))).first()
        total, full, rest = row[0] or 0, row[1] or 0, row[2] or 0
        after = (total * share_percent / 100 - full) / rest if rest else level
        if after <= level:
            break
        level = after
    target = F.when(F.col("most") <= F.lit(level) * F.col("weight"), F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target")).withColumn("budget", F.floor(F.col("target") + 0.5))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken), one for each row of docs.

    taken is the number of words the mix takes from the document, repeats counted: at most most_epochs times its
    size. A source's taken words add up to its target, rounded. A null text has no words, null sources are one
    source and come last, documents without words take none, sources without words have target 0; repeated rows
    are mixed row by row. Rows of one key have the same id and text, so whichever comes first the result is the same. An empty table gives an empty result.
    """
    all_sized = materialize(sized(docs, id_col, text_col, source_col), "sized")
    goal = targets(all_sized, weights, share_percent, most_epochs)
    ranged = all_sized.withColumn("slice", F.substring("key", 1, RANGE_DIGITS))
    up_to = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = ranged.groupBy("source", "slice").agg(F.sum("size").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    slices = slices.alias("s").join(goal.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
    slices = slices.select(F.col("s.source").alias("_source"), F.col("slice").alias("_slice"), "start", "source_size", "target", "budget")
    inside = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = ranged.withColumn("upto", F.sum("size").over(inside))
    placed = within.join(slices, F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("budget") - epochs * F.col("source_size") - (F.col("start") + F.col("upto") - F.col("size"))
    taken = epochs * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, md5(coalesce(doc_id::varchar, '') || '|' || coalesce(md5(text), '')) as k from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select source, source_size, 2 * source_size as most, ([3, 1, 2])[((row_number() over (order by source nulls last)) - 1) % 3 + 1] as weight from s),
o as (
  select *, coalesce(sum(most) over (order by most::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint as full_before,
         sum(weight) over (order by most::double / weight, source nulls last rows between current row and unbounded following)::bigint as free_weight from w),
lv as (
  select coalesce(max(l), 0.0) as level from (
    select (((select sum(source_size) from s) * 150)::double / 100.0 - full_before) / free_weight as l, most, weight from o) where most > l * weight),
g as (
  select source, source_size, case when most <= level * weight then most::double else level * weight end as target from w, lv),
p as (
  select *, (sum(size) over (partition by source order by k, doc_id, size rows between unbounded preceding and current row))::bigint as upto from d),
b as (
  select p.*, g.source_size, g.target, floor(g.target + 0.5)::bigint as budget from p join g on p.source is not distinct from g.source),
e as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from b)
select doc_id, size, source_size, target, (epochs * size + least(greatest(budget - epochs * source_size - (upto - size), 0), size))::bigint as taken from e
"""
