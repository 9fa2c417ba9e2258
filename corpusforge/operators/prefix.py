"""Places and running sums over an order, by prefix counts over ranges: no task sees more than a range of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import col
from corpusforge.session import materialize


def _dealt(rows: DataFrame, order: list[Column | str]) -> tuple[DataFrame, list[str]]:
    """rows with their keys __ord0 ... and the range (__part) of the order that each lies in.

    They are written first: sampled ranges may differ from one evaluation to the next.
    """
    names = [f"__ord{i}" for i in range(len(order))]
    keyed = rows.select("*", *[col(k).alias(n) for k, n in zip(order, names, strict=True)])
    return materialize(keyed.repartitionByRange(*names).withColumn("__part", F.spark_partition_id()), "ranges"), names


def global_place(rows: DataFrame, order: list[Column | str], name: str = "place") -> DataFrame:
    """Adds each row's place from 0 in a total order."""
    dealt, names = _dealt(rows, order)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*names)) - 1
    return dealt.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + inside).drop("__part", "__start", *names)


def running(rows: DataFrame, value: Column | str, group: list[str], order: list[Column | str], name: str = "running") -> DataFrame:
    """Adds the running sum within groups, the row itself included; a group may hold any share of the rows.

    Ranges are cut over groups and order together, so a large group lies in many; what stands before a range is summed
    from one row for each range and group. Rows of equal order stand in any order; null groups are one group.
    """
    dealt, names = _dealt(rows.withColumn("__value", col(value)), [*group, *order])
    mine = names[: len(group)]
    sums = dealt.groupBy("__part", *mine).agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(*mine).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("__part").alias("__p"), *[F.col(n).alias(f"__g{k}") for k, n in enumerate(mine)], F.sum("__sum").over(before).alias("__start"))
    # a group's first range has nothing before it, so only groups that go on are joined
    starts = starts.where("__start is not null")
    inside = F.sum("__value").over(Window.partitionBy("__part", *mine).orderBy(*names[len(group) :]).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.col("__part") == F.col("__p")
    for k, n in enumerate(mine):
        same = same & F.col(n).eqNullSafe(F.col(f"__g{k}"))
    summed = dealt.withColumn("__in", inside).join(starts, same, "left")
    total = F.when(F.col("__start").isNull(), F.col("__in")).when(F.col("__in").isNull(), F.col("__start")).otherwise(F.col("__start") + F.col("__in"))
    return summed.withColumn(name, total).select(*rows.columns, name)


def place_within(rows: DataFrame, group: list[str], order: list[Column | str], name: str) -> DataFrame:
    """Adds each row's place from 1 within its group."""
    return running(rows, F.lit(1), group, order, name)
