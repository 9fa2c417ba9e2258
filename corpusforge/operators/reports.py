"""Aggregations and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T


def half_even(amount: Column, by: Column) -> Column:
    """A whole amount divided by a whole number, to the nearest whole, halves to even; in whole numbers throughout."""
    whole = F.floor((amount - amount % by) / by)
    rest = amount % by
    return (whole + F.when(2 * rest > by, 1).when(2 * rest == by, whole % 2).otherwise(0)).cast("long")


def summary(rows: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Rows, characters, hours and mean duration by source and, with a null source, in all."""
    measured = rows.select(F.col(source).alias("source"), F.length(text).alias("_c"), F.bround(T.seconds(text) * 100).cast("long").alias("_s"))
    total = measured.rollup("source").agg(F.count("*").alias("n"), F.sum("_c").alias("chars"), F.sum("_s").alias("_s"))
    return total.select("source", "n", "chars", (half_even(F.col("_s"), F.lit(3600)) / 100).alias("hours"), (half_even(F.col("_s"), F.greatest("n", F.lit(1))) / 100).alias("mean_seconds"))


def histogram(rows: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts and percentages of all rows in [a, b) bins; the last is open, what lies below the first has no bin."""
    label = lambda a, b: f"{a:g}-{b:g}"
    v, chain = F.col(value), F.when(F.col(value) >= edges[-1], F.struct(F.lit(len(edges) - 1).alias("bin"), F.lit(f">={edges[-1]:g}").alias("label")))
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        chain = chain.when((v >= a) & (v < b), F.struct(F.lit(i).alias("bin"), F.lit(label(a, b)).alias("label")))
    counts = rows.groupBy(chain.alias("_b")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("_all", F.sum("n").over(Window.partitionBy()))
    return counts.where("_b is not null").select("_b.bin", "_b.label", "n", (F.lit(100.0) * F.col("n") / F.greatest("_all", F.lit(1))).alias("percent"))


def reasons(rows: DataFrame, reason: str = "reason", accepted: str = "ACCEPTADA") -> DataFrame:
    """Rows by reason label, with percentages."""
    counts = rows.groupBy(F.coalesce(T.reason_label(reason), F.lit(accepted)).alias("reason")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()))


def retention(rows: DataFrame, source: str = "source", reason: str = "reason", text: str = "text") -> DataFrame:
    """Before, after, share kept and hours kept by source."""
    kept = F.col(reason).isNull()
    cents = F.when(kept, F.bround(T.seconds(text) * 100).cast("long"))
    out = rows.groupBy(source).agg(F.count("*").alias("before"), F.count_if(kept).alias("after"), F.coalesce(F.sum(cents), F.lit(0)).alias("_s"))
    return out.select(source, "before", "after", (F.lit(100.0) * F.col("after") / F.col("before")).alias("percent"), (half_even(F.col("_s"), F.lit(3600)) / 100).alias("hours"))


def examples(rows: DataFrame, reason: str, key: str, most: int, order: Column) -> DataFrame:
    """So many rows of each reason, in an order that a hash fixes."""
    n = F.row_number().over(Window.partitionBy(reason).orderBy(order, key))
    return rows.withColumn("_n", n).where(F.col("_n") <= most).drop("_n")


def exact_at(rows: DataFrame, group: list[str], value: str, index: Column) -> DataFrame:
    """Each group's value at a place (from 0) of its sorted values, nulls left out; index is made from n.

    Equal values are counted first, so a group of any size is as many rows as it has different values.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*group)
    placed = counts.withColumns({"n": F.sum("_c").over(w), "_upto": F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    return placed.where((F.col("_upto") > index) & (F.col("_upto") - F.col("_c") <= index)).select(*group, "n", value)


def upper_median(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    return exact_at(rows, group, value, F.floor(F.col("n") / 2)).withColumnRenamed(value, "median")


def p95(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    return exact_at(rows, group, value, F.floor(F.col("n") * 95 / 100)).withColumnRenamed(value, "p95")


def p90(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    return exact_at(rows, group, value, F.floor((F.col("n") - 1) * 9 / 10)).withColumnRenamed(value, "p90")


def middle_row(rows: DataFrame, group: list[str], value: str, key: str) -> DataFrame:
    """Each group's row at the upper median, ties by key."""
    w = Window.partitionBy(*group)
    placed = rows.withColumns({"_at": F.row_number().over(w.orderBy(value, key)) - 1, "_n": F.count("*").over(w)})
    return placed.where(F.col("_at") == F.floor(F.col("_n") / 2)).drop("_at", "_n")


def nested_counts(rows: DataFrame, correct: str, variant: str) -> DataFrame:
    """For each right form its variants by count, and their total."""
    counts = rows.groupBy(correct, variant).agg(F.count("*").alias("n"))
    items = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("_o"), F.col(variant).alias("variant"), F.col("n").alias("n"))))
    grouped = counts.groupBy(correct).agg(items.alias("_v"), F.sum("n").alias("total"))
    return grouped.select(correct, "total", F.transform("_v", lambda v: F.struct(v["variant"].alias("variant"), v["n"].alias("n"))).alias("variants"))


def error_rates(rows: DataFrame, item: str, condition: str, voice: str, failed: Column, distance: str) -> DataFrame:
    """Error rate and mean distance of each item in all, by condition and by voice."""
    base = rows.select(F.col(item).alias("item"), F.col(condition).alias("condition"), F.col(voice).alias("voice"), failed.cast("int").alias("_f"), F.col(distance).cast("decimal(28,6)").alias("_d"))
    sets = base.groupingSets([["item"], ["item", "condition"], ["item", "voice"]], "item", "condition", "voice")
    return sets.agg(F.count("*").alias("n"), F.sum("_f").alias("failed"), (F.sum("_f").cast("double") / F.count("*")).alias("rate"), (F.sum("_d").cast("double") / F.count("*")).alias("distance"))


def majority(rows: DataFrame, item: str, label: str, order: str) -> DataFrame:
    """Each item's most frequent label; of equals the one seen first."""
    votes = rows.groupBy(item, label).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    best = F.max_by(F.struct(label, "n"), F.struct(F.col("n"), -F.col("_first")))
    return votes.groupBy(item).agg(best.alias("_b")).select(item, F.col(f"_b.{label}"), F.col("_b.n"))


def unbalanced(rows: DataFrame, voice: str, factor: float = 2.0) -> DataFrame:
    """Voices with more than factor times the mean number of clips."""
    counts = rows.groupBy(voice).agg(F.count("*").alias("n"))
    mean = F.sum("n").over(Window.partitionBy()) / F.count("*").over(Window.partitionBy())
    return counts.withColumn("mean", mean).where(F.col("n") > factor * F.col("mean"))


def breakdown(rows: DataFrame, dimensions: list[str], seconds: str) -> DataFrame:
    """Clips and seconds by each dimension on its own, in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]))
    return rows.select(F.col(seconds).cast("decimal(28,4)").alias("_s"), each.alias("_d")).groupBy("_d.dimension", "_d.value").agg(F.count("*").alias("n"), F.sum("_s").cast("double").alias("seconds"))


def top_values(rows: DataFrame, columns: list[str], most: int = 20) -> DataFrame:
    """The most frequent values of each column, blanks named."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.when(F.trim(c) != "", F.col(c)), F.lit("(blank)")).alias("value")) for c in columns]))
    counts = rows.select(each.alias("_v")).groupBy("_v.column", "_v.value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where(F.col("place") <= most)


def reconcile(captured: DataFrame, kept: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """Captured ids without a trace, traces without a captured id, and the number of each trace."""
    one, none = F.lit(1), F.lit(0)
    traces = kept.select(key, one.alias("_k"), none.alias("_r")).unionByName(rejected.select(key, none.alias("_k"), one.alias("_r")))
    traces = traces.groupBy(key).agg(F.sum("_k").alias("kept"), F.sum("_r").alias("rejected"))
    both = captured.select(key, F.lit(True).alias("_c")).join(traces, key, "full")
    state = F.when(F.col("_c").isNull(), "orphan").when(F.col("kept").isNull(), "lost").otherwise("traced")
    return both.select(key, state.alias("state"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("rejected", F.lit(0)).alias("rejected"))


def wilson(rows: DataFrame, group: list[str], hit: Column, z: float = 1.96) -> DataFrame:
    """Share of hits with its Wilson interval."""
    out = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum(hit.cast("int")).alias("hits"))
    p, n = F.col("hits") / F.col("n"), F.col("n")
    mid, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return out.withColumns({"share": p, "low": mid - half, "high": mid + half})


def audit(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row for each check: its name, the number of rows against it, and whether it passed."""
    rows = [c.agg(F.count("*").alias("against")).select(F.lit(name).alias("check"), "against", (F.col("against") == 0).alias("ok")) for name, c in checks]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def markdown(report: DataFrame, title: str, most: int = 1000) -> str:
    """A report as a Markdown table; a table of more rows is no report and raises an error."""
    held = report.limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} rows in the report {title!r}")
    line = lambda cells: "| " + " | ".join("" if c is None else f"{c:.2f}" if isinstance(c, float) else str(c) for c in cells) + " |"
    return "\n".join([f"## {title}", "", line(report.columns), line(["---"] * len(report.columns)), *(line(r) for r in held)])
