"""Benchmark decontamination by spaced seeds, by DataFrame functions alone.

A text is a row of token hashes. Each fixed mask looks at some of the positions of a short span and ignores the
rest, so a substituted word between them does no harm. A document is contaminated by an item if a stretch of OVERLAP
tokens (the whole item if it is shorter) agrees in at least AGREE_PERCENT of its places. The masks together hit every
such stretch: two of them those of OVERLAP tokens, and masks of their own the items of each smaller length, down to one
token. Test and training seeds are joined, and around a hit test and training tokens are compared position by position
on the hit's diagonal.

Seeds and items are broadcast, each once, while their bytes are at most MAX_BROADCAST_BYTES, which is counted first;
beyond that seeds are joined by a shuffle, and the documents that were hit are joined again for the comparison.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OVERLAP = 13
AGREE_PERCENT = 80
#: Fixed masks: the positions of a span that a seed looks at. One of them at least is free of substitutions somewhere in
#: any stretch of 13 tokens with at most two of them.
MASKS = ((0, 1, 2, 5, 7, 8), (0, 1, 3, 5, 6, 9))
#: Items of fewer tokens, words and names for the most part, are reported but don't remove a document by themselves.
DECISIVE_TOKENS = 5
MAX_BROADCAST_BYTES = 32 << 20
#: Bytes of a seed's row and of a token that the bound counts.
SEED_BYTES, TOKEN_BYTES = 48, 8
SPLIT = r"[^\p{L}\p{N}]+"


def masks_for(n: int) -> list[tuple[int, ...]]:
    """Masks over a whole item of n tokens, fewer than OVERLAP: whatever n // 5 places are substituted, one doesn't look there."""
    gone = n - -(-AGREE_PERCENT * n // 100)
    groups = gone + 2 if gone else 1
    return [tuple(i for i in range(n) if i % groups not in out) for out in combinations(range(groups), gone)]


def tokens(text: Column) -> Column:
    """Hashes of a text's lower-cased runs of letters and digits."""
    return F.transform(F.array_remove(F.split(F.lower(text), SPLIT), ""), lambda x: F.xxhash64(x))


def _seeds(rows: DataFrame, array: str, masks: list[tuple[int, tuple[int, ...]]], keep: list[str], at: str) -> DataFrame:
    """Rows (*keep, at, seed): the numbered masks' hashes at every position of the array; masks start at 0."""
    least = min(m[-1] for _, m in masks) + 1
    # outer, as otherwise a filter on the array's size is derived that computes the array once more
    placed = rows.select(*keep, array, F.expr(f"explode_outer(if(size({array}) >= {least}, sequence(0, size({array}) - {least}), array()))").alias(at))
    each = ", ".join(f"if({at} + {m[-1]} < size({array}), xxhash64({k}, {', '.join(f'get({array}, {at} + {i})' for i in m)}), null)" for k, m in masks)
    return placed.select(*keep, array, at, F.expr(f"explode(array({each}))").alias("seed")).where("seed is not null")


#: The document's tokens that the item would cover: the few that a hit carries on instead of the whole text.
NEAR = "slice(dt, greatest(d0, 0) + 1, greatest(least(d0 + bn, size(dt)) - greatest(d0, 0), 0))"


def _verified(hits: DataFrame) -> DataFrame:
    """From rows (..., near, bt, d0), d0 being where the item's first token would stand: those that overlap enough."""
    met = F.expr("transform(bt, (b, j) -> if(j + least(d0, 0) >= 0 and get(near, j + least(d0, 0)) <=> b, 1, 0))")
    hits = hits.withColumn("met", met).withColumn("stretch", F.least(F.lit(OVERLAP), F.size("bt")))
    sums = "transform(sequence(0, size(met) - stretch), s -> aggregate(slice(met, s + 1, stretch), 0, (a, x) -> a + x))"
    hits = hits.withColumn("good", F.expr(f"filter(transform({sums}, (n, s) -> if(100 * n >= {AGREE_PERCENT} * stretch, s, -1)), s -> s >= 0)")).where("size(good) > 0")
    hits = hits.withColumn("from", F.expr("array_min(good)")).withColumn("upto", F.expr("array_max(good) + stretch"))
    matched = F.expr("aggregate(slice(met, from + 1, upto - from), 0, (a, x) -> a + x)").cast("long")
    return hits.withColumn("doc_start", (F.col("d0") + F.col("from")).cast("long")).withColumn("overlap", (F.col("upto") - F.col("from")).cast("long")).withColumn("matched", matched)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows (doc_id, doc_hash, item_id, item_tokens, n_places, doc_start, overlap, matched): each document with each item it holds.

    doc_hash is the text's hash, n_places the number of places where the item was found, the rest describes the
    place with the most matching tokens (the first of equals), in tokens. Items of n tokens, fewer than OVERLAP, may
    differ in n // 5 of them, so those of one to four tokens must occur word for word. Null texts, texts and items
    without a token match nothing; equal items are reported one by one; rows that repeat doc_id and text are one
    document. Other columns are not read.
    """
    bench = items.select(F.col(item_id).alias("item_id"), tokens(F.col(item_text)).alias("bt")).where("size(bt) > 0").withColumn("bn", F.size("bt"))
    sizes = bench.groupBy(F.least("bn", F.lit(OVERLAP)).alias("n")).agg(F.count("*").alias("items"), F.sum("bn").alias("tokens")).collect()
    short = {r["n"]: masks_for(r["n"]) for r in sizes if r["n"] < OVERLAP}
    numbered, seeds = list(enumerate(MASKS)), None
    long_seeds = _seeds(bench.where(F.col("bn") >= OVERLAP), "bt", numbered, ["item_id", "bn"], "q").select("seed", "item_id", "bn", "q")
    own = []
    for n, masks in sorted(short.items()):
        for m in masks:
            k = len(numbered)
            numbered.append((k, tuple(i - m[0] for i in m)))
            hashed = ", ".join(f"get(bt, {i})" for i in m)
            own.append(F.when(F.col("bn") == n, F.struct(F.expr(f"xxhash64({k}, {hashed})").alias("seed"), F.lit(m[0]).alias("q"))))
    seeds = long_seeds
    if own:
        whole = bench.where(F.col("bn") < OVERLAP).select("item_id", "bn", F.explode(F.array_compact(F.array(*own))).alias("s"))
        seeds = seeds.unionByName(whole.select("s.seed", "item_id", "bn", "s.q"))
    if OVERLAP not in {r["n"] for r in sizes}:
        numbered = numbered[len(MASKS) :] or numbered
    text = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("doc_hash"), tokens(F.col(text_col)).alias("dt"))
    mine = _seeds(text, "dt", numbered, ["doc_id", "doc_hash"], "p")
    n_tokens = sum(r["tokens"] for r in sizes)
    n_seeds = sum(r["tokens"] * len(MASKS) if r["n"] == OVERLAP else r["items"] * len(short[r["n"]]) for r in sizes)
    few = n_seeds * SEED_BYTES + n_tokens * TOKEN_BYTES <= max_broadcast
    small = F.broadcast if few else lambda x: x
    if few:
        hits = mine.join(F.broadcast(seeds), "seed").withColumn("d0", F.col("p") - F.col("q"))
    else:
        hits = mine.drop("dt").join(seeds, "seed").select("doc_id", "doc_hash", "item_id", "bn", (F.col("p") - F.col("q")).alias("d0")).distinct()
        again = text.withColumnsRenamed({"doc_id": "_id", "doc_hash": "_hash"})
        hits = hits.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_hash") == F.col("_hash")))
    # one comparison for each diagonal; the aggregation also keeps it out of the join's generated code
    hits = hits.select("doc_id", "doc_hash", "item_id", "d0", F.expr(NEAR).alias("near"))
    diagonals = hits.groupBy("doc_id", "doc_hash", "item_id", "d0").agg(F.first("near").alias("near"))
    wanted = small(bench.select(F.col("item_id").alias("_item"), "bt"))
    found = _verified(diagonals.join(wanted, F.col("item_id").eqNullSafe(F.col("_item"))))
    best = F.max_by(F.struct("doc_start", "overlap", "matched"), F.struct("matched", -F.col("doc_start")))
    by_item = found.groupBy("doc_id", "doc_hash", "item_id").agg(F.max(F.size("bt")).alias("item_tokens"), F.countDistinct("d0").alias("n_places"), best.alias("best"))
    return by_item.select("doc_id", "doc_hash", "item_id", "item_tokens", "n_places", "best.*")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", decisive: int = DECISIVE_TOKENS) -> DataFrame:
    """The rows of docs, all their columns, that hold no item of at least decisive tokens. Null texts stay."""
    found = contaminated(docs, items, id_col, text_col).where(F.col("item_tokens") >= decisive).select(F.struct("doc_id", "doc_hash").alias("__leak")).distinct()
    key = F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("doc_hash"))
    return docs.join(found, key.eqNullSafe(F.col("__leak")), "left_anti")


ORACLE = rf"""
with d0 as (select distinct doc_id, text from documents where text is not null),
d1 as (select doc_id, row_number() over () as dk, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') as t from d0),
b1 as (select item_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') as t from benchmark),
d2 as (select doc_id, dk, unnest(t) as w, generate_subscripts(t, 1) - 1 as p from d1),
b2 as (select item_id, len(t) as n, least(len(t), {OVERLAP}) as stretch, unnest(t) as w, generate_subscripts(t, 1) - 1 as q from b1),
met as (
  select doc_id, dk, item_id, n, stretch, p - q as d, list(q) as qs from d2 join b2 using (w)
  group by doc_id, dk, item_id, n, stretch, d having 100 * count(*) >= {AGREE_PERCENT} * stretch),
start as (select *, unnest(range(0, n - stretch + 1)) as s from met),
good as (select * from start where 100 * len(list_filter(qs, lambda q: q >= s and q < s + stretch)) >= {AGREE_PERCENT} * stretch),
diagonal as (
  select doc_id, dk, item_id, d, any_value(qs) as qs, min(s) as a, max(s) + any_value(stretch) as b from good group by doc_id, dk, item_id, d),
place as (select *, d + a as doc_start, b - a as overlap, len(list_filter(qs, lambda q: q >= a and q < b)) as matched from diagonal),
best as (
  select *, row_number() over (partition by doc_id, dk, item_id order by matched desc, doc_start) as k, count(*) over (partition by doc_id, dk, item_id) as n_places from place)
select doc_id, item_id, n_places, doc_start, overlap, matched::bigint as matched from best where k = 1
"""
