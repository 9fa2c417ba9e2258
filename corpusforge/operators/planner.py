"""Plans: which voice, environment, speed and seed each sentence gets; candidates and entities by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import ordering as O
from corpusforge.operators import records
from corpusforge.operators.dedup import first_of

#: The range of speeds.
SLOW, FAST = 0.94, 1.06


def active(environments: DataFrame, overrides: dict[str, float]) -> DataFrame:
    """Environments by overridden weight, those of weight zero left out."""
    weight = F.col("weight")
    for name, w in overrides.items():
        weight = F.when(F.col("id") == name, F.lit(float(w))).otherwise(weight)
    return environments.withColumn("weight", weight).where("weight > 0")


def compatible(styles: DataFrame, environments: DataFrame, style: str = "style") -> DataFrame:
    """Pairs of a style and an environment one of whose tags (styles array) the style contains; all where none does."""
    named = environments.select(F.col("id").alias("environment"), "weight", "styles")
    pairs = styles.select(style).distinct().crossJoin(F.broadcast(named))  # two dimension tables
    fits = F.exists("styles", lambda tag: F.lower(F.col(style)).contains(F.lower(tag)))
    marked = pairs.withColumn("_fits", fits).withColumn("_any", F.max("_fits").over(Window.partitionBy(style)))
    return marked.where("_fits or not _any").select(style, "environment", "weight")


def plan(rows: DataFrame, voices: DataFrame, environments: DataFrame, key: str = "id", style: str = "font", seconds: str = "seconds", trusted: list[str] | None = None, rate: float = 3.0, seed: str = "42") -> DataFrame:
    """Adds plan_pos, voice, environment, speed and seed.

    Rows stand in a hash's order, with trusted sources interleaved by their rate; voices are dealt in rounds over
    the whole order, environments in rounds by weight within each style.
    """
    shuffled = O.global_place(rows, [O.hash_order(key, seed=seed), key], "_at")
    if trusted:
        tiers = shuffled.withColumn("_tier", F.col(style).isin(trusted))
        turned = O.interleave(tiers, "_tier", seconds, ["_at"], {True: rate})
        shuffled = O.global_place(turned.drop("_at", "_tier"), ["turn", key], "_at").drop("turn")
    voiced = O.round_robin(shuffled.withColumnRenamed("_at", "plan_pos"), "plan_pos", voices.select(F.col("id").alias("voice")), "voice", seed)
    seats = O.by_weight(compatible(rows, environments, style), "weight")
    seats = seats.withColumns({"_seat": F.row_number().over(Window.partitionBy(style).orderBy(O.hash_order("environment", "copy", seed=seed), "environment", "copy")) - 1, "_seats": F.count("*").over(Window.partitionBy(style))})
    within = O.place_within(voiced, [style], ["plan_pos"], "_k").withColumn("_k", F.col("_k") - 1)
    sized = within.join(seats.select(style, "_seats").distinct(), style)
    # every lap turns the order of the seats by its own amount
    lap = F.floor(F.col("_k") / F.col("_seats"))
    turned = sized.withColumn("_seat", ((F.col("_k") + records.stable_seed(F.lit(seed), style, lap)) % F.col("_seats")).cast("int"))
    dealt = turned.join(seats.select(style, "_seat", "environment"), [style, "_seat"])
    speed = F.bround(SLOW + (FAST - SLOW) * records.uniform(F.lit("speed"), F.lit(seed), key), 3)
    return dealt.withColumns({"speed": speed, "seed": records.stable_seed(F.lit(seed), key)}).drop("_k", "_seat", "_seats")


def pinned(planned: DataFrame, real: Column, environment: str = "environment") -> DataFrame:
    """Voices from real recordings keep the real environment."""
    return planned.withColumn(environment, F.when(real, "font_real").otherwise(F.col(environment)))


def measurements(entities: DataFrame, templates: DataFrame, voices: DataFrame, conditions: DataFrame, said: DataFrame, seed: str = "42") -> DataFrame:
    """Every entity in every template by every voice under every condition, with what is to be said and a seed.

    The three other tables are dimensions of a study; the seed is one for all voices of a condition and template.
    """
    keyed = entities.withColumn("key", T.lookup_key("entity")).join(said.select(T.lookup_key("spelling").alias("key"), F.col("value").alias("_v")), "key", "left")
    spoken = keyed.select("entity", F.coalesce("_v", "entity").alias("said"))
    full = spoken.crossJoin(F.broadcast(templates)).crossJoin(F.broadcast(voices)).crossJoin(F.broadcast(conditions))
    return full.withColumns({"text": F.replace("template", F.lit("{}"), F.col("said")), "seed": records.stable_seed(F.lit(seed), "condition", "template")})


def missing_combinations(entities: DataFrame, styles: DataFrame, done: DataFrame, enough: int = 5) -> DataFrame:
    """Pairs of entity and style that don't have enough sentences yet, and how many they lack."""
    have = done.groupBy("entity", "style").agg(F.count("*").alias("_n"))
    pairs = entities.crossJoin(F.broadcast(styles)).join(have, ["entity", "style"], "left")
    return pairs.withColumn("lacks", enough - F.coalesce("_n", F.lit(0))).where("lacks > 0").drop("_n")


def without_long_forms(names: DataFrame) -> DataFrame:
    """Rows (name, long_form): a short name goes where its long form is in the list itself."""
    return names.join(names.select(F.col("name").alias("_l")), F.col("long_form") == F.col("_l"), "left_anti")


def by_sources(tables: list[DataFrame], key: str, value: str) -> DataFrame:
    """Of each key the value from the first table that has it."""
    stacked = tables[0].select(key, value).withColumn("_p", F.lit(0))
    for i, t in enumerate(tables[1:], 1):
        stacked = stacked.unionByName(t.select(key, value).withColumn("_p", F.lit(i)))
    return first_of(stacked.where(F.col(value).isNotNull()), key, ["_p", value]).drop("_p")


def merged_groups(rows: DataFrame, name: str, count: str, sources: str) -> DataFrame:
    """Names that share a lookup key, as one: the most frequent spelling, counts added, sources united."""
    keyed = rows.withColumn("key", T.lookup_key(name))
    return keyed.groupBy("key").agg(F.max_by(name, F.struct(count, name)).alias(name), F.sum(count).alias(count), F.array_sort(F.array_distinct(F.flatten(F.collect_list(sources)))).alias(sources))


def candidates(wrong: DataFrame, measured: DataFrame, anchors: list[str], least: float = 0.3) -> DataFrame:
    """Entities by priority: 10 for those seen wrong, else 1 + rate + a tenth of the distance where the rate is high enough.

    wrong has (entity), measured (entity, rate, distance); names that share a key are one, the higher priority first.
    """
    a = wrong.select("entity", F.lit(10.0).alias("priority"))
    b = measured.where(F.col("rate") >= least).select("entity", (1 + F.col("rate") + 0.1 * F.col("distance")).alias("priority"))
    listed = a.unionByName(b).withColumn("key", T.lookup_key("entity")).where(~F.col("key").isin([x.lower() for x in anchors]))
    return first_of(listed, "key", [F.desc("priority"), "entity"]).select("entity", "priority").orderBy(F.desc("priority"), "entity")


def quotas(n: int, sources: list[str]) -> dict[str, int]:
    """A quota shared equally, the rest to the last."""
    base = n // len(sources)
    return {s: base + (n % len(sources) if k == len(sources) - 1 else 0) for k, s in enumerate(sources)}


def best_match(vectors: DataFrame, references: DataFrame, least: float = -1.0) -> DataFrame:
    """Of each vector (id, embedding) the most similar reference (ref, vector); a short list of references is joined to all."""
    from corpusforge.functions.metrics import cosine

    pairs = vectors.crossJoin(references).withColumn("similarity", cosine("embedding", "vector"))
    best = pairs.groupBy("id").agg(F.max_by("ref", F.struct("similarity", "ref")).alias("ref"), F.max("similarity").alias("similarity"))
    return best.where(F.col("similarity") > least)
