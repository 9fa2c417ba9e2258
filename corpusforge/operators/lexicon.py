"""Word usage: lexicons, acronyms, names, first examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.session import materialize

#: Words of a lexicon that are broadcast at most, the most frequent ones; the others are joined by a shuffle.
MAX_BROADCAST = 500_000


def tokens(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, at, word): the words of each text in order."""
    return rows.select(key, F.posexplode(T.words(text)).alias("at", "word"))


def lexicon(rows: DataFrame, text: str, least: int = 3) -> DataFrame:
    """Words that begin in lower case and occur often enough."""
    words = rows.select(F.explode(T.words(text)).alias("word")).where(r"word rlike '^\\p{Ll}'")
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def unknown_share(rows: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """For each text the share of its lower-cased words that a lexicon (word) lacks."""
    each = rows.select(key, F.explode(T.words(text)).alias("word")).select(key, F.lower("word").alias("word"))
    held = materialize(known.select("word", (F.col("n") if "n" in known.columns else F.lit(1)).alias("_often")), "lexicon")
    least, total = 0, 0
    for often, words in sorted(held.groupBy("_often").count().collect(), reverse=True):
        total += words
        if total > MAX_BROADCAST:
            least = often + 1
            break
    # words of the lexicon's frequent part are told in the task that reads a text; of the others alone each is a row of a shuffle
    frequent = held.where(F.col("_often") >= least).select("word", F.lit(1).alias("_in"))
    told = each.join(F.broadcast(frequent), "word", "left").select(key, F.when(F.col("_in").isNull(), F.col("word")).alias("word"))
    counted = told.groupBy(key, "word").agg(F.count("*").alias("n"))
    if least:
        rare = held.where(F.col("_often") < least).select("word", F.lit(1).alias("_in"))
        counted = counted.join(rare, "word", "left")
    else:
        counted = told.withColumns({"n": F.lit(1).cast("long"), "_in": F.lit(None).cast("int")})
    unknown = F.when(F.col("word").isNotNull() & F.col("_in").isNull(), F.col("n")).otherwise(0)
    return counted.groupBy(key).agg(F.sum("n").alias("words"), F.sum(unknown).alias("unknown")).withColumn("share", F.col("unknown") / F.col("words"))


def acronyms(rows: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    """Acronyms that stand inside texts often enough, and more often than at their start."""
    shaped = tokens(rows, key, text).where(T.is_acronym(F.col("word")))
    counts = shaped.groupBy("word").agg(F.count_if(F.col("at") > 0).alias("inside"), F.count_if(F.col("at") == 0).alias("initial"))
    return counts.where((F.col("inside") >= least) & (F.col("inside") > F.col("initial")))


def usage(rows: DataFrame, key: str, text: str) -> DataFrame:
    """How often each lower-cased word is an acronym, a name inside a text, or in lower case."""
    word, inside = F.col("word"), F.col("at") > 0
    short = T.is_acronym(word)
    each = tokens(rows, key, text).groupBy(F.lower("word").alias("form"))
    upper = word.rlike(r"^\p{Lu}")
    return each.agg(F.count_if(short).alias("acronym"), F.count_if(upper & ~short & inside).alias("name"), F.count_if(~upper).alias("lower"))


def first_examples(rows: DataFrame, key: str, text: str, most: int = 2) -> DataFrame:
    """For each word the first texts that hold it; headlines only where nothing else does."""
    # flag and words once for each text, in a step of their own: after the explode they would be taken once a word
    flagged = rows.select(key, T.is_headline(text).cast("int").alias("_head"), F.array_distinct(T.words(F.lower(text))).alias("_words"))
    each = flagged.where(F.size("_words") > 0).select(key, "_head", F.explode("_words").alias("word"))
    # tasks keep the first ones of each word before the shuffle, as the limit stands on the window itself
    place = F.row_number().over(Window.partitionBy("word").orderBy("_head", key))
    return each.withColumn("place", place).where(F.col("place") <= most).select("word", "place", key)


#: Spanish words that are no proper names.
STOP = (
    "el la los las un una y pero que como cuando donde porque para por con sin sobre entre desde hasta este esta estos estas ese esa esos esas su sus mi mis tu tus no si ya aqui alli ahi ahora antes despues bueno pues "
    "claro hola adios gracias buenas buenos hoy manana ayer nos me te se le les lo al del es son era fue hay muy mas menos tambien tanto todo toda todos todas nada algo cada otro otra otros otras mucho mucha muchos "
    "muchas poco vamos voy va van eh ah oh vale mira oye bien mal senor senora don dona asi quien cual tras han hemos he has habia a en de o u"
).split()


def names(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Capitalised words that open no sentence and are no stop words, by text."""
    parts = rows.select(key, F.explode(F.split(text, r"(?<=[.!?])\s+")).alias("_s"))
    words = parts.select(key, F.posexplode(F.split(F.trim("_s"), r"\s+")).alias("_at", "_w")).where("_at > 0")
    bare = words.select(key, F.regexp_replace("_w", r"^[,.;:¿?¡!()\"'«»…—-]+|[,.;:¿?¡!()\"'«»…—-]+$", "").alias("_w"))
    good = bare.where(r"_w rlike '^[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]{2,}'").select(key, T.metric_key("_w").alias("name"))
    return good.where(~T.strip_accents("name").isin(STOP) & (F.col("name") != "")).distinct()


def contained_names(names_table: DataFrame, name: str, freq: str) -> DataFrame:
    """Each short name with the most frequent longer one that holds it as a word."""
    long = names_table.where(F.size(F.split(name, " ")) > 1).select(F.explode(F.array_distinct(F.split(name, " "))).alias("_t"), F.col(name).alias("long"), F.col(freq).alias("_f"))
    best = long.groupBy("_t").agg(F.max_by("long", F.struct(F.col("_f"), "long")).alias("long"))
    return names_table.where(F.size(F.split(name, " ")) == 1).join(best, F.col(name) == F.col("_t")).drop("_t")


def candidates(words: DataFrame, decided: DataFrame, count: Column, least: int) -> DataFrame:
    """Words that occur often enough and are not yet decided."""
    return words.where(count >= least).join(decided.select("word").distinct(), "word", "left_anti")
