"""Entities: runs of capitals, full forms of fragments, what counts as evidence, and the funnel over them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from corpusforge.functions import metrics, numbers
from corpusforge.functions import text as T
from corpusforge.operators import gates

#: Words in a run, signs that end one, least likeness and length of an entity, the mark of an omission.
MOST_WORDS, ENDS, EDGES, LEAST_LIKE, LEAST_LENGTH, OMITTED = 3, ",;:.()«»…!?", ",.;:¿?¡!()\"'«»…—-", 0.65, 4, "<omitida>"


def runs_of_capitals(sentence: str) -> list[str]:
    """Runs of two or three capitalised words, not at the start; a sign after a word ends its run."""
    words = sentence.split()
    found: list[str] = []
    run: list[str] = []
    for w in words[1:]:
        bare = w.strip(EDGES)
        if bare[:1].isupper() and len(run) < MOST_WORDS:
            run.append(bare)
            closed = w[-1] in ENDS
        elif bare[:1].isupper():
            found.append(" ".join(run))
            run, closed = [bare], w[-1] in ENDS
        else:
            closed = True
        if closed:
            found.append(" ".join(run))
            run = []
    return [r for r in [*found, " ".join(run)] if " " in r]


@pandas_udf(ArrayType(StringType()))
def capital_runs(sentences: pd.Series) -> pd.Series:
    return sentences.map(runs_of_capitals, na_action="ignore")


def runs(rows: DataFrame, text: str) -> DataFrame:
    """Rows (run, n): how often each run occurs in the sentences of a text."""
    cut = rows.select(F.explode(F.split(text, r"(?<=[.!?])\s+|\n")).alias("s"))
    return cut.select(F.explode(capital_runs("s")).alias("run")).groupBy("run").agg(F.count("*").alias("n"))


def full_forms(counts: DataFrame) -> DataFrame:
    """Rows (fragment, form): the most frequent run that holds a word."""
    each = counts.select(F.explode(F.array_distinct(F.split(T.metric_key("run"), " "))).alias("fragment"), "run", "n")
    return each.groupBy("fragment").agg(F.max_by("run", F.struct("n", "run")).alias("form"))


def marks(x: Column | str) -> Column:
    """How many accented letters a word has."""
    return F.length(T.col(x)) - F.length(F.translate(F.lower(T.col(x)), T.MARKED, ""))


def accent_added(right: Column | str, heard: Column | str) -> Column:
    """Whether a variant only adds accents: then the reference is what is misspelt."""
    return (T.col(heard) != OMITTED) & (T.strip_accents(heard) == T.strip_accents(right)) & (marks(heard) > marks(right))


@pandas_udf(StringType())
def number_said(x: pd.Series) -> pd.Series:
    return x.map(lambda t: numbers.spanish_words(int(t)) if t is not None and t.isdigit() and len(t) < 12 else None, na_action="ignore")


def digit_of(right: Column | str, heard: Column | str) -> Column:
    """Whether a variant is the right word written in digits."""
    return F.coalesce(T.strip_accents(number_said(T.col(heard))) == T.strip_accents(right), F.lit(False))


def change_kind(before: Column | str, after: Column | str) -> Column:
    """What a correction changed: capitals only, accents, an expansion, or the spelling."""
    a, b = F.lower(F.trim(T.col(before))), F.lower(F.trim(T.col(after)))
    ka, kb = T.lookup_key(before), T.lookup_key(after)
    around = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    within = around(kb).contains(around(ka)) | around(ka).contains(around(kb))
    return F.when(a == b, "solo_mayusculas").when((T.strip_accents(a) == T.strip_accents(b)) | (ka == kb), "acento").when(within, "expansion").otherwise("grafia_distinta")


def discard_reason(name: Column, runs_seen: Column, all_common: Column) -> Column:
    """A common noun, unless it is a repeated run of capitals; or too short."""
    return gates.first_reason([("nombre_comun", (runs_seen < 2) & all_common), ("muy_corta", F.length(F.replace(name, F.lit(" "), F.lit(""))) < LEAST_LENGTH)])


def funnel(errors: DataFrame, counts: DataFrame, use: DataFrame) -> DataFrame:
    """Rows (entity, times, variants, reason) from errors (fragment, variant, n), runs (run, n) and use (form, upper, lower).

    Fragments become full forms; variants that are accents, digits or too unlike are no evidence; then entities
    that are common nouns or too short, and those without evidence, are given their reason.
    """
    formed = errors.join(full_forms(counts), "fragment", "left").withColumn("entity", F.coalesce("form", "fragment"))
    good = ~accent_added("fragment", "variant") & ~digit_of("fragment", "variant") & (F.col("variant") != OMITTED) & (metrics.likeness("fragment", "variant") >= LEAST_LIKE)
    judged = formed.withColumn("_good", good)
    grouped = judged.groupBy("entity").agg(F.sum("n").alias("times"), F.array_sort(F.collect_set(F.when(F.col("_good"), F.col("variant")))).alias("variants"), F.count_if(F.col("variant") == OMITTED).alias("_omitted"))
    words = grouped.select("entity", F.explode(F.split(T.metric_key("entity"), " ")).alias("form")).join(use, "form", "left")
    common = words.groupBy("entity").agg(F.min(F.coalesce(F.col("lower") >= F.greatest(F.lit(1), F.col("upper") * 0.5), F.lit(False))).alias("_common"))
    seen = counts.select(F.col("run").alias("entity"), F.col("n").alias("_runs"))
    full = grouped.join(common, "entity", "left").join(seen, "entity", "left")
    reason = discard_reason(F.col("entity"), F.coalesce("_runs", F.lit(0)), F.coalesce("_common", F.lit(False)))
    without = F.when(F.size("variants") == 0, F.when(F.col("_omitted") > 0, "solo_omitida").otherwise("sin_evidencia"))
    return full.select("entity", "times", "variants", F.coalesce(reason, without).alias("reason"))


def unclassified_names(rows: DataFrame, key: str, text: str, classified: DataFrame, respelled, least: int = 3) -> DataFrame:
    """Names (word) that nobody classified, that aren't common in lower case, and that respelling would change."""
    from corpusforge.operators import lexicon

    use = lexicon.usage(rows, key, text)
    common = use.where(F.col("lower") >= least).select("form")
    each = lexicon.tokens(rows, key, text).where(F.col("word").rlike(r"^\p{Lu}") & ~T.is_acronym(F.col("word")) & (F.col("at") > 0)).select("word").distinct()
    left = each.join(classified.select("word"), "word", "left_anti").join(common, F.lower("word") == F.col("form"), "left_anti")
    return left.where(respelled(F.col("word")) != F.col("word"))
