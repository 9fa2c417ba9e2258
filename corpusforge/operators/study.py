"""Small steps of plans, studies and training: lookups, joins with defaults, profiles, labels, prompts, guards."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators.prefix import place_within

#: Vowels of the phone study and the letters that stand for a stressed one.
VOWELS, STRESSED = "aeiouàèéíòóúïü", "àèéíòóú"


def canonical(x: Column | str, table: dict[str, str], default: str) -> Column:
    """The table's word for a value, whatever its case and blanks; the default for others and nulls."""
    return F.coalesce(F.create_map(*[F.lit(v) for pair in table.items() for v in pair])[F.lower(F.trim(T.col(x)))], F.lit(default))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a over b; null where b is null or 0."""
    return T.col(a) / F.nullif(T.col(b), F.lit(0))


def mentions_any(x: Column | str, words: list[str]) -> Column:
    """Whether a text holds any of some keywords, case and accents left out."""
    bare = T.strip_accents(x)
    found = F.lit(False)
    for w in words:
        found = found | bare.contains(F.lit(w))
    return F.coalesce(found, F.lit(False))


def with_defaults(rows: DataFrame, others: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """rows with columns of others by key, defaults where others has no row; others has one row a key."""
    joined = rows.join(others.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items() if v is not None})


def reserved_voices(voices: DataFrame, accents: list[str], least_snr: float = 45.0) -> DataFrame:
    """Voices fit for the reserve: an accent of the list, a clean signal, no transients."""
    return voices.where(F.col("accent").isin(accents) & (F.col("snr_db") >= least_snr) & (F.col("transients") == 0))


def anchor_rates(rates: DataFrame, anchors: DataFrame, item: str = "item", condition: str = "condition", rate: str = "rate") -> DataFrame:
    """Mean rate of the anchors, in all (null condition) and by condition: what a measurement errs by itself."""
    return rates.join(anchors.select(item).distinct(), item, "left_semi").rollup(condition).agg(F.avg(rate).alias("mean"), F.count("*").alias("n"))


def documents_of(rows: DataFrame, item: str, document: str) -> DataFrame:
    """In how many documents each item occurs."""
    return rows.groupBy(item).agg(F.count_distinct(document).alias("documents"))


def speaker_profiles(clips: DataFrame, speaker: str, key: str, seconds: str, most_clips: int, most_speakers: int) -> DataFrame:
    """The first clips of each of the first speakers: their number and seconds."""
    first = place_within(clips, [speaker], [key], "_n").where(F.col("_n") <= most_clips)
    found = first.groupBy(speaker).agg(F.count("*").alias("clips"), F.sum(F.col(seconds).cast("decimal(28,4)")).cast("double").alias("seconds"))
    return found.orderBy(speaker).limit(most_speakers)


def speakers_across(clips: DataFrame, speaker: str, split: str, text: str) -> DataFrame:
    """For each speaker the clips in each split, the splits, and the number of different texts."""
    counts = clips.groupBy(speaker, split).agg(F.count("*").alias("n"))
    splits = counts.groupBy(speaker).agg(F.array_sort(F.collect_list(F.struct(F.col(split).alias("split"), "n"))).alias("splits"), F.sum("n").alias("clips"))
    return splits.join(clips.groupBy(speaker).agg(F.count_distinct(T.dedup_key(text)).alias("texts")), speaker)


# --- dictionaries


def without_orphans(entries: DataFrame, active: DataFrame, typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries without orphans, and the orphans: neither active nor typed, not reviewed, by lookup key."""
    from corpusforge.operators.dictionary import keyed

    known = active.select(T.lookup_key("spelling").alias("key")).unionByName(typed.select(T.lookup_key("spelling").alias("key"))).distinct()
    marked = keyed(entries).join(known.withColumn("_known", F.lit(True)), "key", "left")
    orphan = F.col("_known").isNull() & ~F.coalesce(F.col("reviewed"), F.lit(False))
    drop = lambda d: d.drop("key", "_known")
    return drop(marked.where(~orphan)), drop(marked.where(orphan))


# --- phones and tokens


def fragmentation(tokens: Column | str, x: Column | str) -> Column:
    """Tokens a character, blanks out: how far a tokenizer breaks a word up."""
    return F.size(T.col(tokens)) / F.nullif(F.length(F.regexp_replace(T.col(x), r"\s", "")), F.lit(0))


def letters_extra(written: Column | str, heard: Column | str, letter: str) -> Column:
    """How many of a letter are written that aren't heard."""
    count = lambda c: F.length(T.col(c)) - F.length(F.replace(T.col(c), F.lit(letter), F.lit("")))
    return F.greatest(count(written) - count(heard), F.lit(0))


def nuclei(x: Column | str) -> Column:
    """The runs of vowels of a word, in order."""
    return F.regexp_extract_all(F.lower(T.col(x)), F.lit(f"([{VOWELS}]+)"), F.lit(1))


def stressed_place(x: Column | str) -> Column:
    """Which nucleus bears the stress (from 0), null without any: a marked one, else the last but one before a vowel, a vowel and s, en or in, else the last."""
    word, each = F.lower(T.col(x)), nuclei(x)
    marked = F.array_position(F.transform(each, lambda n: n.rlike(f"[{STRESSED}]")), True) - 1
    open_end = word.rlike(f"(?:[{VOWELS}]|[{VOWELS}]s|en|in)$")
    return F.when(F.size(each) == 0, None).when(marked >= 0, marked).otherwise(F.greatest(F.size(each) - F.when(open_end, 2).otherwise(1), F.lit(0)).cast("long"))


# --- training


def known_speakers(spark: SparkSession, path: str) -> DataFrame:
    """Rows (id, source, embedding) of a bank's manifest; none where there is no manifest, rows without an embedding left out."""
    from corpusforge.sources.readers import read_jsonl

    return read_jsonl(spark, path, "id string, source string, embedding array<double>").where("id is not null and size(embedding) > 0")


def fit_labels(rows: DataFrame, labels: str, most: int = 200) -> DataFrame:
    """Rows whose label is shorter than so many tokens."""
    return rows.where(F.size(labels) < most)


def padded_labels(rows: DataFrame, batch: str, labels: str, start: int | None = None, mask: int = -100) -> DataFrame:
    """Labels of a batch at one length, filled up with the mask; a start token that all labels of the batch begin with is left out."""
    sized = rows.groupBy(batch).agg(F.max(F.size(labels)).alias("_n"), F.min(F.coalesce(F.get(labels, F.lit(0)) == F.lit(start), F.lit(False))).alias("_cut"))
    joined = rows.join(sized, batch)
    filled = F.concat(labels, F.array_repeat(F.lit(mask), F.col("_n") - F.size(labels)))
    return joined.withColumn(labels, F.when(F.col("_cut"), F.slice(filled, F.lit(2), F.greatest(F.size(filled) - 1, F.lit(0)))).otherwise(filled)).drop("_n", "_cut")


def prompt(template: str, **fields: Column | str) -> Column:
    """A prompt column from a template with {names}; a null field is empty."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(T.col(value).cast("string"), F.lit("")))
    return out


def first_that_works(candidates: list[str], attempt: Callable[[str], object]) -> str:
    """The first candidate (a device, a file, a model) that an attempt doesn't fail with."""
    failures = []
    for c in candidates:
        try:
            attempt(c)
        except Exception as e:  # noqa: BLE001
            failures.append(f"{c}: {e}")
        else:
            return c
    raise RuntimeError("; ".join(failures) or "no candidates")


def iso_date(x: Column | str) -> Column:
    """A date column of ISO dates or timestamps; null for anything else."""
    return F.try_to_timestamp(F.substring(T.col(x), 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def stage_paths(root: str, stage: str, language: str) -> dict[str, str]:
    """The folders of a stage: input, output, rejects, meta and the norms of its language."""
    base = f"{root.rstrip('/')}/{language}/{stage}"
    return {name: f"{base}/{name}" for name in ("input", "output", "rejects", "meta")} | {"norms": f"{root.rstrip('/')}/{language}/norms.json"}


@contextmanager
def single_writer(spark: SparkSession, path: str) -> Iterator[None]:
    """Refuses where another process writes to path: a lock file beside it, made in one step, deleted at the end."""
    lock = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.lock")
    files = lock.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.createNewFile(lock):
        raise RuntimeError(f"another process writes to {path}")
    try:
        yield
    finally:
        files.delete(lock, False)


def accept_until_full(candidates: DataFrame, accepted: DataFrame, quota: int, most_similar: float = 0.75, batch: int = 256) -> DataFrame:
    """Voices for a bank, one after the other: the best by score that is like none accepted before, until the quota is met.

    candidates has (id, score, embedding), accepted (id, embedding). The order is what defines the result, so it runs
    on the driver over batches of the best candidates; no more are read than it takes, and the bank is a study's size.
    """
    import numpy as np

    unit = lambda v: np.asarray(v, float) / max(float(np.linalg.norm(v)), 1e-12)
    bank = [unit(r["embedding"]) for r in accepted.select("embedding").collect()]
    chosen: list[tuple] = []
    ranked = candidates.orderBy(F.desc("score"), "id").select("id", "score", "embedding")
    at = 0
    while len(chosen) < quota:
        part = ranked.offset(at).limit(batch).collect()
        for r in part:
            v = unit(r["embedding"])
            if len(chosen) < quota and all(float(v @ b) < most_similar for b in bank):
                bank.append(v)
                chosen.append((r["id"], r["score"]))
        at += batch
        if len(part) < batch:
            break
    return candidates.sparkSession.createDataFrame(chosen, candidates.select("id", "score").schema)
