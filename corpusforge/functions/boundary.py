"""Calls of external models: batches, retries, bisection and a cache, around any function of a list of texts.

The stubs stand in for models and give the same answer for the same text.
"""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import col

Call = Callable[[list[str]], list[str]]


def cache_key(model: str, prompt: Column | str) -> Column:
    """Twenty hex digits that stand for a model and a prompt."""
    return F.substring(F.sha2(F.concat(F.lit(model + "\n"), col(prompt)), 256), 1, 20)


def retried(call: Call, tries: int = 4, wait: float = 0.5) -> Call:
    """Waits twice as long after each failure, with some jitter fixed by the texts."""

    def run(texts: list[str]) -> list[str]:
        for k in range(tries):
            try:
                out = call(texts)
                if len(out) != len(texts):
                    raise ValueError(f"{len(out)} answers to {len(texts)} texts")
                return out
            except Exception:
                if k == tries - 1:
                    raise
                time.sleep(wait * 2**k * (1 + random.Random("".join(texts)).random() / 4))
        return []

    return run


def bisected(call: Call) -> Callable[[list[str]], list[tuple[str | None, str | None]]]:
    """(answer, error) for each text: a batch that fails is halved until the texts at fault stand alone."""

    def run(texts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            return [(a, None) for a in call(texts)]
        except Exception as e:
            if len(texts) == 1:
                return [(None, str(e)[:200])]
            half = len(texts) // 2
            return run(texts[:half]) + run(texts[half:])

    return run


def ask(rows: DataFrame, key: str, prompt: str, call: Call, batch: int = 20) -> DataFrame:
    """Rows (key, answer, error) from a model that takes so many prompts at a time."""
    one = bisected(call)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [x for at in range(0, len(f), batch) for x in one(f["prompt"].iloc[at : at + batch].tolist())]
            yield pd.DataFrame({"key": f["key"], "answer": [a for a, _ in out], "error": [e for _, e in out]})

    slim = rows.select(F.col(key).cast("string").alias("key"), F.col(prompt).alias("prompt"))
    return slim.mapInPandas(run, "key string, answer string, error string")


def without_failing(rows: DataFrame, answers: DataFrame, key: str, group: str) -> DataFrame:
    """rows of the groups (voices) none of whose prompts failed when it stood alone; answers are those of ask."""
    failed = answers.where("error is not null").select(F.col("key").alias("_k"))
    gone = rows.join(failed, F.col(key).cast("string") == F.col("_k"), "left_semi").select(group).distinct()
    return rows.join(gone, group, "left_anti")


def ask_cached(rows: DataFrame, prompt: str, model: str, call: Call, cache: DataFrame, batch: int = 20) -> DataFrame:
    """Rows (key, answer, error) for prompts that a cache (key, answer) doesn't have yet."""
    keyed = rows.select(cache_key(model, prompt).alias("key"), F.col(prompt).alias("prompt")).dropDuplicates(["key"])
    return ask(keyed.join(cache.select("key"), "key", "left_anti"), "key", "prompt", call, batch)


def classify(rows: DataFrame, key: str, prompt: str, call: Call, allowed: list[str]) -> tuple[DataFrame, DataFrame]:
    """Answers among the allowed values, and the keys for which there was none."""
    answers = ask(rows, key, prompt, call)
    good = answers.where(F.col("answer").isin(allowed)).select("key", "answer")
    return good, rows.select(F.col(key).cast("string").alias("key")).join(good.select("key"), "key", "left_anti")


def stub(values: list[str]) -> Call:
    """A model that chooses among values by a text's hash."""
    return lambda texts: [values[int(hashlib.sha256(t.encode()).hexdigest(), 16) % len(values)] for t in texts]


def stub_transcript(texts: list[str]) -> list[str]:
    """A recogniser that loses every seventh word."""
    return [" ".join(w for k, w in enumerate(t.split()) if (k + len(t)) % 7) for t in texts]


def stub_embedding(text: str, size: int = 64) -> list[float]:
    """A unit vector from a text's hash."""
    rng = random.Random(text)
    v = [rng.gauss(0, 1) for _ in range(size)]
    norm = sum(x * x for x in v) ** 0.5
    return [x / norm for x in v]
