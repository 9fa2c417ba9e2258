"""Edges of the verification, the small steps and the prefix sums: nulls, empty tables, ties, clashing names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import dedup, prefix, reports, study, verification


def test_running_sums_of_a_large_group(spark):
    """One group holds most rows and lies in many ranges; names of helpers clash with columns."""
    rng = random.Random(3)
    rows = [("big" if k % 4 else None if k % 8 else f"g{k % 3}", k, rng.randrange(100)) for k in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "_o0 string, _part int, __value2 int").repartition(5)
    got = sorted(map(tuple, prefix.running(df, "__value2", ["_o0"], [F.col("_part")], "upto").collect()), key=repr)
    want, sums = [], {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        sums[g] = sums.get(g, 0) + v
        want.append((g, k, v, sums[g]))
    assert got == sorted(want, key=repr)
    placed = {r["_part"]: r["n"] for r in prefix.place_within(df.where("_o0 = 'big'"), ["_o0"], [F.col("_part")], "n").collect()}
    assert [placed[k] for k in sorted(placed)] == list(range(1, len(placed) + 1))
    assert prefix.running(df.where("false"), "__value2", ["_o0"], [F.col("_part")]).count() == 0


def test_winners_of_null_keys(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "k", "b"), (4, "k", "a")], "id int, k string, source string")
    rank = dedup.priority("source", ["a", "b"])
    assert sorted(r["id"] for r in dedup.keep_best(rows, "k", rank, ["id"]).collect()) == [1, 4]
    placed = {r["id"]: (r["place"], r["winner"]) for r in dedup.by_priority(rows, "k", rank, ["id"]).collect()}
    assert placed == {1: (1, "a"), 2: (2, "a"), 3: (2, "a"), 4: (1, "a")}


def test_verification_edges(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "Era casa ei polida."), (4, "era casa 3 --")], "id int, text string")
    got = {r["check"]: (r["against"], r["ok"]) for r in verification.verify(rows, verification.text_checks(), {"digits": 1}).collect()}
    assert got["empty text"] == (2, False) and got["digits"] == (1, True) and got["small initial"] == (1, False) and got["percent sign"] == (0, True)
    assert all(r["ok"] for r in verification.verify(rows.where("false"), verification.text_checks()).collect())
    checks = {r["check"]: r["against"] for r in verification.verify_tables(rows.unionByName(rows.where("id = 3")), "id", "text").collect()}
    assert checks == {"ids unique": 1, "texts unique": 1}


def test_small_steps(spark):
    row = spark.createDataFrame([(" F ", None, 0, [9, 1], "casa")], "g string, n string, z int, labels array<int>, w string")
    one = lambda c: row.select(c.alias("x")).first()[0]
    assert one(study.canonical("g", {"f": "female"}, "unknown")) == "female" and one(study.canonical("n", {"f": "female"}, "unknown")) == "unknown"
    assert one(study.ratio(F.lit(1), "z")) is None and one(study.prompt("{a}-{b}", a="w", b="n")) == "casa-"
    assert one(study.iso_date(F.lit("nothing"))) is None and one(study.stressed_place(F.lit("bcd"))) is None and one(study.stressed_place(F.lit("camèl"))) == 1
    assert study.first_that_works(["a", "b"], lambda c: 1 / (c == "b")) == "b" and study.stage_paths("/x/", "s", "l")["norms"] == "/x/l/norms.json"
    with pytest.raises(RuntimeError):
        study.first_that_works([], print)
    with pytest.raises(ValueError):
        reports.markdown(spark.range(5).toDF("n"), "t", most=3)


def test_padded_labels(spark):
    rows = spark.createDataFrame([(1, [9, 1]), (1, [9]), (2, [9, 3]), (2, [4]), (3, [])], "b int, labels array<int>")
    got = sorted((r["b"], r["labels"]) for r in study.padded_labels(rows, "b", "labels", start=9).collect())
    assert got == [(1, [-100]), (1, [1]), (2, [4, -100]), (2, [9, 3]), (3, [])]
