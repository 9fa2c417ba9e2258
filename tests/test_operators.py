from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import dedup, dictionary, lexicon, ordering, planner, records, reports
from corpusforge.sources import readers, sinks
from corpusforge.streaming import resume


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_priority_and_ties(spark):
    rows = frame(spark, [(1, "b", "X."), (2, "a", "x"), (3, "zz", "x"), (4, "a", "y"), (5, "a", "y")], "id int, source string, text string")
    placed = dedup.by_priority(rows, dedup.T.dedup_key("text"), dedup.priority("source", ["a", "b"]), ["id"])
    assert {r["id"] for r in dedup.winners(placed).collect()} == {2, 4}
    assert {(r["id"], r["reason"]) for r in dedup.losers(placed).collect()} == {(i, "duplicada (es queda la de a)") for i in (1, 3, 5)}


def test_rounds_are_even(spark):
    rows = ordering.global_place(spark.range(103), ["id"])
    assert sorted(r[0] for r in rows.select("place").collect()) == list(range(103))
    items = frame(spark, [(c,) for c in "abcde"], "item string")
    dealt = ordering.round_robin(rows, "place", items, "item").collect()
    counts = Counter(r["item"] for r in dealt)
    assert len(dealt) == 103 and max(counts.values()) - min(counts.values()) <= 1
    with pytest.raises(ValueError):
        ordering.round_robin(rows, "place", items.where("false"), "item")


def test_packs(spark):
    clips = [("s", k, 10.0, f"t{k}") for k in range(5)] + [("t", 0, 27.0, "x"), ("t", 1, 27.0, "y"), ("u", 0, 1.0, "only")]
    got = ordering.pack_sessions(frame(spark, clips, "who string, k int, d double, t string"), "who", ["k"], "d", "k", "t").collect()
    assert sorted((r["who"], r["pack"], r["clips"], r["text"]) for r in got) == [("s", 0, [0, 1], "t0 t1"), ("s", 1, [2, 3], "t2 t3")]


def test_greedy_cover_sees_late_rows(spark):
    """A category that occurs only after many others is shown too."""
    rows = spark.range(12_001).selectExpr("id as k", "if(id = 12000, array('z'), array('a')) as c")
    assert ordering.greedy_cover(rows, "k", "c", 3)["k"].tolist() == [0, 12000, 1]


def test_orders_and_empty_tables(spark):
    empty = frame(spark, [], "g string, k int, v double")
    assert ordering.budget_cut(empty, "v", ["g"], ["k"], 3).count() == ordering.runs(empty, ["g"], ["k"], "v", "k").count() == reports.upper_median(empty, ["g"], "v").count() == 0
    rows = frame(spark, [("a", k, float(k)) for k in range(10)], "g string, k int, v double")
    assert [r["median"] for r in reports.upper_median(rows, ["g"], "v").collect()] == [5.0] and [r["p95"] for r in reports.p95(rows, ["g"], "v").collect()] == [9.0] and [r["p90"] for r in reports.p90(rows, ["g"], "v").collect()] == [8.0]
    assert [r["k"] for r in ordering.budget_cut(rows, "v", ["g"], ["k"], 6).orderBy("k").collect()] == [0, 1, 2, 3]
    assert ordering.balanced_queue(frame(spark, [("f", 1, 2.0), ("m", 2, 1.0), ("unknown", 3, 9.0)], "g string, k int, v double"), "g", "v", "k").orderBy("queue").collect()[-1]["g"] == "unknown"
    assert ordering.greedy_cover(frame(spark, [(1, ["a"]), (2, ["a", "b"]), (3, ["c"])], "k int, c array<string>"), "k", "c", 3)["k"].tolist() == [2, 3, 1]


def test_splits(spark):
    rows = frame(spark, [(f"f-{k:07d}", "same text" if k % 2 else f"text {k}") for k in range(2000)], "id string, text string")
    got = records.split_without_leaks(rows, "id", "text", 50)
    counts = Counter(r["split"] for r in got.collect())
    assert 60 < counts["dev"] < 140 and counts["exclos"] > 900 and got.where("split = 'train' and text = 'same text'").count() == 0
    assert records.split_without_leaks(rows.where("false")).count() == 0


def test_fragments_and_corrections(spark):
    rows = frame(spark, [("a", "x|y"), ("b", "z")], "id string, text string")
    assert sorted(tuple(r) for r in records.fragments(rows, F.split("text", r"\|")).collect()) == [("a-1", "x"), ("a-2", "y"), ("b", "z")]
    fixes = frame(spark, [("a", "new words", False), ("b", None, True)], "id string, new_text string, remove boolean")
    assert [(r["id"], r["text"], r["n_words"]) for r in records.correct(rows, fixes).collect()] == [("a", "new words", 2)]
    assert spark.range(1).select(records.folder(F.lit("bsc-0004001-2"))).first()[0] == "bsc_004000-007999"


def test_containment(spark):
    rows = frame(spark, [(1, "A b, c d e f g"), (2, "b c"), (3, None), (4, "")], "id int, text string")
    items = frame(spark, [(10, "c d e f g"), (11, "B C."), (12, ""), (13, "b")], "item int, text string")
    assert sorted((r["id"], r["item_id"]) for r in dedup.containing(rows, items, "text", "item", "text").collect()) == [(1, 10), (1, 11), (1, 13), (2, 11), (2, 13)]


def test_dictionaries(spark):
    entries = frame(spark, [("Vielha", "bièlha", True, 1), ("Vièlha", "x", False, 2), ("Arties", "arties", False, 3)], "spelling string, value string, reviewed boolean, pos int")
    first = {r["spelling"]: r["conflict"] for r in dictionary.index(entries).collect()}
    assert first == {"Vielha": True, "Arties": False}
    merged, counts = dictionary.merge(entries.drop("pos").where("spelling <> 'Vièlha'"), frame(spark, [("vielha", "z", False), ("arties", "art", False), ("Bossòst", "b", False)], "spelling string, value string, reviewed boolean"))
    assert {(r["spelling"], r["value"]) for r in merged.collect()} == {("Vielha", "bièlha"), ("Arties", "art"), ("Bossòst", "b")}
    assert {r["outcome"]: r["n"] for r in counts.collect()} == {"protected": 1, "updated": 1, "new": 1}
    assert dictionary.delete(entries, frame(spark, [("VIELHA",)], "spelling string")).count() == 1


def test_plan(spark):
    rows = frame(spark, [(f"i{k}", "news" if k % 3 else "song", 2.0) for k in range(60)], "id string, font string, seconds double")
    voices = frame(spark, [(v,) for v in "abcd"], "id string")
    rooms = frame(spark, [("hall", 1.0, ["song"]), ("street", 0.3, ["new"]), ("studio", 0.3, ["new"])], "id string, weight double, styles array<string>")
    got = planner.plan(rows, voices, rooms).collect()
    assert sorted(r["plan_pos"] for r in got) == list(range(60)) and set(Counter(r["voice"] for r in got).values()) == {15}
    assert {r["environment"] for r in got if r["font"] == "song"} == {"hall"} and all(0.94 <= r["speed"] <= 1.06 for r in got)
    streets = Counter(r["environment"] for r in got if r["font"] == "news")
    assert abs(streets["street"] - streets["studio"]) <= 3
    assert planner.quotas(10, ["a", "b", "c"]) == {"a": 3, "b": 3, "c": 4}


def test_sources_and_sinks(spark, tmp_path):
    base = str(tmp_path)
    rows = frame(spark, [("o", 1, "x"), ("p", 2, "y")], "origen string, n int, text string")
    assert sinks.write_jsonl(rows, f"{base}/j") == 2
    assert readers.read_jsonl(spark, f"{base}/j", "n int, text string, origen string").count() == 2 and readers.read_jsonl(spark, f"{base}/none", "n int").count() == 0
    sinks.write_rejects(frame(spark, [(1, 1), (2, 3)], "id int, step int"), f"{base}/r")
    sinks.write_rejects(frame(spark, [(9, 3)], "id int, step int"), f"{base}/r")
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/r").collect()) == [1, 9]
    sinks.merge_into(frame(spark, [(1, "a"), (2, "b")], "k int, v string"), f"{base}/m", "k")
    assert sorted(map(tuple, sinks.merge_into(frame(spark, [(2, "c"), (3, "d")], "k int, v string"), f"{base}/m", "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sinks.read_merged(spark, f"{base}/m").count() == 3
    (tmp_path / "t.tsv").write_text("a\tb\n1\t\"q\nx\ty\n")
    assert sorted(map(tuple, readers.read_tsv(spark, f"{base}/t.tsv", ["b", "a"], "a string, b string").collect())) == [('"q', "1"), ("y", "x")]
    (tmp_path / "d.json").write_text('{"_meta": {"n": 1}, "A": "b", "C": {"fonetica": "d", "revisat": true}}')
    assert sorted(map(tuple, readers.read_dictionary(spark, f"{base}/d.json").collect())) == [("A", "b", False), ("C", "d", True)]
    meta = sinks.commit_source(frame(spark, [("abc", 2.0)], "text string, seconds double"), frame(spark, [("d", 1)], "text string, step int"), f"{base}/s").first()
    assert (meta["accepted"], meta["rejected"], meta["chars"]) == (1, 1, 3)


def test_formats(spark):
    value = lambda f, v: spark.createDataFrame([(v,)], "v string").select(f("v")).first()[0]
    assert value(readers.mixed_text, "plain") == "plain" and value(readers.mixed_text, '{"text": "one"}') == "one" and value(readers.mixed_text, '[{"text": "a"}, {"x": 1}, {"text": "b"}]') == "a b"
    assert value(readers.entity_names, '["A", "B", "A"]') == ["A", "B"] and value(readers.entity_names, '[{"entrada": "A"}, {"entitat": "B", "grafia_correcta": "C"}]') == ["A", "C"]
    files = spark.createDataFrame([(p,) for p in ("d/a.json", "d/a.wav", "e/b.json", "e/output.wav", "f/c.json")], "path string")
    assert sorted(map(tuple, readers.pair_files(files).collect())) == [("d/a.json", "d/a.wav"), ("e/b.json", "e/output.wav")]


def test_resumed_stream(spark, tmp_path):
    base = str(tmp_path)
    schema, seen = "id int, v string", []

    def work(rows):
        seen.append(rows.count())
        return rows.withColumn("status", F.when(F.col("v") == "bad", "error").otherwise("ok"))

    go = lambda: resume.process_new(spark, f"{base}/in", schema, f"{base}/out", f"{base}/cp", work, "id", F.col("status") == "ok")
    frame(spark, [(1, "a"), (2, "bad")], schema).write.parquet(f"{base}/in/1")
    spark.read.parquet(f"{base}/in/1").write.mode("append").parquet(f"{base}/in")
    go()
    frame(spark, [(1, "a"), (2, "good"), (3, "c")], schema).write.mode("append").parquet(f"{base}/in")
    go()
    out = spark.read.parquet(f"{base}/out").where("status = 'ok'")
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3]


def test_tar_shards(spark, tmp_path):
    import io
    import tarfile

    for shard in "ab":
        with tarfile.open(tmp_path / f"{shard}.tar", "w") as tar:
            for name in ("x.wav", "y.wav"):
                info = tarfile.TarInfo(f"{shard}/{name}")
                info.size = 3
                tar.addfile(info, io.BytesIO(b"abc"))
    assert readers.read_tar(spark, f"{tmp_path}/*.tar").count() == 4
    wanted = spark.createDataFrame([("a/x.wav",), ("a/x.wav",), ("none",)], "name string")
    assert [(r["name"], bytes(r["data"])) for r in readers.read_tar(spark, f"{tmp_path}/*.tar", wanted).collect()] == [("a/x.wav", b"abc")]


@pytest.mark.parametrize("most", [500_000, 2, 1])
def test_unknown_share_shuffles_no_words(spark, monkeypatch, most):
    """A lexicon within the bound is broadcast and only texts' counts are shuffled; a larger one gives the same."""
    monkeypatch.setattr(lexicon, "MAX_BROADCAST", most)
    rows = spark.createDataFrame([(1, "a b A, x"), (1, "a"), (2, ""), (3, None), (None, "b y Y")], "k int, t string")
    known = spark.createDataFrame([("a", 9), ("b", 3), ("c", 3)], "word string, n long")
    out = lexicon.unknown_share(rows, "k", "t", known)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, 5, 1, 0.2), (None, 3, 2, 2 / 3)], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert most <= 2 or ("hashpartitioning(word" not in plan and plan.count("hashpartitioning(k") == 1 and ", word" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x))
