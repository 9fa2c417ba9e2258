"""Near-duplicates at a similarity of shingles, against all pairs compared by their shingles."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge import session
from corpusforge.llm import components, simhash, wide_simhash
from corpusforge.session import table


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def jaccard_groups(rows, percent=80):
    """The smallest id of each row's group, by all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent, by_shingle = list(range(len(rows))), defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        near = {j for x in s for j in by_shingle[x]} if s else {j for j in range(k) if not sets[j]}
        for j in near:
            if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                parent[find(k)] = find(j)
        for x in s:
            by_shingle[x].append(k)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    return [min((i for i in least[find(k)] if i is not None), default=None) for k in range(len(rows))]


def copies(groups, most_edits, seed=7, length=300):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(2000)]
    rows = []
    for g, n in enumerate(groups):
        base = [rng.choice(words) for _ in range(length)]
        for k in range(n):
            t = list(base)
            for _ in range(rng.randrange(most_edits + 1) if k else 0):
                t[rng.randrange(length)] = rng.choice(words)
            rows.append((g * 10_000 + k, " ".join(t)))
    rng.shuffle(rows)
    return rows


def test_near_copies_against_all_pairs(spark):
    """Every group found is one of the exact groups or a part of it, and nine in ten near copies are found."""
    rows = copies([2] * 120, 6)
    exact = jaccard_groups(rows)
    got = {r["doc_id"]: r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect()}
    linked = [(i, c) for (i, _), c in zip(rows, exact, strict=True) if i != c]
    assert len(linked) > 90 and all(got[i] in (i, c) for (i, _), c in zip(rows, exact, strict=True))
    assert sum(got[i] == c for i, c in linked) >= 0.9 * len(linked)


@pytest.mark.parametrize("block", [40_000, 60])
def test_large_group(spark, monkeypatch, block):
    """A group of hundreds of near copies, its anchors compared at once or in pairs of blocks."""
    monkeypatch.setattr(wide_simhash, "BLOCK", block)
    rows = copies([500, 40], 3, seed=8)
    prints = wide_simhash.with_fingerprints(frame(spark, rows)).withColumn("root", F.col("node"))
    roots = {r[0]: r[1] for r in components.connected_components(wide_simhash.links(prints, block=block)).collect()}
    by_node = {r["doc_id"]: roots.get(r["node"], r["node"]) for r in prints.collect()}
    assert len({by_node[i] for i, _ in rows if i < 10_000}) == 1 == len({by_node[i] for i, _ in rows if i >= 10_000})
    got = {r["doc_id"]: r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == jaccard_groups(rows)


def test_dissimilar_texts_stay_apart(spark):
    """Texts that share half of their words in one passage are no copies."""
    rng = random.Random(9)
    draw = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passage = draw(150)
    rows = [(i, f"{draw(75)} {passage} {draw(75)}") for i in range(60)]
    assert all(r["doc_id"] == r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect())


def test_documents_of_the_tables(spark, tables):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, tables, "documents").collect()]
    got = {r["doc_id"]: r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == jaccard_groups(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (None, "one two three"), (7, "same word " * 40_000), (7, "same word " * 40_000), (None, "else")]
    clash = [(*r, "x", 5, 6) for r in rows]
    df = frame(spark, clash, "doc_id long, text string, node string, d int, tile int")
    got = sorted(((r["doc_id"], r["component_id"]) for r in wide_simhash.near_components(df).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (None, 6), (7, 7), (7, 7), (None, None)], key=repr)
    kept = wide_simhash.near_dedup(df)
    assert kept.columns == df.columns and sorted((r[0] for r in kept.collect()), key=repr) == sorted([1, 4, 6, 7, None, None], key=repr)
    assert wide_simhash.near_components(frame(spark, [])).count() == 0


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choice("alpha beta gamma delta epsilon".split()) for _ in range(500)).encode()
    whole = wide_simhash.Sketcher()(text)
    monkeypatch.setattr(simhash, "PIECE", 40)
    assert (wide_simhash.Sketcher()(text) == whole).all()
    assert len(wide_simhash.Sketcher().shingles(text)) == len(shingles(text.decode()))


def test_anchor_is_the_nearest():
    """Anchors within a view are those of perfect codes: equal for words within each code's radius of a codeword."""
    find, rng = wide_simhash.Anchors(), np.random.default_rng(3)
    prints = rng.integers(0, 2**63, (200, wide_simhash.LANES), dtype=np.uint64)
    keys = find(prints)
    assert keys.shape == (200, find.n_views) and (keys >> 20 == np.arange(find.n_views)).all()
    assert sorted(np.bincount(find.hamming, minlength=16).tolist()) == [8] * 16


def test_no_link_is_left_out(spark):
    """Pairs at the threshold, whose fingerprints often differ in too many bits: every group is the exact one."""
    rows = copies([2] * 200 + [3] * 40, 8, seed=11)
    exact = jaccard_groups(rows)
    got = {r["doc_id"]: r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect()}
    assert sum(i != c for (i, _), c in zip(rows, exact, strict=True)) > 150
    assert [got[i] for i, _ in rows] == exact


def test_equal_fingerprints_of_different_texts(spark):
    """A word repeated more often than all else makes fingerprints equal; links are told by the shingles all the same."""
    rows = [(i, "same " * 1000 + t) for i, t in copies([1] * 20 + [2] * 20, 4, seed=12)]
    prints = wide_simhash.with_fingerprints(frame(spark, rows))
    assert prints.select("node").distinct().count() == 1
    got = {r["doc_id"]: r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == jaccard_groups(rows)


@pytest.mark.parametrize(("block", "sample"), [(40_000, 20_000), (60, 20)])
def test_links_beside_a_frequent_passage(spark, monkeypatch, block, sample):
    """Many texts with one passage, some of them made of it but for a few words: in one block or in pairs of blocks, sampled in whole or not."""
    monkeypatch.setattr(wide_simhash, "BLOCK", block)
    monkeypatch.setattr(wide_simhash, "SAMPLE", sample)
    passage = copies([1], 0, seed=13)[0][1]
    rows = [(i, f"{t} {passage}") for i, t in copies([1] * 100 + [2] * 30, 14, seed=14, length=120)]
    rows += [(1_000_000 + i, f"{passage} {t}") for i, t in copies([1] * 150, 0, seed=15, length=45)]
    got = {r["doc_id"]: r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == jaccard_groups(rows)


def test_rounds_and_shuffle_files(spark, monkeypatch):
    """Views, texts and pairs taken in many rounds give the same groups, and no intermediate table leaves its shuffle files behind."""
    for name, few in (("VIEWS_AT_ONCE", 50), ("MAX_BROADCAST", 90), ("PAIRS_AT_ONCE", 70)):
        monkeypatch.setattr(wide_simhash, name, few)
    rows = copies([2] * 100, 6, seed=16)
    got = {r["doc_id"]: r["component_id"] for r in wide_simhash.near_components(frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == jaccard_groups(rows)
    files = lambda: sum(f.getName().endswith(".data") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()))
    before = files()
    session.materialize(spark.range(1000).repartition(7, "id"), "many")
    assert files() <= before and spark.conf.get(session.CLEANUP) == "false"
