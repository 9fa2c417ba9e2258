from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusforge.llm import components, line_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def brute_lines(rows):
    """Sequential line dedup: windows in order of (id, text), later occurrences covered."""
    seen, out = {}, {}
    for i, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = text.split("\n"), set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if any(c not in " \t\n\v\f\r" for x in w for c in x):
                if seen.setdefault(w, (i, text, k)) != (i, text, k):
                    gone |= {k, k + 1, k + 2}
        out[i, text] = "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text
    return sorted(((i, None if t is None else out[i, t]) for i, t in rows), key=repr)


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abcdef") * 3 for _ in range(rng.randrange(14)))) for i in range(60)]
    rows += [(5, rows[5][1]), (None, "x\ny\nz\nw"), (100, "x\ny\nz"), (101, None), (102, ""), (103, "\n\n\n\n"), (104, "\n\n\n\n"), (105, "q\n" * 5000), (106, "one line " * 20_000)]
    got = sorted(((r[0], r[1]) for r in line_dedup.dedup_lines(frame(spark, rows)).select("doc_id", "text").collect()), key=repr)
    assert got == brute_lines(rows)


def test_blank_lines_keep_their_places(spark):
    """Windows with blank lines at the start, middle and end are equal only if the blanks stand in the same places."""
    rng = random.Random(4)
    rows = [(1, "p\n\nlast\n\n"), (2, "A\n\n\nB"), (3, "\n\nA\n\n\n"), (4, "\nA\nB"), (5, "A\n\nB"), (6, "A\nB\n"), (7, "A\n \nB"), (8, "x\n\n\nonce\n\n\ny"), (9, "A\n\nB")]
    rows += [(100 + i, "\n".join(rng.choice(["", "", " ", "a", "b", f"u{i}"]) for _ in range(rng.randrange(3, 12)))) for i in range(40)]
    got = sorted(((r[0], r[1]) for r in line_dedup.dedup_lines(frame(spark, rows)).select("doc_id", "text").collect()), key=repr)
    assert got == brute_lines(rows)
    assert (1, "p\n\nlast\n\n") in got and (8, "x\n\n\nonce\n\n\ny") in got


def test_long_texts_in_linear_time(spark):
    """Two equal texts of many lines: twice the lines take about twice the time, not four times."""
    import time

    seconds = []
    for n in (2_000, 100_000, 200_000):  # the first warms up
        text = "\n".join(f"line {k}" for k in range(n))
        start = time.perf_counter()
        got = {r[0]: r[1] for r in line_dedup.dedup_lines(frame(spark, [(1, text), (2, text + "\nmore")])).select("doc_id", "text").collect()}
        seconds.append(time.perf_counter() - start)
        assert got == {1: text, 2: "more"}
    assert seconds[2] < 3 * seconds[1] + 2


def test_hashes_are_independent(spark):
    """Neither hash of a line is a function of the other: the second isn't the first one hashed on."""
    w = line_dedup.line_windows(frame(spark, [(1, "a\nb\nc")])).first()
    chained = spark.sql("select xxhash64(7, xxhash64('a', 7), xxhash64('b', 7), xxhash64('c', 7)) as x, xxhash64(xxhash64('a'), xxhash64('b'), xxhash64('c'), 7) as y").first()
    assert w["w2"] not in tuple(chained) and w["w1"] != w["w2"]


def test_line_dedup_columns_and_empty(spark):
    rows = [(1, "a\nb\nc", 1, 2, 3), (2, "a\nb\nc\nd", 4, 5, 6)]
    clash = frame(spark, rows, "doc_id long, text string, starts int, covered int, at int")
    got = {r["doc_id"]: (r["text"], r["starts"], r["covered"], r["at"]) for r in line_dedup.dedup_lines(clash).collect()}
    assert got == {1: ("a\nb\nc", 1, 2, 3), 2: ("d", 4, 5, 6)}
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def brute_components(rows, limit=3):
    prints = [(i, simhash_plain(t)) for i, t in rows]
    fps = sorted({f for _, f in prints})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(fps):
        for b in fps[k + 1 :]:
            if (a ^ b).bit_count() <= limit:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for i, f in prints:
        least[find(f)].append(i)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((i, f"{f:016x}", low[find(f)]) for i, f in prints), key=repr)


def simhash_plain(text):
    data = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    words = data.split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_pieces(monkeypatch):
    text = " ".join(random.Random(1).choice("alpha beta gamma delta Épsilon ZETA".split()) for _ in range(500))
    whole = simhash.fingerprint(text.encode())
    assert whole == simhash_plain(text)
    monkeypatch.setattr(simhash, "PIECE", 40)
    assert simhash.fingerprint(text.encode()) == whole
    assert simhash.fingerprint(b"One Two") == simhash_plain("one two")
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0


def near_copies(seed=5):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(6):
        base = [rng.choice(words) for _ in range(250)]
        for k in range(25 if g == 0 else 4):
            t = list(base)
            for _ in range(rng.randrange(5)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((g * 100 + k, " ".join(t)))
    rng.shuffle(rows)
    return [*rows, rows[0], (900, None), (901, ""), (902, "\t\n"), (903, "a b"), (904, "A B"), (None, rows[1][1]), (905, "same word " * 30_000)]


def test_simhash_against_brute_force(spark):
    rows = near_copies()
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(frame(spark, rows)).collect()), key=repr)
    assert got == brute_components(rows)
    assert simhash.simhash_components(frame(spark, [])).count() == 0


def test_simhash_passes_other_columns_by(spark):
    clash = frame(spark, [(1, "a b c", "x", 1, 2), (2, "a b c", "y", 3, 4)], "doc_id long, text string, fp string, root int, tile int")
    assert sorted(map(tuple, simhash.near_dedup(clash).collect())) == [(1, "a b c", "x", 1, 2)]


@pytest.mark.parametrize("block", [40_000, 30])
def test_dense_anchors_in_blocks(spark, block):
    """Many fingerprints close together, compared at once or in blocks, against all pairs."""
    rng = np.random.default_rng(2)
    base = np.uint64(0x123456789ABCDEF0)
    fps = {int(base)}
    while len(fps) < 400:
        x = int(rng.choice(list(fps)))
        for b in rng.integers(0, 64, rng.integers(1, 4)):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 2**63, 100)}
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    found = simhash.links(frame(spark, [(x,) for x in signed], "fp long"), 3, block)
    roots = {r[0]: r[1] for r in components.connected_components(found).collect()}
    groups = defaultdict(set)
    for x in signed:
        groups[roots.get(x, x)].add(x % 2**64)
    plain = brute_groups(sorted(fps))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain))


def brute_groups(fps):
    left, out = set(fps), []
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= 3}
            left -= near
            group |= near
            todo += near
        out.append(group)
    return out


def test_anchors_cover_three_bits():
    code, rng = simhash.Golay(), np.random.default_rng(4)
    x = rng.integers(0, 2**63, 500, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
    sent = []
    for z, homes_only in ((x, True), (y, False)):
        key, row, home = simhash.expand(z, code)
        by_row = defaultdict(set)
        for k, r, h in zip(key, row, home, strict=True):
            if h or not homes_only:
                by_row[int(r)].add(int(k))
        sent.append(by_row)
    assert all(sent[0][i] & sent[1][i] for i in range(len(x)))


def test_components_chain(spark):
    chain = frame(spark, [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    got = {r[0]: r[1] for r in components.connected_components(chain).collect()}
    assert {got[i] for i in range(1, 61)} == {0} and got[101] == 100 and 7 in got
    assert components.connected_components(frame(spark, [], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    rows = near_copies()
    kept = [r[0] for r in simhash.near_dedup(frame(spark, rows)).collect()]
    low = {c for i, _, c in brute_components(rows) if i is not None}
    assert sorted(x for x in kept if x is not None) == sorted(low) and None in kept
    assert F is not None


def test_repeated_ids_with_other_texts(spark):
    """Where an id is repeated, rows of different groups all stay, of one group one stays."""
    rows = [(5, "a b c"), (5, "p q r s"), (5, "a b c"), (7, "A b c"), (None, "a b c")]
    kept = sorted(map(tuple, simhash.near_dedup(frame(spark, rows)).collect()), key=repr)
    assert kept == sorted([(5, "a b c"), (5, "p q r s"), (None, "a b c")], key=repr)
