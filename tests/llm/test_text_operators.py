from __future__ import annotations

import itertools
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import decontamination, html_text, licenses, lm_scoring, quality_cnn, quality_rules
from corpusforge.session import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet " * 20_000


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# --- quality rules


def brute_counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    marked = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(marked)


TEXTS = ["", None, "a", "a b c a b c", "a b c d\n\na b c d\n \n", "é ü 漢字 # ** |", "x x x x x", "a\x0bb\x0cc\x1cd", LONG, "p q r s p q r", "\n\n\n"]


def test_base_counts_against_brute_force():
    rng = random.Random(1)
    for text in [*TEXTS, *(" ".join(rng.choice("ab cd\n # é".split(" ")) for _ in range(rng.randrange(60))) for _ in range(100))]:
        assert quality_rules.base_counts((text or "").encode())[:5] == brute_counts(text)


def brute_outliers(x):
    """The same estimate for one group, in numpy: bins of distance as the operator's."""
    p, floor = quality_rules.P, np.diag(np.square(quality_rules.FLOOR))
    at = lambda q: np.array([min(v for v in np.unique(c) if (c <= v).sum() >= len(c) * q) for c in x.T])
    mean, inverse = at(0.5), np.diag(1 / (np.square((at(0.75) - at(0.25)) / 1.349) + np.square(quality_rules.FLOOR)))
    dist = lambda: np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)
    shrunk = quality_rules.CORE / quality_rules.gamma_share((p + 2) / 2, quality_rules.chi2_quantile(quality_rules.CORE, p) / 2)
    for _ in range(quality_rules.STEPS):
        bins = np.floor(np.log1p(dist()) * 100)
        need = int(np.ceil(len(x) * quality_rules.CORE))
        core = x[bins <= np.sort(bins)[need - 1]]
        mean, inverse = core.mean(axis=0), np.linalg.inv(np.cov(core.T, bias=True) * shrunk + floor)
    inner = quality_rules.chi2_quantile(0.975, p)
    core = x[dist() <= inner]
    wide = 0.975 / quality_rules.gamma_share((p + 2) / 2, inner / 2)
    mean, inverse = core.mean(axis=0), np.linalg.inv(np.cov(core.T, bias=True) * wide + floor)
    return dist()


def test_outliers_against_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(60, 90))) + ".", "xx", "s") for i in range(150)]
    rows += [(i, " ".join(word() + "$$%" for _ in range(70)), "xx", "s") for i in range(150, 165)]
    rows += [(200, None, None, None), (201, "", "xx", "s"), (None, "few words", "xx", "t"), (203, rows[0][1], "xx", "s"), (203, rows[0][1], "xx", "s"), (204, rows[1][1], None, None)]
    df = frame(spark, rows, "doc_id long, text string, lang string, source string")
    got = quality_rules.quality(df).collect()
    assert len(got) == len(rows) and quality_rules.quality(df).columns[:8] == "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    assert all(not r["kept"] for r in got if r["doc_id"] in (*range(150, 165), 200, 201, None)) and all(r["kept"] for r in got if r["doc_id"] in range(150))
    stats = [r for r in quality_rules.statistics(df).collect() if r["source"] == "s" and r["n_words"] >= 50]
    plain = brute_outliers(np.array([[r[f"s{i}"] / quality_rules.GRID for i in range(quality_rules.P)] for r in stats]))
    by_id = {r["doc_id"]: r["distance"] for r in quality_rules.quality(df, shrink=0).collect()}
    assert np.allclose([by_id[r["doc_id"]] for r in stats], plain, rtol=1e-6)


def test_moderate_outliers_of_an_even_group(spark):
    """A group's own scatter decides: 4 % symbols or long words are rejected where clean texts have none."""
    rng = random.Random(5)
    draw = lambda a, b: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(a, b))) for _ in range(80))
    rows = [(i, draw(3, 8) + ".", "xx", "s") for i in range(300)]
    symbols = draw(3, 8)
    rows += [(300, symbols + " " + "$" * (len(symbols.replace(" ", "")) * 4 // 96), "xx", "s"), (301, draw(5, 9) + ".", "xx", "s")]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality(frame(spark, rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[300] and not kept[301]
    assert sum(kept[i] for i in range(300)) >= 295


def test_small_groups_are_judged_by_their_language(spark):
    """Junk of a source with few texts is measured against the language's texts, or all texts, not against itself."""
    rng = random.Random(6)
    draw = lambda end="": " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) + end for _ in range(80)) + "."
    rows = [(i, draw(), "xx", "large") for i in range(200)]
    rows += [(200 + i, draw("$$%"), "xx", "small") for i in range(5)] + [(210, draw("$$%"), "yy", "alone"), (211, draw(), "xx", "small"), (212, draw(), "yy", None)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality(frame(spark, rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept[i] for i in (*range(200, 205), 210)) and kept[211] and kept[212]
    assert sum(kept[i] for i in range(200)) >= 195


def word_rows(rng, n, end="", first=0, lang="xx", source="s"):
    draw = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) + end for _ in range(80)) + "."
    return [(first + k, draw(), lang, source) for k in range(n)]


QUALITY = "doc_id long, text string, lang string, source string"


def test_estimates_change_smoothly_with_the_size(spark):
    """One text more or less in a group, at any size, hardly moves the distance of another."""
    rng = random.Random(7)
    large, own = word_rows(rng, 300, source="large"), word_rows(rng, 400, end="-", first=1000, source="own")
    probe = (5000, word_rows(rng, 1, end="-")[0][1], "xx", "own")
    got = {}
    for n in (0, 4, 5, 30, 31, 58, 59, 60, 61, 399, 400):
        result = quality_rules.quality(frame(spark, [*large, *own[:n], probe], QUALITY)).where("doc_id = 5000").first()
        got[n] = result["distance"], result["kept"]
    assert not got[0][1] and got[400][1]
    for a, b in ((4, 5), (30, 31), (58, 59), (59, 60), (60, 61), (399, 400)):
        assert abs(got[a][0] - got[b][0]) < 0.25 * max(got[a][0], got[b][0]), (a, b, got)


def test_salted_groups_give_the_same(spark):
    rng = random.Random(8)
    df = frame(spark, word_rows(rng, 120) + word_rows(rng, 6, end="$$", first=500, source=None) + word_rows(rng, 9, first=600, lang=None), QUALITY)
    each = [sorted((r["doc_id"], r["kept"], round(r["distance"], 6)) for r in quality_rules.quality(df, max_groups=m).collect()) for m in (50_000, 1)]
    assert each[0] == each[1]


def test_against_the_exact_determinant(spark):
    """All subsets of a small group are tried: the least determinant's distances reject the same texts."""
    rng = random.Random(11)
    rows = word_rows(rng, 15) + word_rows(rng, 2, end="$$%", first=100)
    df = frame(spark, rows, QUALITY)
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality(df, shrink=0).collect()}
    stats = quality_rules.statistics(df).collect()
    x, floor = np.array([[r[f"s{i}"] / quality_rules.GRID for i in range(quality_rules.P)] for r in stats]), np.diag(np.square(quality_rules.FLOOR))
    size = int(np.ceil(len(x) * quality_rules.CORE))
    shrunk = quality_rules.CORE / quality_rules.gamma_share((quality_rules.P + 2) / 2, quality_rules.chi2_quantile(quality_rules.CORE, quality_rules.P) / 2)
    measure = lambda part: np.cov(x[list(part)].T, bias=True) * shrunk + floor
    best = min(itertools.combinations(range(len(x)), size), key=lambda part: np.linalg.det(measure(part)))
    d2 = np.einsum("ni,ij,nj->n", x - x[list(best)].mean(axis=0), np.linalg.inv(measure(best)), x - x[list(best)].mean(axis=0))
    assert {r["doc_id"]: bool(d <= quality_rules.chi2_quantile(1 - quality_rules.ALPHA, quality_rules.P)) for r, d in zip(stats, d2, strict=True)} == got
    assert not got[100] and not got[101]


def test_quality_edges(spark):
    schema = "doc_id long, text string, lang string, source string, gid int, bin int"
    assert quality_rules.quality(frame(spark, [], schema)).count() == 0
    assert [r["kept"] for r in quality_rules.quality(frame(spark, [(1, "alone", "x", "y", 1, 2)], schema)).collect()] == [False]
    assert abs(quality_rules.chi2_quantile(0.95, 3) - 7.8147) < 1e-3


# --- language models


def test_lm_scores_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("Red green blue red cyan".split() if i % 2 else "one two three four".split()) for _ in range(rng.randrange(1, 30)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "unseen words here"), (1, rows[1][1]), (53, LONG)]
    target = {1, 3, 5, 7, 999}
    ids = frame(spark, [(t,) for t in target] + [(None,)], "id long")
    got = {(r[0], r[1]): r for r in lm_scoring.score(frame(spark, rows), ids).collect()}
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) for _, text in rows]

    def model(texts):
        """Counts of words, of contexts (the start too) and of bigrams."""
        c = Counter()
        for w in texts:
            c.update(("w", x) for x in w)
            c.update(("c", x) for x in [None, *w[:-1]] if w)
            c.update(("p", x, y) for x, y in zip([None, *w[:-1]], w, strict=False))
        return c

    for k, (i, _) in enumerate(rows):
        w = tokens[k]
        if not w:
            assert got[i, 0]["score"] is None
            continue
        others = [(j, t) for n, ((j, _), t) in enumerate(zip(rows, tokens, strict=True)) if n != k]
        models = [model(t for j, t in others if j in target), model(t for _, t in others)]
        total = [sum(n for key, n in c.items() if key[0] == "w") for c in models]
        losses = []
        for c, s in zip(models, (1.0, total[0] / total[1]), strict=True):
            logs = []
            for a, b in zip([None, *w[:-1]], w, strict=True):
                single = (c["w", b] * s + lm_scoring.SMOOTH) / (total[0] + lm_scoring.SMOOTH * lm_scoring.VOCABULARY)
                logs.append(-np.log(lm_scoring.MIX * c["p", a, b] / c["c", a] + (1 - lm_scoring.MIX) * single if c["c", a] else single))
            losses.append(np.mean(logs))
        r = got[i, len(w)]
        assert np.allclose([r["target_loss"], r["background_loss"]], losses, rtol=1e-4)
    assert np.mean([r["score"] for r in got.values() if r["doc_id"] in (1, 3, 5)]) < np.mean([r["score"] for r in got.values() if r["doc_id"] in (0, 2, 4)])


def test_lm_tells_all_words_apart(spark):
    """More distinct words than 2^18: no unseen word or bigram takes the counts of another."""
    n = 20_000
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(n))) for k in range(35)]
    got = lm_scoring.score(frame(spark, rows), frame(spark, [(0,)], "id long")).collect()
    unseen = -np.log(lm_scoring.SMOOTH / (n + lm_scoring.SMOOTH * lm_scoring.VOCABULARY))
    others = [r for r in got if r["doc_id"]]
    for loss in ("target_loss", "background_loss"):  # only the start was met before, in other texts
        assert len(others) == 34 and np.allclose([r[loss] for r in others], unseen - np.log(1 - lm_scoring.MIX) / n, rtol=1e-9)


def test_lm_texts_are_not_judged_by_themselves(spark):
    """A target document scores as it would if it weren't one; one that occurs twice is known to the background."""
    rng = random.Random(13)
    draw = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(60))
    rows = [(i, draw()) for i in range(60)]
    twice = "once upon a rather different time there were many unusual words in here"
    rows += [(100, twice), (101, twice), (102, twice.replace("unusual", "uncommon")[::-1])]
    ids = lambda *x: frame(spark, [(k,) for k in x], "id long")
    scored = [{r["doc_id"]: r for r in lm_scoring.score(frame(spark, rows), ids(*x)).collect()} for x in (range(20), range(1, 20))]
    assert abs(scored[0][0]["target_loss"] - scored[1][0]["target_loss"]) < 1e-9
    assert scored[0][100]["score"] > scored[0][102]["score"] + 3


def test_lm_edges(spark):
    none = frame(spark, [], "id long")
    assert lm_scoring.score(frame(spark, []), none).count() == 0
    got = lm_scoring.score(frame(spark, [(1, "a b", 7)], "doc_id long, text string, slot int"), none).collect()
    assert got[0]["score"] == 0 and got[0]["n_tokens"] == 2


# --- the network


def test_chunks_cover_every_byte():
    for size in (0, 1, 255, 256, 257, 448, 449, 5000):
        data = bytes(i % 251 + 1 for i in range(size))
        parts = quality_cnn.chunk(data, range(quality_cnn.n_chunks(size)))
        seen = set()
        for k, row in enumerate(parts):
            for j, b in enumerate(row.tolist()):
                if k * quality_cnn.STEP + j < size:
                    assert b == data[k * quality_cnn.STEP + j]
                    seen.add(k * quality_cnn.STEP + j)
                else:
                    assert b == 0
        assert len(seen) == size


def plain_score(model, data):
    """The network written out for one text: every chunk, every window, every filter, one after the other."""
    p = {k: v.astype(float) for k, v in model.p.items()}
    hidden, at = [], 0
    while not hidden or at - quality_cnn.STEP + quality_cnn.CHUNK < len(data):
        piece = data[at : at + quality_cnn.CHUNK].ljust(quality_cnn.CHUNK, b"\0")
        answers = []
        for start in range(0, quality_cnn.CHUNK - quality_cnn.WIDTH + 1, quality_cnn.STRIDE):
            window = np.concatenate([p["embed"][b] for b in piece[start : start + quality_cnn.WIDTH]])
            answers.append([float(window @ p["conv"][:, f]) for f in range(quality_cnn.FILTERS)])
        pooled = [max(0.0, max(a[f] for a in answers) + p["conv_b"][f]) for f in range(quality_cnn.FILTERS)]
        hidden.append([max(0.0, sum(x * p["mid"][f, h] for f, x in enumerate(pooled)) + p["mid_b"][h]) for h in range(quality_cnn.HIDDEN)])
        at += quality_cnn.STEP
    feats = [sum(h[k] for h in hidden) / len(hidden) for k in range(quality_cnn.HIDDEN)] + [max(h[k] for h in hidden) for k in range(quality_cnn.HIDDEN)]
    return 1 / (1 + np.exp(-(sum(a * b for a, b in zip(feats, p["out"], strict=True)) + p["out_b"][0])))


def test_network_against_brute_force():
    model, rng = quality_cnn.ByteCNN(5), np.random.default_rng(2)
    texts = [b"", b"a", *(rng.integers(1, 256, n).astype(np.uint8).tobytes() for n in (255, 256, 257, 448, 449, 1500))]
    assert np.allclose(model.scores(texts), [plain_score(model, t) for t in texts], rtol=1e-4)


def test_network_gradients(monkeypatch):
    """Against differences of the loss, also where the chunks of a batch are many lots."""
    model = quality_cnn.ByteCNN(3)
    rng = np.random.default_rng(0)
    texts, y = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (400, 90, 900)], np.array([1, 0, 1], np.float32)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        s = np.array([plain_score(model, t) for t in texts])
        return float(np.mean(-np.log(np.where(y == 1, s, 1 - s))))

    g = model.gradients(texts, y)
    monkeypatch.setattr(quality_cnn, "LOT", 2)
    for k, x in model.gradients(texts, y).items():
        assert np.allclose(x, g[k])
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, step = model.p[k][at], 1e-5
        model.p[k][at] = old + step
        up = loss()
        model.p[k][at] = old - step
        down = loss()
        model.p[k][at] = old
        assert abs((up - down) / (2 * step) - g[k][at]) < 1e-3 * max(1, abs(g[k][at]))


def test_network_learns_from_every_chunk():
    """What tells the classes apart stands beyond the tenth chunk, between plain ones."""
    rng = np.random.default_rng(4)
    plain = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    texts = [(plain(2600) + (b"#" * 40 if y else b"") + plain(2600), y) for y in (0, 1) * 60]
    model = quality_cnn.ByteCNN().fit(texts, epochs=20)
    assert np.mean([(s > 0.5) == y for s, (_, y) in zip(model.scores(t for t, _ in texts), texts, strict=True)]) > 0.95


def test_network_repeated_ids(spark):
    """Ids with both labels are not learnt from, of an id's texts always the same one is."""
    docs = frame(spark, [(1, "good one"), (1, "good other"), (7, "bad one"), (8, "neither"), (9, "good two")])
    labels = [(1, 1), (1, 1), (7, 0), (8, 0), (8, 1), (9, None)]  # none of these ids is held out
    got = [quality_cnn.train(docs.orderBy(F.rand(k)), frame(spark, labels[::step], "doc_id long, quality int")) for k, step in ((1, 1), (2, -1))]
    assert all((got[0].p[k] == got[1].p[k]).all() for k in got[0].p)
    assert isinstance(quality_cnn.train(docs, frame(spark, [(8, 0), (8, 1)], "doc_id long, quality int")), quality_cnn.Constant)


def test_network_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = quality_cnn.classify(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert np.mean([r[0] == r[1] for r in scored]) > 0.97
    assert np.mean([r[0] for r in scored if r[1] == 1]) > 0.98


def test_network_edges(spark):
    schema = "doc_id long, text string, score_ int, held int"
    docs = frame(spark, [(1, None, 0, 0), (None, "", 0, 0), (3, LONG, 0, 0), (3, LONG, 0, 0)], schema)
    labels = frame(spark, [(1, 1, 0), (3, 1, 0), (None, 0, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_cnn.classify(docs, labels).collect()
    assert len(got) == 4 and all(r["predicted"] == 1 and 0 <= r["score"] <= 1 for r in got)
    assert quality_cnn.classify(frame(spark, [], schema), frame(spark, [], "doc_id long, quality int, toxic int")).count() == 0
    model = quality_cnn.ByteCNN(1)
    texts = [LONG.encode(), b"", b"x" * 1000]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])


# --- decontamination


def test_masks_hit_every_stretch():
    n = decontamination.OVERLAP
    for gone in itertools.combinations(range(n), 2):
        assert any(all(at + i not in gone for i in m) for m in decontamination.MASKS for at in range(n - m[-1]))


def brute_leaks(docs, items):
    """Every diagonal of every pair, compared token by token."""
    cut = lambda t: [x for x in re.split(r"[^\w]+|_", (t or "").lower()) if x]
    found = set()
    for (i, t), (j, b) in itertools.product(docs, items):
        d, q = cut(t), cut(b)
        if not q:
            continue
        stretch = min(decontamination.OVERLAP, len(q))
        known = set(d)
        need = -(-decontamination.AGREE_PERCENT * stretch // 100)
        if sum(w in known for w in q) < need:
            continue
        for d0 in range(-len(q), len(d)):
            met = [0 <= d0 + k < len(d) and d[d0 + k] == w for k, w in enumerate(q)]
            if any(sum(met[s : s + stretch]) >= need for s in range(len(q) - stretch + 1)):
                found.add((i, j))
    return found


def test_masks_of_short_items_miss_nothing():
    """Whatever n // 5 tokens of an item of n are substituted, one of its masks looks at none of them."""
    for n in range(1, decontamination.OVERLAP):
        for gone in itertools.combinations(range(n), n // 5):
            assert any(not set(m) & set(gone) for m in decontamination.masks_for(n)), (n, gone)


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_leaks_against_brute_force(spark, most):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, draw(n)) for k, n in enumerate((30, 13, 12, 8, 5, 4, 25, 20, 10, 9, 1, 2))]
    docs = []
    for i in range(60):
        _, q = rng.choice(items)
        part = list(q) if i % 3 else list(q)[rng.randrange(3) : len(q) - rng.randrange(6)]
        for _ in range(rng.randrange(5)):
            if part:
                part[rng.randrange(len(part))] = rng.choice(words)
        docs.append((i, " ".join(draw(rng.randrange(30)) + part + draw(rng.randrange(30)))))
    texts = [(k, ", ".join(q).upper()) for k, q in items] + [(100, None), (101, ""), (102, texts_of(items, 0))]
    docs += [(200, None), (201, ""), (202, texts_of(items, 0)), (202, texts_of(items, 0)), (203, LONG[:20_000] + texts_of(items, 1)), (None, texts_of(items, 6))]
    got = decontamination.contaminated(frame(spark, docs), frame(spark, texts, "item_id long, text string"), max_broadcast=most).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_leaks(docs, texts)
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})
    assert all(r["matched"] * 100 >= r["overlap"] * 60 for r in got)


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_long_items_and_common_seeds(spark, most):
    """An item of thousands of tokens, and a passage that many items and many documents share."""
    rng = random.Random(12)
    draw = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    common, long = draw(8), draw(2500)
    items = [(k, " ".join(common + draw(20))) for k in range(40)] + [(100, " ".join(long))]
    docs = [(i, " ".join(draw(10) + common + draw(10))) for i in range(40)] + [(100, " ".join(draw(5) + long)), (101, " ".join(long[1000:1013])), (102, items[3][1])]
    got = decontamination.contaminated(frame(spark, docs), frame(spark, items, "item_id long, text string"), max_broadcast=most).collect()
    assert {(r["doc_id"], r["item_id"]): (r["overlap"], r["matched"]) for r in got} == {(100, 100): (2500, 2500), (101, 100): (17, 13), (102, 3): (28, 28)}


def test_short_items_remove_nothing_by_themselves(spark):
    docs = frame(spark, [(1, "the end"), (2, "a b c d e f")])
    items = frame(spark, [(1, "the"), (2, "a b c x e")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_tokens"]) for r in decontamination.contaminated(docs, items).collect()) == [(1, 1), (2, 5)]
    assert [r[0] for r in decontamination.decontaminate(docs, items).collect()] == [1]


def texts_of(items, k):
    return " ".join(items[k][1])


def test_leaks_edges(spark):
    docs = frame(spark, [(1, "a b c d e f g", 1, 2), (2, None, 1, 2), (3, "else", 1, 2)], "doc_id long, text string, seed int, p int")
    items = frame(spark, [(1, "A, b c; d e f g.")], "item_id long, text string")
    none = frame(spark, [], "item_id long, text string")
    assert sorted(r[0] for r in decontamination.decontaminate(docs, items).collect()) == [2, 3]
    assert decontamination.decontaminate(docs, none).count() == 3
    assert decontamination.contaminated(frame(spark, []), items).count() == 0


# --- pages

ARTICLE = "<p>First, a long paragraph with commas, and &amp; more words to be sure of it.</p><p>Second  one\n with <b>bold</b><br>text, and a <a href='x'>link</a>.</p><p>Short.</p>"
EXPECTED = "First, a long paragraph with commas, and & more words to be sure of it.\nSecond one with bold text, and a link.\nShort."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><ul><li><a href=1>Home</a></ul></nav><article>{ARTICLE}</article><footer>&copy; me</footer></body></html>",
        f"<div class='header'>Site name</div><div id=content>{ARTICLE}</div><div class='sidebar'><p>Much, much, other, text, in, here, that, is, long, enough.</p></div>",
        f"<body><div class=menu>x</div><main><section>{ARTICLE}</section></main><section id=comments><p>I, for one, like it, very much, so much, that, I write, commas, again, and again.</p></section>",
        f"<body><div class='cookie-notice'><p>We use cookies, and more, and more, and more.</p></div><div class='with-sidebar'>{ARTICLE}<form><p>Name, please, and address</p><input></form><aside>no</aside></div>",
        f"<title>T</title><script>if (a < b) document.write('<p>bad, bad</p>')</script><style>p {{ }}</style><!-- <p>hidden, too</p> --><table><tr><td>{ARTICLE}</td></tr></table>",
        f"<body><div class=ad-slot><p>Buy, now, cheap, cheap</p></div><div>{ARTICLE}<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul></div>",
        ARTICLE.replace("</p>", ""),
    ],
)
def test_pages(page):
    assert html_text.main_text(page) == EXPECTED


@pytest.mark.parametrize("n", [10, 9_000, 11_000, 300_000])
def test_long_quoted_attributes(n):
    """Markup in a quoted attribute is no text, whatever its length."""
    value = "<p>leak, leak, and leak</p> " * (n // 28 + 1)
    for quote in "\"'":
        assert html_text.main_text(f"<article><div data-x={quote}{value}{quote}>{ARTICLE}</div></article>") == EXPECTED
    assert html_text.main_text("<article><p title='open>" + "word, word and word, to be long enough. " * 400 + "</p></article>").startswith("word, word")


@pytest.mark.parametrize("piece", ["<div><a href=x>link</a><p>A paragraph, with commas, in a div that never closes.", "<b><p>text, and more</b>", "<ul><li><a>x</a>y", "<blockquote><p>quoted, text", "<b></i></span></ul>text <a>", "<dl><dt>t<dd>d, e", "<body><p>x", "<table><tr><td><p>x, y"])
def test_deep_pages_in_linear_time(piece):
    """Twenty thousand elements that never close: counts go up the tree once, and nothing that isn't open is looked for."""
    import time

    start = time.perf_counter()
    html_text.main_text("<html><body>" + piece * 10_000)
    assert time.perf_counter() - start < 3


def test_parts_of_an_article_stay():
    """Paragraphs whose names merely hold a doubtful word, and lists of references, are the article's own."""
    kept = ["<p class='note print'>A note, in print.</p>", "<p id='form-of-life'>On forms of life, and more.</p>", "<div class='byline-free rating'>Rated, and kept.</div>"]
    links = "<ul>" + "".join(f"<li><a href='{k}'>Reference {k}</a></li>" for k in range(3)) + "</ul>"
    got = html_text.main_text(f"<article>{ARTICLE}{''.join(kept)}{links}</article><div class='print'>Print, this, page</div>")
    assert got == EXPECTED + "\nA note, in print.\nOn forms of life, and more.\nRated, and kept.\nReference 0\nReference 1\nReference 2"
    assert html_text.main_text(f"<article>{ARTICLE}<p class='advert'>Buy, now</p><div class='comments'>Nice, text</div><div class='related-links'>{links}</div></article>") == EXPECTED


def made_page(rng):
    """A page in a browser's sense of it, and its article's blocks."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    sentence = lambda n: ", ".join(" ".join(word() for _ in range(4)) for _ in range(n))
    blocks, body = [], []
    for _ in range(rng.randrange(4, 12)):
        text = sentence(rng.randrange(3, 9))
        mark = rng.choice(["p", "h2", "blockquote", "pre", "li"])
        inner = text.replace(" ", rng.choice([" ", "  ", "\n", " <b>x</b> "]), 1) if mark == "p" else text
        blocks.append(" ".join(re.sub("<[^>]*>", "", inner).split()))
        body.append(f"<ul><li>{inner}</li></ul>" if mark == "li" else f"<{mark}>{inner}</{mark}>")
        if rng.random() < 0.2:
            body.append(rng.choice(["<script>var a = '<p>no</p>';</script>", "<!-- <p>no, no</p> -->", "<form><p>Name, mail, and more</p><input></form>", "<div class='ad-box'><p>Buy, now, all</p></div>", "<style>p {}</style>"]))
    article = "".join(body)
    for _ in range(rng.randrange(3)):
        article = f"<{(t := rng.choice(['div', 'section', 'main']))}>{article}</{t}>"
    menu = "<nav><ul>" + "".join(f"<li><a href=/{k}>{word()}</a></li>" for k in range(5)) + "</ul></nav>"
    side = f"<aside><p>{sentence(3)}</p></aside><footer>{sentence(2)}</footer><div class='comments'><p>{sentence(8)}</p></div>"
    return f"<!doctype html><html><head><title>{word()}</title></head><body>{menu}<div id='content'>{article}</div>{side}</body></html>", "\n".join(blocks)


def test_pages_made_from_their_articles():
    """Pages built around known articles give those back."""
    rng = random.Random(21)
    for _ in range(300):
        page, want = made_page(rng)
        assert html_text.main_text(page) == want, page


def test_page_edges(spark):
    assert [html_text.main_text(x) for x in (None, "", "<p>", "<nav>x</nav>", "plain text", "a < b", "<p>&#233;&lt;&nope;</p>", "<p unclosed")] == ["", "", "", "", "plain text", "a < b", "é<&nope;", ""]
    many = "<article>" + "<p>word, word and word again, to be long.</p>" * 5000 + "</article>"
    assert html_text.main_text(many).count("\n") == 4999
    assert html_text.main_text("<div>" * 3000 + "deep text here" + "</div>" * 3000) == "deep text here"
    rows = [(1, "u", None, 5), (2, None, "<p>é x</p>", 6), (2, None, "<p>é x</p>", 6)]
    got = html_text.extract(frame(spark, rows, "page_id long, url string, html string, points int")).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"], r["points"]) for r in got) == [(1, "", 0, 5), (2, "é x", 3, 6), (2, "é x", 3, 6)]
    assert html_text.extract(frame(spark, [], "page_id long, url string, html string")).count() == 0


# --- licences


def test_every_template_is_found():
    scanner = licenses.scanner()
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            assert [x[0] for x in scanner.scan(f"words before\n{t}\nwords after".encode())] == [family], t


def test_wrapped_templates_are_found():
    """Templates wrapped at 70 columns, plain or in comments, among other lines."""
    scanner = licenses.scanner()
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            wrapped = textwrap.wrap(t, 70)
            for mark in ("", "# ", " * "):
                lines = ["Copyright 2020 somebody", *wrapped, "import that", "", "x = 1"]
                found = scanner.scan("\n".join(mark + x for x in lines).encode())
                assert found and found[0][1] in (1, 2) and {x[0] for x in found} == {family}, (t, found)  # a short notice may stand in its second line
    assert scanner.scan(("\n".join(licenses.PLAIN)).encode()) == []


@pytest.mark.parametrize(("line", "family"), [("# SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL"), ("/* SPDX-License-Identifier: BSD-2-Clause */", "BSD"), ("This tool is distributed under the MIT License.", "MIT"), ("All code here is licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Our pictures are licensed under CC BY-SA 4.0, unless said otherwise.", "CC-BY-SA"), ("BSD 2-Clause License", "BSD")])
def test_other_wordings(line, family):
    assert [x[0] for x in licenses.scanner().scan(f"first\n{line}\nlast".encode())] == [family]


def test_paragraphs_of_the_tables_without_a_licence(spark, tables):
    """Of the documents' lines without any word of licences none is taken for one."""
    lines = [x for r in table(spark, tables, "documents").collect() for x in (r["text"] or "").split("\n")]
    free = [x for x in lines if not re.search("licen|released|copyright|permission|warrant|attribution|spdx|bsd", x, re.IGNORECASE)]
    assert len(free) > 1000 and licenses.scanner().scan("\n".join(free).encode()) == []


def test_plain_text_is_no_licence():
    scanner, rng = licenses.scanner(), random.Random(8)
    for t in licenses.PLAIN:
        assert scanner.scan(t.encode()) == []
    for templates in licenses.TEMPLATES.values():
        for t in templates:
            w = t.split()
            rng.shuffle(w)
            if len(w) > 8:
                assert scanner.scan(" ".join(w).encode()) == []


def test_key_pairs_lose_nothing():
    """Whatever the whole classifier accepts also has a key pair."""
    scanner, rng = licenses.scanner(), random.Random(9)
    for pairs in (p for each in scanner.pairs.values() for p in each):
        need = int(np.ceil(licenses.CONFIRM * len(pairs) - 1e-9))
        for _ in range(20):
            assert not scanner.keys.isdisjoint(rng.sample(sorted(pairs), need))


def test_license_rows(spark):
    rows = [(1, "x\nReleased under the MIT License.\ny\nReleased under the MIT License.", 1), (2, None, 1), (3, "", 1), (None, "Licensed under CC BY-NC 4.0.", 1), (5, LONG + "\nReleased under the GPL.", 1), (5, LONG + "\nReleased under the GPL.", 1)]
    got = licenses.scan_licenses(frame(spark, rows, "doc_id long, text string, family int")).collect()
    assert sorted(((r["doc_id"], r["family"], r["paragraphs"]) for r in got), key=repr) == sorted([(1, "MIT", [1, 3]), (None, "CC-BY-NC", [0]), (5, "GPL", [1]), (5, "GPL", [1])], key=repr)
    assert licenses.scan_licenses(frame(spark, [])).count() == 0
