"""SimHash near-duplicates at a Jaccard similarity of word shingles, by anchors of many covering codes.

Two texts with similarity 0.8 differ in about 15 % of all SimHash bits, so a fingerprint has BITS bits here and links
reach up to LIMIT of them. One covering code with radius plus such a threshold would send each fingerprint to a great
share of its anchors; so the threshold is dealt over many codes instead. A view is a choice of 37 of the bits with the
product of three perfect codes over them (Golay of length 23, Hamming of length 7 twice; covering radius 3 + 1 + 1), and
a fingerprint goes to the anchor of every view within the covering radius: one each, 2**20 anchors a view. Per anchor
fingerprints are compared over all their bits, and what differs in LIMIT bits or fewer is held against the shingles
themselves: a link stands where their Jaccard similarity is SIMILAR_PERCENT or more. The first few views come first;
what they connect isn't compared again in the others, so a large group of copies costs a few verifications a text.

Anchors and comparison are laid out as in corpusforge.llm.simhash: copies count once, dense anchors give a spanning
forest of their links, and anchors beyond a block are dealt again in pairs of blocks.

Fingerprints find most links, not all, and texts of one fingerprint need not be similar. An exact step follows for what
they leave: texts are told apart by their sets of shingles, and two sets of the similarity share a shingle among the
first of each in any common order, as many as may be missing and one more. The order puts what is frequent in a sample
last, which only spares comparisons. Sets that share such a shingle and aren't connected yet are held against each other
by size, place and the parities of PARITIES counters, bounds that no pair of the similarity fails, and then by their
shingles. Words, shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm.components import connected_components
from corpusforge.llm.simhash import CHECK, LOWER, Golay, _bit_counts, _pieces, keep_chosen
from corpusforge.session import discard, materialize

LANES = 4
BITS = 64 * LANES
NGRAM = 5
#: Largest number of differing bits of a candidate. At similarity 0.8 the expectation is 0.1515 * BITS = 39, with a deviation
#: of 6; the more above that, the more texts are verified that are less similar.
LIMIT = 48
SIMILAR_PERCENT = 80
#: Permutations of the bits; each gives as many views as fit into it without overlap.
ROUNDS, SEED = 20, 23
#: Views that come first, and alone.
FIRST_VIEWS = 6
#: Views whose rows are shuffled at once: a fingerprint is a row in each, and the disk holds one such shuffle at a time.
VIEWS_AT_ONCE = 20
GOLAY_WIDTH, HAMMING_WIDTH = 23, 7
VIEW = GOLAY_WIDTH + 2 * HAMMING_WIDTH
#: Rows of one anchor that a task compares at once.
BLOCK = 40_000
KNOWN_WORDS = 500_000
#: Names of texts to verify, and pairs of them, that are broadcast and taken at once; more are taken in rounds.
MAX_BROADCAST, PAIRS_AT_ONCE = 1_000_000, 250_000
#: Counters whose parities bound the difference of two sets of shingles.
PARITIES = 512
#: Texts whose shingles are counted for the order of the exact step, and the number of frequent ones that it tells apart.
SAMPLE, MAX_FREQUENT = 20_000, 200_000
#: Rows of a shingle from which those of its commonest component aren't compared among themselves.
MANY = 48
LANE_NAMES = [f"l{k}" for k in range(LANES)]
#: Multipliers of the mixing steps: odd, any others would do.
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: What is added to a shingle's hash before it is mixed to a lane.
STEPS = np.arange(LANES, dtype=np.uint64) * B


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * A
    x = (x ^ (x >> np.uint64(29))) * B
    return x ^ (x >> np.uint64(32))


def nodes_of(prints: np.ndarray) -> np.ndarray:
    """A 64-bit name of each fingerprint (rows of LANES words)."""
    out = np.zeros(len(prints), np.uint64)
    for k in range(LANES):
        out = _mixed(out + prints[:, k] + np.uint64(k + 1))
    return out


def set_name(shingles: np.ndarray) -> int:
    """A 64-bit name of a set of shingles, signed; 0 of the empty one."""
    total = _mixed(shingles + A).sum(dtype=np.uint64)
    return int(_mixed(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0]) if len(shingles) else 0


def parities(shingles: np.ndarray) -> bytes:
    """The parities of PARITIES counters; those of two sets differ in no more places than the sets in shingles."""
    counts = np.bincount((_mixed(shingles + B) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


class Sketcher:
    """Fingerprints of texts; remembers word hashes while they are few enough."""

    def __init__(self, ngram: int = NGRAM) -> None:
        self.ngram, self.known = ngram, {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        out = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            out[i] = h
        return out

    @staticmethod
    def _joined(words: np.ndarray, n: int) -> np.ndarray:
        """Hashes of all runs of n words, from the words' hashes."""
        out = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            out = _mixed(out * A + words[k : len(words) - n + 1 + k])
        return out

    def __call__(self, text: bytes | None) -> np.ndarray:
        """LANES words of a text's fingerprint over all its shingles, repeats included; zeros without a word."""
        return self.sketch(text)[0]

    def sketch(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """A text's fingerprint and its distinct shingles, from one pass."""
        ones, total, tail, parts = np.zeros(BITS, np.int64), 0, np.zeros(0, np.uint64), []
        for words in _pieces((text or b"").translate(LOWER)):
            tail = np.concatenate([tail, self._hashes(words)])
            if len(tail) >= self.ngram:
                shingles = self._joined(tail, self.ngram)
                total += len(shingles)
                parts.append(np.unique(shingles))
                for k in range(LANES):
                    ones[64 * k : 64 * k + 64] += _bit_counts(_mixed(shingles + STEPS[k]))
                tail = tail[len(tail) - self.ngram + 1 :]
        if not total:
            if not len(tail):
                return np.zeros(LANES, np.uint64), tail
            shingle = self._joined(tail, len(tail))
            return np.concatenate([_mixed(shingle + STEPS[k]) for k in range(LANES)]), shingle
        found = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        return np.packbits((ones * 2 > total).astype(np.uint8), bitorder="little").view(np.uint64), found

    def shingles(self, text: bytes | None) -> np.ndarray:
        """A text's distinct shingles, as hashes; of a shorter text all its words as one."""
        words = self._hashes((text or b"").translate(LOWER).split())
        return np.unique(self._joined(words, min(self.ngram, len(words)))) if len(words) else np.zeros(0, np.uint64)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM) -> DataFrame:
    """Rows (doc_id, doc_hash, set, parity, node, l0, ...): the text's hash, its set of shingles, the fingerprint's name and its lanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(ngram)
        for batch in batches:
            out, sets, parity = np.zeros((batch.num_rows, LANES), np.uint64), [], []
            for k, x in enumerate(batch.column(2)):
                out[k], shingles = sketch.sketch(x.as_py())
                sets.append(set_name(shingles))
                parity.append(parities(shingles))
            columns = [pa.array(nodes_of(out).view(np.int64)), *(pa.array(np.ascontiguousarray(out[:, k]).view(np.int64)) for k in range(LANES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.int64()), pa.array(parity, pa.binary()), *columns], ["doc_id", "doc_hash", "set", "parity", "node", *LANE_NAMES])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("doc_hash"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, doc_hash long, set long, parity binary, node long, " + ", ".join(f"{n} long" for n in LANE_NAMES))


class Anchors:
    """The nearest anchor of a fingerprint in every view."""

    def __init__(self) -> None:
        rng, views = np.random.default_rng(SEED), []
        for _ in range(ROUNDS):
            order = rng.permutation(BITS)
            views += [order[at : at + VIEW] for at in range(0, BITS - VIEW + 1, VIEW)]
        #: one column for each code of each view: the weights that make a word of the bits it looks at
        self.weights = np.zeros((BITS, 3 * len(views)), np.float32)
        for v, places in enumerate(views):
            for k, (s, n) in enumerate(((0, GOLAY_WIDTH), (GOLAY_WIDTH, HAMMING_WIDTH), (GOLAY_WIDTH + HAMMING_WIDTH, HAMMING_WIDTH))):
                self.weights[places[s : s + n], 3 * v + k] = 2.0 ** np.arange(n)
        self.n_views, self.golay = len(views), Golay()
        words = np.arange(1 << HAMMING_WIDTH)
        syndrome = np.bitwise_xor.reduce([np.where(words >> i & 1, i + 1, 0) for i in range(HAMMING_WIDTH)])
        nearest = np.where(syndrome > 0, words ^ (1 << np.maximum(syndrome - 1, 0)), words)
        self.hamming = np.unique(nearest, return_inverse=True)[1].astype(np.int64)

    def __call__(self, prints: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """For rows of LANES words the anchors' keys, one column for each view from first to before last."""
        last = self.n_views if last is None else last
        bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(len(prints), -1), axis=1, bitorder="little")
        words = (bits.astype(np.float32) @ self.weights[:, 3 * first : 3 * last]).astype(np.int64).reshape(len(prints), last - first, 3)
        g = words[:, :, 0]
        home = (g ^ self.golay.near[self.golay.syndrome(g), 0]) >> CHECK
        key = home << 8 | self.hamming[words[:, :, 1]] << 4 | self.hamming[words[:, :, 2]]
        return key | np.arange(first, last, dtype=np.int64)[None] << 20


@cache
def anchors() -> Anchors:
    return Anchors()


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int32)


def _links_small(key: np.ndarray, root: np.ndarray, fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """All links within anchors between different components; rows are sorted by anchor. Places in fp."""
    at, a, b, shift = np.arange(len(key)), [], [], 0
    while len(at):
        shift += 1
        at = at[at + shift < len(key)]
        at = at[key[at] == key[at + shift]]
        hit = at[root[at] != root[at + shift]]
        hit = hit[_distance(fp[hit], fp[hit + shift]) <= limit]
        a.append(hit)
        b.append(hit + shift)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links_large(root: np.ndarray, fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one anchor's links, without those inside a component, as places in fp."""
    rest, a, b, todo = np.arange(len(fp)), [], [], []
    while len(rest) and (root != root[0]).any():
        if todo:
            x = todo.pop()
        else:
            x, rest = rest[0], rest[1:]
        near = _distance(fp[rest], fp[x]) <= limit
        if near.any():
            y, rest = rest[near], rest[~near]
            todo.extend(y)
            y = y[root[y] != root[x]]
            a.append(np.full(len(y), x))
            b.append(y)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


SCHEMA = "a long, b long, tile long, root long, " + ", ".join(f"{n} long" for n in LANE_NAMES)


def _compare(limit: int, block: int | None):
    """Over rows (tile, root, l0, ...) sorted by tile: links (a, b), or the rows themselves where a tile has more than a block."""
    names = ["a", "b", "tile", "root", *LANE_NAMES]

    def out(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n, x, y = len(a), nodes_of(fp[a]).view(np.int64), nodes_of(fp[b]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), *[pa.nulls(n, pa.int64())] * (2 + LANES)], names)

    def put_off(key: np.ndarray, root: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        n = len(key)
        return pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 2, pa.array(key), pa.array(root), *(pa.array(np.ascontiguousarray(fp[:, k]).view(np.int64)) for k in range(LANES))], names)

    def whole(key: np.ndarray, root: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.flatnonzero(np.diff(key)) + 1
        starts, sizes = np.concatenate(([0], edges)), np.diff(np.concatenate(([0], edges, [len(key)])))
        big = sizes > 48
        small = np.repeat(~big, sizes)
        few = fp[small]
        yield out(few, *_links_small(key[small], root[small], few, limit))
        for s, n in zip(starts[big].tolist(), sizes[big].tolist(), strict=True):
            some = fp[s : s + n]
            yield out(some, *_links_large(root[s : s + n], some, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, root = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            fp = np.stack([batch.column(2 + k).to_numpy(zero_copy_only=False).view(np.uint64) for k in range(LANES)], axis=1)
            if over is not None:
                n = int(np.searchsorted(key, over, side="right"))
                if n:
                    yield put_off(key[:n], root[:n], fp[:n])
                if n == len(key):
                    continue
                key, root, fp, over = key[n:], root[n:], fp[n:], None
            if held:
                key, root, fp = (np.concatenate(x) for x in zip(held, (key, root, fp), strict=True))
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from whole(key[:cut], root[:cut], fp[:cut])
            held = (key[cut:], root[cut:], fp[cut:])
            if block and len(held[0]) > block:
                yield put_off(*held)
                held, over = None, int(key[-1])
        if held:
            yield from whole(*held)

    return run


def links(prints: DataFrame, views: slice = slice(None), limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """Rows (a, b): names of fingerprints (columns root, l0, ...) that meet at an anchor, have different roots and differ in limit bits at most."""

    def send(first: int, last: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = anchors()
        for batch in batches:
            root = batch.column(0).to_numpy(zero_copy_only=False)
            fps = np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns[1:]], axis=1) if batch.num_rows else np.zeros((0, LANES), np.uint64)
            for at in range(0, len(fps), 1024):
                part = fps[at : at + 1024]
                keys = find(part, first, last)
                rows = np.repeat(part, keys.shape[1], axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(root[at : at + 1024], keys.shape[1])), *(pa.array(np.ascontiguousarray(rows[:, k]).view(np.int64)) for k in range(LANES))], ["tile", "root", *LANE_NAMES]
                )

    columns = ["root", *LANE_NAMES]
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = materialize(prints.select(*columns).distinct().repartition(parts, *LANE_NAMES), "distinct")
    first, (start, stop, _) = None, views.indices(anchors().n_views)
    for at in range(start, stop, VIEWS_AT_ONCE):
        some = partial(send, at, min(at + VIEWS_AT_ONCE, stop))
        # not coalesced nor taken by the size of files: rows multiply
        sent = distinct.repartition(parts, *LANE_NAMES).mapInArrow(some, "tile long, " + ", ".join(f"{n} long" for n in columns)).repartition("tile").sortWithinPartitions("tile")
        compared = materialize(sent.mapInArrow(_compare(limit, block), SCHEMA), "anchors")
        first = first.unionByName(compared) if first else compared
    discard(distinct)
    found = first.where("tile is null").select("a", "b")
    late = first.where("tile is not null").select("tile", *columns)
    if late.isEmpty():
        return found.distinct()
    counts = late.groupBy("tile").agg(F.ceil(F.count("*") * 2 / F.lit(block)).cast("int").alias("parts"))
    rows = late.join(counts, "tile").withColumn("mine", F.expr(f"pmod(xxhash64({', '.join(LANE_NAMES)}), parts)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    tiles = rows.select(F.xxhash64("tile", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"), *columns)
    rest = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_compare(limit, None), SCHEMA)
    return found.unionByName(rest.select("a", "b")).distinct()


def _shingles(docs: DataFrame, prints: DataFrame, found: DataFrame, id_col: str, text_col: str, ngram: int) -> list[DataFrame]:
    """Tables (set, shingles) of the sets that have a candidate, each set in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(ngram)
        for batch in batches:
            each = [sketch.shingles(x.as_py()).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(each, pa.list_(pa.int64()))], ["set", "shingles"])

    ends = found.select(F.col("a").alias("set")).unionByName(found.select(F.col("b").alias("set"))).distinct()
    # copies are counted together before the join, which would send them all to one task
    chosen = materialize(prints.groupBy("set").agg(F.min("doc_hash").alias("__hash")).join(ends, "set", "left_semi"), "chosen")
    texts = docs.select(F.xxhash64(text_col).alias("__hash"), F.col(text_col).cast("binary").alias("__text"))
    out = []
    for part in _rounds(chosen, MAX_BROADCAST, "set"):
        some = texts.join(F.broadcast(part), "__hash").select("set", "__text").dropDuplicates(["set"])
        out.append(materialize(some.mapInArrow(run, "set long, shingles array<long>"), "shingles"))
    discard(chosen)
    return out


def _rounds(rows: DataFrame, most: int, *keys: str) -> list[DataFrame]:
    """The rows dealt by a hash of their keys, about so many or fewer in each part."""
    n = max(1, -(-rows.count() // most))
    return [rows.where(F.pmod(F.xxhash64(*keys), F.lit(n)) == k) for k in range(n)]


def _similar(pairs: DataFrame, shingles: list[DataFrame], percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose shingles have at least the similarity, in per cent.

    Each round broadcasts its pairs, so of the shingles only theirs are shuffled, and the disk holds one round's.
    """
    sets, out = shingles[0], None
    for more in shingles[1:]:
        sets = sets.unionByName(more)
    for part in _rounds(pairs, PAIRS_AT_ONCE, "a", "b"):
        side = lambda end, name, part=part: sets.join(F.broadcast(part), F.col("set") == F.col(end)).select("a", "b", F.col("shingles").alias(name))
        both = side("a", "sa").join(side("b", "sb"), ["a", "b"])
        common = F.size(F.array_intersect("sa", "sb"))
        good = materialize(both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "good")
        out = out.unionByName(good) if out else good
    return out


def _frequent(docs: DataFrame, n_sets: int, text_col: str, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample hold, sorted, and in how many; it bears on the speed of the exact step alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = Sketcher(ngram), set()
        for batch in batches:
            for x in batch.column(0):
                shingles = sketch.shingles(x.as_py())
                if (name := set_name(shingles)) not in seen:
                    seen.add(name)
                    yield pa.RecordBatch.from_arrays([pa.array(shingles.view(np.int64))], ["key"])

    every = max(1, -(-n_sets // SAMPLE))
    some = docs.where(F.expr(f"pmod(xxhash64(`{text_col}`), {every}) = 0")).select(F.col(text_col).cast("binary").alias("__text"))
    counts = materialize(some.mapInArrow(run, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 2"), "frequent")
    least, total = 3, 0
    for n, keys in sorted(counts.groupBy("n").count().collect(), reverse=True):
        total += keys
        if total > MAX_FREQUENT:
            least = n + 1
            break
    rows = counts.where(F.col("n") >= least).toArrow()
    discard(counts)
    keys, n = rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _first_shingles(frequent: tuple[np.ndarray, np.ndarray], ngram: int, percent: int):
    """Over texts: rows (key, set, place), the shingles of which a set of the similarity has one; place is the size and the rank."""
    keys, counts = frequent

    def first(shingles: np.ndarray) -> np.ndarray:
        n = len(shingles) - -(-percent * len(shingles) // 100) + 1
        if len(keys):
            at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
            weight = np.where(keys[at] == shingles, counts[at], 0)
            return shingles[np.argsort(weight, kind="stable")[:n]]
        return shingles[:n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = Sketcher(ngram), set()
        for batch in batches:
            for x in batch.column(0):
                shingles = sketch.shingles(x.as_py())
                name = set_name(shingles)
                if name in seen or not len(shingles):
                    continue
                if len(seen) > KNOWN_WORDS:
                    seen.clear()
                seen.add(name)
                out = first(shingles).view(np.int64)
                place = np.int64(len(shingles) << 32) | np.arange(len(out), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(np.full(len(out), name, np.int64)), pa.array(place)], ["key", "set", "place"])

    return run


def _candidates(percent: int):
    """Over rows (tile, place, set, root, parity) sorted by tile and place: pairs (a, b) of sets of a tile that may have the similarity."""

    def fits(size: np.ndarray, rank: np.ndarray, parity: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of the places x, y those whose common shingles, this one the first, can be as many as the similarity takes."""
        both = size[x] + size[y]
        common = -(-percent * both // (100 + percent))
        ok = np.flatnonzero(np.minimum(size[x] - rank[x], size[y] - rank[y]) >= common)
        some_x, some_y = (np.broadcast_to(z, both.shape)[ok] for z in (x, y))
        differ = np.bitwise_count(parity[some_x] ^ parity[some_y]).sum(axis=-1, dtype=np.int64)
        return ok[differ <= both[ok] - 2 * common[ok]]

    def small(tile, size, rank, root, parity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at, shift = np.arange(len(tile)), 0
        while len(at):
            shift += 1
            at = at[at + shift < len(tile)]
            at = at[(tile[at] == tile[at + shift]) & (percent * size[at + shift] <= 100 * size[at])]
            hit = at[root[at] != root[at + shift]]
            hit = hit[fits(size, rank, parity, hit, hit + shift)]
            yield hit, hit + shift

    def large(size, rank, root, parity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        names, inverse, counts = np.unique(root, return_inverse=True, return_counts=True)
        for x in np.flatnonzero(inverse != counts.argmax()):
            low, high = np.searchsorted(size, -(-percent * size[x] // 100)), np.searchsorted(size, 100 * size[x] // percent, side="right")
            y = low + np.flatnonzero(root[low:high] != root[x])
            y = y[fits(size, rank, parity, np.int64(x), y)]
            yield np.full(len(y), x), y

    def whole(tile, place, name, root, parity) -> Iterator[pa.RecordBatch]:
        size, rank = place >> 32, place & 0xFFFFFFFF
        edges = np.flatnonzero(np.diff(tile)) + 1
        starts, sizes = np.concatenate(([0], edges)), np.diff(np.concatenate(([0], edges, [len(tile)])))
        big = sizes > MANY
        few = np.flatnonzero(np.repeat(~big, sizes))
        found = [(few[x], few[y]) for x, y in small(tile[few], size[few], rank[few], root[few], parity[few])]
        for s, n in zip(starts[big].tolist(), sizes[big].tolist(), strict=True):
            part = slice(s, s + n)
            found += [(s + x, s + y) for x, y in large(size[part], rank[part], root[part], parity[part]) if len(x)]
        none = np.zeros(0, np.int64)
        a, b = (name[np.concatenate([none, *x])] for x in (zip(*found, strict=True) if found else ((), ())))
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            rows.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(batch.num_rows, -1))
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield from whole(*(x[:cut] for x in rows))
            held = [x[cut:] for x in rows]
        if held:
            yield from whole(*held)

    return run


def remaining_links(docs: DataFrame, prints: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """Rows (a, b): all links between sets of shingles that the links of good don't connect already."""
    sets = prints.groupBy("set").agg(F.min("parity").alias("parity"))
    sets = materialize(sets.join(connected_components(good).withColumnRenamed("node", "set"), "set", "left").select("set", F.coalesce("root", "set").alias("root"), "parity"), "sets")
    frequent = _frequent(docs, sets.count(), text_col, ngram)
    texts = docs.select(F.col(text_col).cast("binary").alias("__text"))
    rows = texts.mapInArrow(_first_shingles(frequent, ngram, percent), "key long, set long, place long")
    by_key = Window.partitionBy("key")
    met = rows.withColumns({"low": F.min("set").over(by_key), "high": F.max("set").over(by_key)}).where("low < high")
    shared = materialize(met.select("key", "set", "place").distinct(), "shared")
    # roots alone say what is still apart; the parities, most of a row, go to no other
    apart = shared.join(sets.select("set", "root"), "set").withColumns({"low": F.min("root").over(by_key), "high": F.max("root").over(by_key), "n": F.count("*").over(by_key)})
    apart = materialize(apart.where("low < high").select("key", "set", "place", "root", "n"), "apart")
    discard(shared)
    # a shingle's rows beyond a block are dealt in pairs of blocks
    dealt = apart.join(sets.select("set", "parity"), "set").withColumn("parts", F.when(F.col("n") > BLOCK, F.ceil(F.col("n") * 2 / F.lit(BLOCK))).otherwise(1).cast("int"))
    dealt = dealt.withColumn("mine", F.expr("cast(pmod(xxhash64(set), parts) as int)")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    tiles = dealt.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"), "place", "set", "root", "parity")
    pairs = tiles.repartition("tile").sortWithinPartitions("tile", "place").mapInArrow(_candidates(percent), "a long, b long")
    found = materialize(pairs.distinct(), "found")
    discard(apart)
    shingles = _shingles(docs, prints, found, id_col, text_col, ngram)
    out = _similar(found, shingles, percent)
    for done in (sets, found, *shingles):
        discard(done)
    return out


def verified_links(docs: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, limit: int = LIMIT, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """Rows (a, b): links between sets of shingles whose similarity is verified, all that the components need."""
    good = None
    # one set stands for a fingerprint; the exact step sees to the others
    named = materialize(prints.groupBy("node", *LANE_NAMES).agg(F.min("set").alias("set")), "named")
    end = lambda name: named.select(F.col("node").alias(name), F.col("set").alias(f"set_{name}"))
    for views in (slice(FIRST_VIEWS), slice(FIRST_VIEWS, None)):
        rooted = named.withColumn("root", F.col("set"))
        if good:
            rooted = named.join(connected_components(good).withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
        met = links(rooted, views, limit, BLOCK).join(end("a"), "a").join(end("b"), "b").where("set_a <> set_b")
        found = materialize(met.select(F.least("set_a", "set_b").alias("a"), F.greatest("set_a", "set_b").alias("b")).distinct(), "found")
        shingles = _shingles(docs, prints, found, id_col, text_col, ngram)
        more = _similar(found, shingles, percent)
        good = good.unionByName(more) if good else more
        for done in (found, *shingles):
            discard(done)
    return good.unionByName(remaining_links(docs, prints, good, id_col, text_col, ngram, percent))


def _rooted(docs: DataFrame, id_col: str, text_col: str, ngram: int, limit: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All fingerprints, and rows (set, root, first): each different set's component and its least (doc_id, doc_hash) with an id."""
    prints = materialize(with_fingerprints(docs, id_col, text_col, ngram), "prints")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "doc_hash")))
    classes = materialize(prints.groupBy("set").agg(first.alias("first")), "classes")
    roots = connected_components(verified_links(docs, prints, id_col, text_col, ngram, limit, percent)).withColumnRenamed("node", "set")
    return prints, classes.join(roots, "set", "left").select("set", F.coalesce("root", "set").alias("root"), "first")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, limit: int = LIMIT, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """Rows (doc_id, doc_hash, component_root, component_id), one for each row of docs.

    component_id is the smallest doc_id reachable over links, its own included. Texts without a word, null ones too,
    are one component; a text of fewer than ngram words links with its equals only; case of A-Z and white space don't
    count. Repeated rows come back as often as they came; a null doc_id is never a smallest one; an empty table gives an
    empty result; other columns of docs are not read.
    """
    prints, rooted = _rooted(docs, id_col, text_col, ngram, limit, percent)
    least = rooted.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    by_set = rooted.join(least, "root").select("set", F.col("root").alias("component_root"), "component_id")
    return prints.join(by_set, "set").select("doc_id", "doc_hash", "component_root", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, limit: int = LIMIT, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The rows of docs, all their columns, of which each component keeps one: its smallest doc_id, where rows repeat that the least text hash.

    Winners come from the different sets of shingles alone, so copies in any number are no burden of one task. Rows with a
    null doc_id are kept: they can't be told apart.
    """
    rooted = _rooted(docs, id_col, text_col, ngram, limit, percent)[1]
    chosen = rooted.groupBy("root").agg(F.min("first").alias("w")).where("w is not null")
    return keep_chosen(docs, chosen.select(F.col("w.doc_id").alias("__sh_component"), F.col("w.doc_hash").alias("__sh_least")), id_col, text_col)
