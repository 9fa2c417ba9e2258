"""SimHash near-duplicates by anchor-point covering.

Anchors come from the perfect binary Golay code of length 23: its 4,096 codewords cover all words of 23 bits with
radius 3. A fingerprint's 64 bits are three blocks (23, 23 and 18 bits, the last padded with zeros), and an anchor
is a pair of codewords for two of the blocks. Two fingerprints that differ in three bits at most either agree in
one block and differ by one bit at most in another, or differ by one bit in every block. So it is enough to send a
fingerprint to the anchors whose codewords lie within the covering radius plus one in both blocks of the first
pair, or within the radius in one block and within the radius plus one in the other block of the other pairs: some
anchor then holds one fingerprint as its nearest (its home) and the other among those sent to it. That is about 47
rows a fingerprint over 3 * 2**24 anchors, whatever the corpus.

Per anchor only links are found, never all pairs written: sparse anchors compare homes with the rest, dense ones
grow a spanning forest, so copies in thousands give as many links, not their square. An anchor with more rows than
a block holds is dealt again in blocks, every pair of blocks meeting once, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.components import connected_components
from corpusforge.session import materialize

SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PIECE = 1 << 20
#: Rows of one anchor that a task compares at once.
BLOCK = 40_000
#: Fixed value: a generator polynomial of the binary Golay code of length 23.
GOLAY = 0b110001110101
WIDTH, CHECK = 23, 11


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a bounded piece at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes | None, ngram: int = 3) -> int:
    """64-bit SimHash over all shingles of a UTF-8 text, unsigned; 0 if it has no word."""
    total, ones, tail = 0, np.zeros(64, np.int64), []
    for words in _pieces((text or b"").translate(LOWER)):
        words = tail + words
        tail = words
        if len(words) >= ngram:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1]))
            spans = zip(starts[: len(words) - ngram + 1].tolist(), (ends[ngram - 1 :] - 1).tolist(), strict=True)
            n = len(words) - ngram + 1
            hashes = np.fromiter((xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in spans), np.uint64, n)
            ones += _bit_counts(hashes)
            total += n
            tail = words[-(ngram - 1) :] if ngram > 1 else []
    if not total:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    bits = ones * 2 > total
    return int(np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    out = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8), bitorder="little")
        out += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return out


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3) -> DataFrame:
    """Rows (doc_id, doc_hash, fp): the text's hash, the fingerprint as a signed long; 0 for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((fingerprint(x.as_py(), ngram) for x in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out.view(np.int64))], ["doc_id", "doc_hash", "fp"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("doc_hash"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, doc_hash long, fp long")


class Golay:
    """Codewords near any word of 23 bits, from the code's syndromes."""

    def __init__(self) -> None:
        words = np.arange(1 << (WIDTH - CHECK), dtype=np.int64) << CHECK
        for bit in range(WIDTH - 1, CHECK - 1, -1):
            words = np.where(words >> bit & 1, words ^ (GOLAY << (bit - CHECK)), words)
        self.check = words.astype(np.int32)
        one = 1 << np.arange(WIDTH, dtype=np.int64)
        by_weight = [np.zeros(1, np.int64)]
        for _ in range(4):
            by_weight.append(np.unique((by_weight[-1][:, None] ^ one[None, :]).ravel()))
            by_weight[-1] = by_weight[-1][np.bitwise_count(by_weight[-1]) == len(by_weight) - 1]
        self.near = np.zeros((1 << CHECK, 6), np.int32)
        self.count = np.zeros(1 << CHECK, np.int32)
        for errors in by_weight:
            syndromes = self.syndrome(errors)
            order = np.argsort(syndromes, kind="stable")
            for e, s in zip(errors[order].tolist(), syndromes[order].tolist(), strict=True):
                self.near[s, self.count[s]] = e
                self.count[s] += 1

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.check[words >> CHECK] ^ (words & ((1 << CHECK) - 1)).astype(np.int32)

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word six codeword numbers, the nearest first, and which of them lie within the radius plus one."""
        s = self.syndrome(words)
        return (words[:, None].astype(np.int32) ^ self.near[s]) >> CHECK, np.arange(6)[None, :] < self.count[s][:, None]


def expand(prints: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor keys, the row of prints each came from, and whether the anchor is that row's home."""
    low = (1 << WIDTH) - 1
    blocks = [code.anchors(((prints >> np.uint64(s)) & np.uint64(low)).astype(np.int64)) for s in (0, WIDTH)]
    blocks.append(code.anchors(((prints >> np.uint64(2 * WIDTH)) << np.uint64(5)).astype(np.int64)))
    six = np.arange(6)
    keys, rows, homes = [], [], []
    for pair, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
        (ids_x, ok_x), (ids_y, ok_y) = blocks[x], blocks[y]
        ok = ok_x[:, :, None] & ok_y[:, None, :]
        if pair:
            ok = ok & ((six[:, None] == 0) | (six[None, :] == 0))[None]
        r, i, j = np.nonzero(ok)
        keys.append(pair << 24 | ids_x[r, i] << 12 | ids_y[r, j])
        rows.append(r)
        homes.append((i == 0) & (j == 0))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(homes)


def _links_small(key: np.ndarray, fp: np.ndarray, home: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between homes and the rest of their anchors; rows are sorted by anchor."""
    at, a, b, shift = np.arange(len(key)), [], [], 0
    while len(at):
        shift += 1
        at = at[at + shift < len(key)]
        at = at[key[at] == key[at + shift]]
        x, y = fp[at], fp[at + shift]
        hit = (home[at] | home[at + shift]) & (np.bitwise_count(x ^ y) <= limit) & (x != y)
        a.append(x[hit])
        b.append(y[hit])
    return np.concatenate(a or [fp[:0]]), np.concatenate(b or [fp[:0]])


def _links_large(fp: np.ndarray, home: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one anchor with many rows: those of its homes if they are few, else a spanning forest."""
    homes, a, b = np.unique(fp[home]), [], []
    fp = np.unique(fp)
    if len(homes) * 8 < len(fp):
        for x in homes:
            y = fp[(np.bitwise_count(fp ^ x) <= limit) & (fp != x)]
            a.append(np.full(len(y), x))
            b.append(y)
            if sum(map(len, a)) > 4 * len(fp):
                break
        else:
            return np.concatenate(a or [fp[:0]]), np.concatenate(b or [fp[:0]])
    a, b, rest, todo = [], [], fp, []
    while len(rest):
        if todo:
            x = todo.pop()
        else:
            x, rest = rest[0], rest[1:]
        near = np.bitwise_count(rest ^ x) <= limit
        if near.any():
            y, rest = rest[near], rest[~near]
            a.append(np.full(len(y), x))
            b.append(y)
            todo.extend(y)
    return np.concatenate(a or [fp[:0]]), np.concatenate(b or [fp[:0]])


SCHEMA = "a long, b long, later int, tile long, home boolean"


def _compare(limit: int, block: int | None):
    """Over rows (tile, fp, home) sorted by tile: links, or the rows themselves where a tile has more than a block."""

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())],
            ["a", "b", "later", "tile", "home"],
        )

    def put_off(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        n = len(key)
        return pa.RecordBatch.from_arrays(
            [pa.array(fp.view(np.int64)), pa.nulls(n, pa.int64()), pa.array(np.ones(n, np.int32)), pa.array(key), pa.array(home)],
            ["a", "b", "later", "tile", "home"],
        )

    def whole(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.flatnonzero(np.diff(key)) + 1
        starts, sizes = np.concatenate(([0], edges)), np.diff(np.concatenate(([0], edges, [len(key)])))
        big = sizes > 48
        small = np.repeat(~big, sizes)
        yield out(*_links_small(key[small], fp[small], home[small], limit))
        for s, n in zip(starts[big].tolist(), sizes[big].tolist(), strict=True):
            yield out(*_links_large(fp[s : s + n], home[s : s + n], limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            home = batch.column(2).to_numpy(zero_copy_only=False)
            if over is not None:
                n = int(np.searchsorted(key, over, side="right"))
                if n:
                    yield put_off(key[:n], fp[:n], home[:n])
                if n == len(key):
                    continue
                key, fp, home, over = key[n:], fp[n:], home[n:], None
            if held:
                key, fp, home = (np.concatenate(x) for x in zip(held, (key, fp, home), strict=True))
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from whole(key[:cut], fp[:cut], home[:cut])
            held = (key[cut:], fp[cut:], home[cut:])
            if block and len(held[0]) > block:
                yield put_off(*held)
                held, over = None, int(key[-1])
        if held:
            yield from whole(*held)

    return run


def links(prints: DataFrame, max_distance: int = 3, block: int = BLOCK) -> DataFrame:
    """Rows (a, b): links between distinct fingerprints (column fp, long) at max_distance bits or fewer, by anchors.

    Enough links are kept for the components to be exact: a dense anchor gives a spanning forest of its links. The
    covering holds for distances up to three.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("the anchors cover distances up to three")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                key, row, home = expand(part, code)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(part[row].view(np.int64)), pa.array(home)], ["tile", "fp", "home"])

    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.where("fp is not null").select("fp").repartition(parts, "fp").distinct()  # not coalesced: rows multiply
    sent = distinct.mapInArrow(send, "tile long, fp long, home boolean")
    dealt = sent.repartition("tile").sortWithinPartitions("tile")
    first = materialize(dealt.mapInArrow(_compare(max_distance, block), SCHEMA), "anchors")
    found = first.where("later = 0").select("a", "b")
    put_off = first.where("later = 1").select("tile", F.col("a").alias("fp"), "home")
    if put_off.isEmpty():
        return found
    counts = put_off.groupBy("tile").agg(F.ceil(F.count("*") * 2 / F.lit(block)).cast("int").alias("parts"))
    rows = put_off.join(counts, "tile").withColumn("mine", F.expr("pmod(xxhash64(fp, 7), parts)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    tiles = rows.select(F.xxhash64("tile", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"), "fp", "home")
    rest = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_compare(max_distance, None), SCHEMA)
    return found.unionByName(rest.select("a", "b"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3, max_distance: int = 3) -> DataFrame:
    """Rows (doc_id, doc_hash, fingerprint, component_root, component_id), one for each row of docs.

    component_id is the smallest doc_id reachable over links of max_distance bits or fewer, its own included.
    Null and empty texts have fingerprint zero and link like any other; repeated rows come back as often as they
    came; a null doc_id is never a smallest one (a component of nothing else has a null component_id); an empty
    table gives an empty result; other columns of docs are not read.
    """
    prints = materialize(with_fingerprints(docs, id_col, text_col, ngram), "prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected_components(links(classes, max_distance))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", F.col("root").alias("component_root"), "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(by_print, "fp").select("doc_id", "doc_hash", hexed, "component_root", "component_id")


def keep_chosen(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all their columns, that chosen names (__sh_component: an id, __sh_least: a text's hash), one each.

    Of equal rows one stays. Rows with a null id are kept: they can't be told apart.
    """
    marked = docs.withColumns({"__sh_id": F.col(id_col).cast("long"), "__sh_hash": F.xxhash64(text_col)})
    stays = (F.col("__sh_id") == F.col("__sh_component")) & (F.col("__sh_hash") == F.col("__sh_least"))
    kept = marked.join(chosen, stays, "left_semi").dropDuplicates(["__sh_id", "__sh_hash"]).select(*docs.columns)
    return kept.unionByName(docs.where(F.col(id_col).isNull()))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3, max_distance: int = 3) -> DataFrame:
    """The rows of docs of which each component keeps one: its smallest doc_id, where rows repeat that the least text hash."""
    found = simhash_components(docs, id_col, text_col, ngram, max_distance)
    chosen = found.where("doc_id = component_id").groupBy("component_root", F.col("component_id").alias("__sh_component")).agg(F.min("doc_hash").alias("__sh_least"))
    return keep_chosen(docs, chosen, id_col, text_col)
