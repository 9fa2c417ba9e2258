"""LM scoring by cross-entropy difference.

Two bigram models, interpolated with unigrams. The target model is counted over the documents that labels call good,
the background model over all documents, its counts scaled to the target's number of tokens, so both are models of
corpora of one size with the same smoothing. Each token's loss under the target less its loss under the background is
averaged: the lower a document's score, the nearer it is to the target. A document's own counts are taken out of both
models before it is scored, so no text is judged by itself.

Counts are exact: words, contexts and bigrams are told apart by 64-bit hashes, and no table has a fixed size. Documents
are dealt into lots. A lot asks for the counts of the distinct words and bigrams in it and gives its own; askers meet by
ranges of the hash, where counts are added up and sent back in the order asked; the lot then scores its texts. What a
task holds is one lot or one range; nothing is gathered or broadcast. Both the distinct entries and the shuffles grow
with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Smoothing spreads SMOOTH counts to each of so many words, met or not.
VOCABULARY = 1 << 18
MIX, SMOOTH = 0.6, 0.5
#: Multipliers of the pair hash: odd, any others would do.
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: The start of a text; as a counted word it stands for all tokens.
START = 0
#: Bytes of text in a lot, the fewest lots, and bytes of text for each range of hashes beyond the fewest ranges.
LOT, LOTS, RANGE, RANGES = 16 << 20, 128, 64 << 20, 512


class Words:
    """64-bit hashes of words, behind START; remembers those it has seen while they are few enough."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words, known = text.lower().split(), self.known
        if len(known) > 500_000:
            known.clear()
        out = np.empty(len(words) + 1, np.uint64)
        out[0] = START
        for i, w in enumerate(words, 1):
            k = known.get(w)
            if k is None:
                k = known[w] = xxhash.xxh64_intdigest(w) or 1
            out[i] = k
        return out.view(np.int64)


def pair_slots(ids: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bigrams of a text's words."""
    x, y = ids[:-1].view(np.uint64), ids[1:].view(np.uint64)
    h = (x ^ (x >> np.uint64(31))) * A + (y ^ (y >> np.uint64(29))) * B
    h = (h ^ (h >> np.uint64(32))) * A
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _packed(rows: np.ndarray) -> bytes:
    """Whole numbers, bytes of one place together and compressed, behind their width, rows and columns."""
    top = int(rows.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    places = rows.astype(f"<u{width}", order="C").view(np.uint8).reshape(-1, width).T
    return bytes([width, len(rows)]) + rows.shape[1].to_bytes(4, "little") + pa.Codec("zstd").compress(places.tobytes(), asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width, n, m = data[0], data[1], int.from_bytes(data[2:6], "little")
    places = np.frombuffer(pa.Codec("zstd").decompress(data[6:], width * n * m, asbytes=True), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(places.T).view(f"<u{width}").reshape(n, m)


def _gaps(keys: np.ndarray) -> bytes:
    """Sorted hashes, packed as the gaps between them."""
    return _packed(np.diff(keys, prepend=np.uint64(0))[None])


def _hashes(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data)[0], dtype=np.uint64)


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of hashes starts in sorted keys, and their end."""
    starts = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, starts), [len(keys)])).astype(np.int64)


class Lot:
    """The texts of one lot, its distinct hashes and where each token's lie among them."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        self.lengths = np.array([len(ids) - 1 for ids in texts], np.int64)
        join = lambda x: np.concatenate([np.zeros(0, np.int64), *x]).view(np.uint64)
        tokens = [join(ids[1:] for ids in texts), join(ids[:-1] for ids in texts), join(pair_slots(ids) for ids in texts)]
        self.keys, at = np.unique(np.concatenate([np.zeros(1, np.uint64), *tokens]), return_inverse=True)
        self.at = at[1:].reshape(3, -1)

    def counts(self, good: np.ndarray) -> np.ndarray:
        """For each hash the occurrences in good texts and in all, and those less the ones as contexts.

        The first hash, START's, has the number of tokens for its occurrences.
        """
        mine, out = np.repeat(good, self.lengths), []
        for word, context, pair in (self.at[:, mine], self.at):
            words, contexts, pairs = (np.bincount(x, minlength=len(self.keys)) for x in (word, context, pair))
            words[0] = len(word)
            out.append((words + pairs, np.where(words > 0, words - contexts, 0)))
        return np.stack([x[k] for k in (0, 1) for x in out])

    def own(self) -> np.ndarray:
        """For each token how often its word, context and bigram occur in its own text, as rows."""
        which = np.repeat(np.arange(len(self.lengths)), self.lengths) * len(self.keys)
        out = []
        for at in self.at:
            _, place, n = np.unique(which + at, return_inverse=True, return_counts=True)
            out.append(n[place])
        return np.stack(out)

    def losses(self, table: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's mean loss in nats under the target and the background without it; table has the corpus' counts."""
        own, sizes = self.own(), np.repeat(self.lengths, self.lengths).astype(float)
        in_target = np.repeat(good, self.lengths)
        rest = table[1, 0] - sizes  # tokens of all other texts
        if table[0, 0]:
            target = table[0, 0] - np.where(in_target, sizes, 0)
            models = [(table[0], table[2], 1.0, in_target), (table[1], table[3], target / np.maximum(rest, 1), 1)]
        else:
            target, models = rest, [(table[1], table[3], 1.0, 1)] * 2
        word, context, pair = self.at
        some = np.flatnonzero(self.lengths)
        starts = (np.cumsum(self.lengths) - self.lengths)[some]
        out = []
        for counts, last, scale, mine in models:
            single = ((counts[word] - own[0] * mine) * scale + SMOOTH) / (target + SMOOTH * VOCABULARY)
            before = counts[context] - last[context] - own[1] * mine
            double = (counts[pair] - own[2] * mine) / np.maximum(before, 1)
            known = before > 0
            loss = -np.log(np.where(known, MIX * np.minimum(double, 1), 0) + np.where(known, 1 - MIX, 1) * single)
            means = np.zeros(len(self.lengths))
            if len(some):
                means[some] = np.add.reduceat(loss, starts) / self.lengths[some]
            out.append(means)
        return out[0], out[1]


DEALT = "lot long, kind int, id long, size int, range int, data binary"
IDS, TEXT, ANSWER = 0, 2, 1


def _lots(batches: Iterator[pa.RecordBatch], finish) -> Iterator[pa.RecordBatch]:
    """Over rows of DEALT sorted by lot and kind: what finish makes of each lot's ids of texts, word hashes and other rows."""
    words, codec, now, ids, texts, others = Words(), pa.Codec("zstd"), None, [], [], []
    for batch in batches:
        for lot, kind, i, size, part, data in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
            if lot != now:
                if ids:
                    yield finish(now, ids, Lot(texts), others)
                now, ids, texts, others = lot, [], [], []
            if kind == TEXT:
                ids.append(i)
                texts.append(words(codec.decompress(data, size, asbytes=True) if size else b""))
            else:
                others.append((part, size, data, i))
    if ids:
        yield finish(now, ids, Lot(texts), others)


ASKED = "range int, lot long, hashes binary, data binary"


def _asking(ranges: int):
    def finish(lot: int, ids: list, held: Lot, others: list) -> pa.RecordBatch:
        target = {x[3] for x in others}
        counts, cuts = held.counts(np.array([i in target for i in ids], bool)), _cuts(held.keys, ranges)
        out = [(k, lot, _gaps(held.keys[s:e]), _packed(counts[:, s:e])) for k, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if e > s]
        part, lots, hashes, data = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(lots, pa.int64()), pa.array(hashes, pa.binary()), pa.array(data, pa.binary())], ["range", "lot", "hashes", "data"])

    return lambda batches: _lots(batches, finish)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows of ASKED sorted by range: for each row the corpus' counts of its hashes, as rows of DEALT."""

    def answer(part: int, rows: list) -> pa.RecordBatch:
        asked = [_hashes(r[1]) for r in rows]
        keys, at = np.unique(np.concatenate(asked), return_inverse=True)
        sums = np.zeros((4, len(keys)), np.int64)
        places = np.split(at, np.cumsum([len(x) for x in asked])[:-1])
        for place, r in zip(places, rows, strict=True):
            sums[:, place] += _unpacked(r[2]).astype(np.int64)  # a row's hashes are distinct
        packed = [_packed(sums[:, place]) for place in places]
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([ANSWER] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(packed, pa.binary())],
            ["lot", "kind", "id", "size", "range", "data"],
        )

    now, rows = None, []
    for batch in batches:
        for part, *row in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            if part != now:
                if rows:
                    yield answer(now, rows)
                now, rows = part, []
            rows.append(row)
    if rows:
        yield answer(now, rows)


def _scoring(lot: int, ids: list, held: Lot, others: list) -> pa.RecordBatch:
    target = {x[3] for x in others if x[2] is None}
    answers = sorted((x for x in others if x[2] is not None), key=lambda x: x[0])
    table = np.concatenate([_unpacked(x[2]).astype(np.int64) for x in answers], axis=1)
    none = held.lengths == 0
    a, b = held.losses(table, np.array([i is not None and i in target for i in ids], bool))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held.lengths), *(pa.array(x, pa.float64(), mask=none) for x in (a, b, a - b))], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])


def _dealt(docs: DataFrame, id_col: str, text_col: str, lots: int) -> DataFrame:
    """The texts as rows of DEALT, packed; rows of one id meet in one lot, those without an id by their text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            n, texts = batch.num_rows, [x.as_py() or b"" for x in batch.column(2)]
            data = pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())
            sizes = pa.array([len(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([TEXT] * n, pa.int32()), batch.column(1), sizes, pa.nulls(n, pa.int32()), data], ["lot", "kind", "id", "size", "range", "data"])

    text = F.col(text_col).cast("binary").alias("text")
    key = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col).cast("long"))).otherwise(F.xxhash64(text_col))
    return docs.select(F.pmod(key, F.lit(lots)).alias("lot"), F.col(id_col).cast("long").alias("id"), text).mapInArrow(pack, DEALT)


def score(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, target_loss, background_loss, score), one for each row of docs.

    Losses are means per token, score is target_loss - background_loss. Words are separated by ASCII white space and
    compared without ASCII case. Both models leave the text itself out; a repeated row still counts for its equals. Ids
    are taken as whole numbers. Texts without a word, null ones too, have no tokens, null losses and a null score.
    Without any target document both models are the background's and every score is 0. Ids in target that docs
    lacks and null ids are ignored; repeated rows count and are scored each; other columns are not read.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    lots, ranges = max(LOTS, -(-size // LOT)), max(RANGES, -(-size // RANGE))
    texts = _dealt(docs, id_col, text_col, lots)
    ids = target.select(F.col("id").cast("long").alias("id")).where("id is not null").distinct()
    ids = ids.selectExpr(f"pmod(xxhash64(id), {lots}L) as lot", f"{IDS} as kind", "id", "cast(null as int) as size", "cast(null as int) as range", "cast(null as binary) as data")
    asked = texts.unionByName(ids).repartition("lot").sortWithinPartitions("lot", "kind").mapInArrow(_asking(ranges), ASKED)
    answers = asked.repartition("range").sortWithinPartitions("range").mapInArrow(_answers, DEALT)
    schema = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    return texts.unionByName(ids).unionByName(answers).repartition("lot").sortWithinPartitions("lot", "kind").mapInArrow(lambda b: _lots(b, _scoring), schema)
