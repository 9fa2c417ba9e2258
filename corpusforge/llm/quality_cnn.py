"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters run over a chunk's
embedded bytes, each filter's largest answer goes on to a small layer, and mean and maximum over all chunks make
one probability. It is trained on the driver from at most MAX_GOOD and MAX_POOR labelled rows; training, like scoring,
reads every chunk of a text, LOT chunks at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

CHUNK, STEP = 256, 192
EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 6, 8, 2, 24, 16
MAX_GOOD, MAX_POOR = 2500, 1500
EPOCHS, BATCH, RATE, SEED = 8, 32, 4e-3, 7
PLACES = (CHUNK - WIDTH) // STRIDE + 1
WINDOW = np.arange(PLACES)[:, None] * STRIDE + np.arange(WIDTH)[None, :]
#: Chunks that are scored or learnt from at once; bounds the memory whatever the length of a text.
LOT = 512


def n_chunks(size: int) -> int:
    return 1 + max(0, -(-(size - CHUNK) // STEP))


def chunk(data: bytes, which: np.ndarray | range) -> np.ndarray:
    """The chosen chunks of a text, as rows of CHUNK bytes; the last is filled up with zeros."""
    out = np.zeros((len(which), CHUNK), np.uint8)
    for row, k in zip(out, which, strict=True):
        piece = np.frombuffer(data, np.uint8, min(CHUNK, len(data) - k * STEP), k * STEP) if data else data
        row[: len(piece)] = piece if data else 0
    return out


class ByteCNN:
    """Parameters and both passes of the network."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "embed": draw(256, EMBED, scale=0.5), "conv": draw(WIDTH * EMBED, FILTERS, scale=(2 / (WIDTH * EMBED)) ** 0.5), "conv_b": np.zeros(FILTERS, np.float32),
            "mid": draw(FILTERS, HIDDEN, scale=(2 / FILTERS) ** 0.5), "mid_b": np.zeros(HIDDEN, np.float32), "out": draw(2 * HIDDEN, scale=0.2), "out_b": np.zeros(1, np.float32),
        }

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's largest answer in each chunk."""
        p = self.p
        cols = p["embed"][chunks][:, WINDOW].reshape(-1, WIDTH * EMBED)
        return np.maximum((cols @ p["conv"]).reshape(len(chunks), PLACES, FILTERS).max(axis=1) + p["conv_b"], 0)

    def hidden(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.p["mid"] + self.p["mid_b"], 0)

    def scores(self, texts: Iterator[bytes]) -> np.ndarray:
        """One probability for each text, over all its chunks; a few chunks are held at a time."""
        sums, tops, counts, rows, held, owner = [], [], [], 0, [], []

        def flush() -> None:
            if not held:
                return
            h, who = self.hidden(self.pooled(np.concatenate(held))), np.array(owner)
            for i in np.unique(who):
                mine = h[who == i]
                sums[i] += mine.sum(axis=0, dtype=np.float64)
                tops[i] = np.maximum(tops[i], mine.max(axis=0))
            held.clear()
            owner.clear()

        for i, data in enumerate(texts):
            n = n_chunks(len(data))
            sums.append(np.zeros(HIDDEN))
            tops.append(np.zeros(HIDDEN, np.float32))
            counts.append(n)
            for at in range(0, n, LOT):
                part = range(at, min(n, at + LOT))
                held.append(chunk(data, part))
                owner.extend([i] * len(part))
                if len(owner) >= LOT:
                    flush()
            rows += 1
        flush()
        if not rows:
            return np.zeros(0)
        mean = np.array(sums) / np.array(counts)[:, None]
        logit = np.concatenate([mean, np.array(tops)], axis=1) @ self.p["out"].astype(np.float64) + float(self.p["out_b"][0])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _forward(self, chunks: np.ndarray) -> tuple[np.ndarray, ...]:
        """What a lot of chunks gives on the way to the hidden layer: embedded windows, best places, both sums."""
        p = self.p
        cols = p["embed"][chunks][:, WINDOW].reshape(len(chunks), PLACES, WIDTH * EMBED)
        z = (cols.reshape(-1, WIDTH * EMBED) @ p["conv"]).reshape(len(chunks), PLACES, FILTERS)
        best = z.argmax(axis=1)
        pre = np.take_along_axis(z, best[:, None], 1)[:, 0] + p["conv_b"]
        mid = np.maximum(pre, 0) @ p["mid"] + p["mid_b"]
        return cols[np.arange(len(chunks))[:, None], best], best, pre, mid

    def _backward(self, chunks: np.ndarray, passed: tuple[np.ndarray, ...], dh: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of a lot of chunks from those of its hidden layer."""
        p, (seen, best, pre, mid) = self.p, passed
        dmid = dh * (mid > 0)
        dpre = (dmid @ p["mid"].T) * (pre > 0)
        back = (dpre[:, :, None] * p["conv"].T[None]).reshape(-1, EMBED)
        at = chunks[np.arange(len(chunks))[:, None, None], WINDOW[best]].ravel()
        embed = np.stack([np.bincount(at, back[:, k], minlength=256) for k in range(EMBED)], axis=1)
        return {"mid": np.maximum(pre, 0).T @ dmid, "mid_b": dmid.sum(axis=0), "conv_b": dpre.sum(axis=0), "conv": np.einsum("cfk,cf->kf", seen, dpre, optimize=True), "embed": embed}

    def gradients(self, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of some texts, over all their chunks. Where they are more than a lot, lots are passed twice."""
        n, counts = len(texts), np.array([n_chunks(len(t)) for t in texts])
        ends = np.cumsum(counts)
        owner = np.repeat(np.arange(n), counts)
        place = np.arange(ends[-1]) - (ends - counts)[owner]
        lots = [slice(at, at + LOT) for at in range(0, len(owner), LOT)]

        def cut(lot: slice) -> np.ndarray:
            who, where = owner[lot], place[lot]
            return np.concatenate([chunk(texts[i], where[who == i]) for i in np.unique(who)])

        kept = None
        hidden = np.empty((len(owner), HIDDEN), self.p["mid"].dtype)
        for lot in lots:
            chunks = cut(lot)
            passed = self._forward(chunks)
            hidden[lot] = np.maximum(passed[3], 0)
            kept = (chunks, passed)
        p, top, arg = self.p, np.empty((n, HIDDEN), hidden.dtype), np.empty((n, HIDDEN), np.int64)
        for i, (e, c) in enumerate(zip(ends, counts, strict=True)):
            arg[i] = hidden[e - c : e].argmax(axis=0) + e - c
            top[i] = hidden[arg[i], np.arange(HIDDEN)]
        feats = np.concatenate([np.add.reduceat(hidden, ends - counts) / counts[:, None], top], axis=1).astype(hidden.dtype)
        prob = 1 / (1 + np.exp(-np.clip(feats @ p["out"] + p["out_b"][0], -30, 30)))
        d = ((prob - y) / n).astype(hidden.dtype)
        dh = (d[:, None] * p["out"][None, :HIDDEN] / counts[:, None])[owner].astype(hidden.dtype)
        np.add.at(dh, (arg, np.arange(HIDDEN)[None, :]), d[:, None] * p["out"][None, HIDDEN:])
        g = {"out": feats.T @ d, "out_b": d.sum(keepdims=True)}
        for lot in lots:
            chunks, passed = kept if len(lots) == 1 else ((c := cut(lot)), self._forward(c))
            for k, x in self._backward(chunks, passed, dh[lot]).items():
                g[k] = g[k] + x if k in g else x
        return g

    def fit(self, samples: list[tuple[bytes, int]], epochs: int = EPOCHS) -> ByteCNN:
        """Adam over small batches of (text, label), in an order that the seed fixes."""
        rng, m, v, t = np.random.default_rng(SEED), {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        steps = epochs * -(-len(samples) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(samples))
            for at in range(0, len(order), BATCH):
                part = [samples[i] for i in order[at : at + BATCH]]
                g = self.gradients([x for x, _ in part], np.array([y for _, y in part], np.float32))
                t += 1
                rate = RATE * (1 - 0.95 * t / steps)
                for k, x in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.99 * v[k] + 0.01 * x * x
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        return self


class Constant:
    """Where labels of both classes are missing: the smoothed share of label 1."""

    def __init__(self, good: int, poor: int) -> None:
        self.share = (good + 1) / (good + poor + 2)

    def scores(self, texts: Iterator[bytes]) -> np.ndarray:
        return np.array([self.share for _ in texts])


def held_out(id_col: str = "doc_id"):
    """Rows that no model here learns from: crc32 of the id as text leaves 1 after division by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> ByteCNN | Constant:
    """A model from the labelled rows that are not held out: the MAX_GOOD and MAX_POOR with the least hashed ids.

    An id whose labels disagree counts for nothing; of an id's texts the one with the least hash counts.
    """
    y = F.col(label_col).cast("int")
    usable = labels.where(~held_out(id_col) & y.isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.min(y).alias("_y"), F.max(y).alias("_most")).where("_y = _most")
    order = F.xxhash64("_id")
    picked = usable.where("_y = 1").orderBy(order, "_id").limit(MAX_GOOD).unionByName(usable.where("_y = 0").orderBy(order, "_id").limit(MAX_POOR)).select("_id", "_y")
    joined = docs.select(F.col(id_col).alias("_d"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_t")).join(F.broadcast(picked), F.col("_d") == F.col("_id"))
    rows = joined.groupBy(F.col("_id").cast("string").alias("_id"), "_y").agg(F.min_by("_t", F.struct(F.xxhash64("_t"), "_t")).alias("_t")).collect()
    samples = [(bytes(r[2]), r[1]) for r in sorted(rows, key=lambda r: r[0])]
    good = sum(y for _, y in samples)
    if not 0 < good < len(samples):
        return Constant(good, len(samples) - good)
    return ByteCNN().fit(samples)


def score_column(model: ByteCNN | Constant, text_col: str = "text"):
    """A column with each text's score; null texts count as empty ones."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(x.as_py() or b"" for x in texts), pa.float64())

    return score(F.col(text_col).cast("binary"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with its columns and held_out, score (0 to 1) and predicted (1 from 0.5 on), one row for each row.

    Empty and null texts get the score of a chunk of zeros. Without labels of both classes every score is the
    smoothed share of label 1. Null ids are not held out and never learnt from; labels of null ids, null quality
    or ids with both labels are ignored, of an id's texts the one with the least hash is learnt from. Columns of docs
    are passed on, those of the three names replaced.
    """
    model = train(docs, labels, id_col, text_col)
    scored = docs.withColumns({"held_out": held_out(id_col), "score": score_column(model, text_col)})
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, as they are, that the classifier doesn't reject."""
    score = score_column(train(docs, labels, id_col, text_col), text_col)
    return docs.withColumn("__cnn_score", score).where("__cnn_score >= 0.5").drop("__cnn_score")
