"""Quality rules: multivariate outliers by the minimum covariance determinant, per language and source.

Every text gives a few counts, from them a vector of transformed statistics. For each group (language and source), each
language and all texts the covariance of least determinant over three quarters of the rows is sought by concentration
steps from a robust start (medians and quartile ranges), and reweighted once. A group's estimate is then drawn towards
its language's, and that towards all texts', the more the fewer texts it has: an estimate from n texts counts n squared, its
parent's SHRINK squared. Vectors are rejected whose Mahalanobis distance exceeds the chi-square quantile.

Every step is one aggregation over all rows: rows are binned by distance, moments are summed per group and bin
(combined before the shuffle), and the bins up to the one that completes the three quarters make the next estimate.
No group is collected or dealt to one task: the estimates are broadcast while their number is at most MAX_GROUPS, which
is counted first, and beyond that joined to salted rows. Statistics are whole multiples of 1/GRID, summed as longs, so
sums are exact in any order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.session import discard, materialize

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
STATS = ("word_length", "symbols", "repeats", "marks", "capitals")
P = len(STATS)
GRID = 1024
#: Share of rows that an estimate is made from.
CORE = 0.75
STEPS = 3
#: Number of texts at which a group's own estimate and its parent's count the same. Squares of the numbers are the
#: weights, so a few texts, which may all be junk, hardly move what they are judged by.
SHRINK = 60
#: Estimates that are broadcast at most (about 250 bytes each); rows of one of more are dealt over SALTS keys.
MAX_GROUPS, SALTS = 50_000, 32
#: Chance of a row of a normal group to be rejected.
ALPHA = 1e-3
#: Added standard deviation of each statistic, below what groups have of their own. Most texts have no symbol and no
#: repeat, so a group's own deviation there is zero; their floors are about the step that one symbol or repeat makes.
FLOOR = (0.01, 0.03, 0.08, 0.01, 0.01)
SPACE = b" \t\n\v\f\r"
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
CAPITALS = bytes(range(65, 91))
CONTINUED = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in windows of three words that occur twice or more, first occurrences included."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    n = len(ids)
    if n < 2_000_000:
        keys = (w[:-2] * n + w[1:-1]) * n + w[2:]
    else:
        pairs = np.unique(w[:-1] * n + w[1:], return_inverse=True)[1]
        keys = pairs[:-1] * n + w[2:]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    marked = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(marked, at, 1)
    np.add.at(marked, at + 3, -1)
    return int((np.cumsum(marked)[:-1] > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, punctuation marks, ASCII capitals."""
    words = text.split()
    chars = len(text.translate(None, SPACE + CONTINUED))
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line.strip(SPACE):
            if line in seen:
                dup += 1
            seen.add(line)
    symbols, marks, capitals = (len(text) - len(text.translate(None, x)) for x in (SYMBOLS, PUNCTUATION, CAPITALS))
    return len(words), chars, symbols, dup, repeated_words(words), marks, capitals


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (doc_id, lang, source, the base counts, s0 ...: transformed statistics in multiples of 1/GRID)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([base_counts(x.as_py() or b"") for x in batch.column(3)], np.int64).reshape(-1, len(names))
            words, chars, symbols, _, repeated, marks, capitals = counts.T.astype(np.float64)
            each = np.maximum(chars, 1)
            stats = [np.log1p(chars / np.maximum(words, 1)), np.sqrt(symbols / each), np.sqrt(repeated / np.maximum(words, 1)), np.sqrt(marks / each), np.sqrt(capitals / each)]
            columns = [pa.array(c) for c in counts.T] + [pa.array(np.round(s * GRID).astype(np.int64)) for s in stats]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *columns], ["doc_id", "lang", "source", *names, *(f"s{i}" for i in range(P))])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("binary").alias("text"))
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{n} long" for n in names) + ", " + ", ".join(f"s{i} long" for i in range(P))
    return slim.mapInArrow(run, schema)


def gamma_share(a: float, x: float) -> float:
    """The regularised lower incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def chi2_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if gamma_share(dof / 2, mid / 2) < q else (low, mid)
    return (low + high) / 2


PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
NAMES = [*(f"m{i}" for i in range(P)), *(f"v{i}_{j}" for i, j in PAIRS)]
PARAMS = "gid string, " + ", ".join(f"{n} double" for n in NAMES)
#: Distances are binned by steps of a hundredth of their logarithm.
BIN = "cast(floor(log1p(d2) * 100) as int)"


def _named(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {n: batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i, n in enumerate(batch.schema.names) if n != "gid"}


def _rows(gid: pa.Array, mean: np.ndarray, square: np.ndarray) -> pa.RecordBatch:
    """Means and a symmetric matrix of each group, as rows of PARAMS."""
    return pa.RecordBatch.from_arrays([gid, *(pa.array(mean[:, i]) for i in range(P)), *(pa.array(square[:, i, j]) for i, j in PAIRS)], ["gid", *NAMES])


def _estimates(scale: float, invert: bool = True):
    """From rows (gid, n, sums and cross sums) to means and covariances, or their inverses with the floor added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = _named(batch)
            n = np.maximum(get["n"], 1)
            mean = np.stack([get[f"t{i}"] / n / GRID for i in range(P)], axis=1)
            cov = np.zeros((len(n), P, P))
            for i, j in PAIRS:
                cov[:, i, j] = cov[:, j, i] = get[f"c{i}_{j}"] / n / GRID**2 - mean[:, i] * mean[:, j]
            cov = cov * scale
            yield _rows(batch.column(batch.schema.get_field_index("gid")), mean, np.linalg.inv(cov + np.diag(np.square(FLOOR))) if invert else cov)

    return run


def _shrunk(shrink: float):
    """From rows (gid, n, n_lang, estimates of the group, of its language l_*, of all a_*) to what rows are judged by."""
    weight = lambda n: (n**2 / (n**2 + shrink**2))[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = _named(batch)
            level = lambda k: np.stack([get[k + n] for n in NAMES], axis=1)
            w = weight(get["n_lang"])
            parent = w * level("l_") + (1 - w) * level("a_")
            w = weight(get["n"])
            both = w * level("") + (1 - w) * parent
            cov = np.zeros((len(both), P, P))
            for k, (i, j) in enumerate(PAIRS):
                cov[:, i, j] = cov[:, j, i] = both[:, P + k]
            yield _rows(batch.column(batch.schema.get_field_index("gid")), both[:, :P], np.linalg.inv(cov + np.diag(np.square(FLOOR))))

    return run


def _distance() -> Column:
    z = [F.col(f"s{i}") / GRID - F.col(f"m{i}") for i in range(P)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + (1 if i == j else 2) * z[i] * z[j] * F.col(f"v{i}_{j}")
    return total.alias("d2")


def _measured(rows: DataFrame, params: DataFrame, few: bool) -> DataFrame:
    """rows with d2. Without the broadcast rows of a group are dealt over many keys."""
    if few:
        return rows.join(F.broadcast(params), "gid").withColumn("d2", _distance())
    salted = rows.withColumn("__salt", F.expr(f"cast(pmod(xxhash64(s0, s1, s2, s3, s4, rand(1)), {SALTS}) as int)"))
    each = params.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(each, ["gid", "__salt"]).drop("__salt").withColumn("d2", _distance())


def _moments() -> list[Column]:
    return [F.count("*").alias("n"), *(F.sum(f"s{i}").alias(f"t{i}") for i in range(P)), *(F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"c{i}_{j}") for i, j in PAIRS)]


def _summed(binned: DataFrame) -> DataFrame:
    names = [c for c in binned.columns if c not in ("gid", "bin", "before", "all")]
    return binned.groupBy("gid").agg(*(F.sum(c).alias(c) for c in names))


def _concentrate(rows: DataFrame, params: DataFrame, few: bool) -> DataFrame:
    """Sums over the bins of least distance that hold the core share of each group's rows."""
    bins = _measured(rows, params, few).groupBy("gid", F.expr(BIN).alias("bin")).agg(*_moments())
    upto = Window.partitionBy("gid").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumns({"before": F.coalesce(F.sum("n").over(upto), F.lit(0)), "all": F.sum("n").over(Window.partitionBy("gid"))})
    return _summed(bins.where(F.col("before") < F.ceil(F.col("all") * CORE)))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each statistic in each group, as diagonal estimates."""
    long = rows.select("gid", F.posexplode(F.array(*[f"s{i}" for i in range(P)])).alias("k", "x"))
    counts = long.groupBy("gid", "k", "x").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("gid", "k").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("gid", "k"))})
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("x")))
    spread = counts.groupBy("gid").pivot("k", list(range(P))).agg(at(0.5).alias("mid"), (at(0.75) - at(0.25)).alias("range"))
    var = lambda i: F.pow(F.col(f"{i}_range") / GRID / 1.349, 2) + FLOOR[i] ** 2
    return spread.select("gid", *[(F.col(f"{i}_mid") / GRID).alias(f"m{i}") for i in range(P)], *[(1 / var(i) if i == j else F.lit(0.0)).alias(f"v{i}_{j}") for i, j in PAIRS])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", max_groups: int = MAX_GROUPS, shrink: float = SHRINK) -> DataFrame:
    """Rows (doc_id, base counts, base_failed, kept, distance), one for each row of docs.

    Words are runs of characters other than the six ASCII white-space characters; a null text has none. base_failed
    texts are not kept and no estimate is made from them; their distance is null. Null languages and sources are
    groups of their own. Ids are taken as whole numbers. Repeated rows count each; other columns are not read; an empty
    table gives an empty result.
    """
    rows = statistics(docs, id_col, text_col, lang_col, source_col)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    named = lambda *c: F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), x), F.lit("-")) for x in c])
    rows = materialize(rows.withColumns({"base_failed": failed, "gid": named("lang", "source")}).drop("source"), "counts")
    usable = rows.where("not base_failed")
    sizes = usable.groupBy("gid", "lang").agg(F.count("*").alias("n")).withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang")))
    sizes = materialize(sizes.select("gid", "n", "n_lang", named("lang").alias("of_lang")), "groups")
    n_groups = sizes.limit(max_groups + 1).count()
    few = n_groups <= max_groups
    # every text counts for its group, its language and all
    sample = usable.select(F.explode(F.array("gid", named("lang"), F.lit(""))).alias("gid"), *(f"s{i}" for i in range(P)))
    params = materialize(_start(sample), "estimate")
    shrunk = CORE / gamma_share((P + 2) / 2, chi2_quantile(CORE, P) / 2)
    for _ in range(STEPS):
        after = materialize(_concentrate(sample, params, few).mapInArrow(_estimates(shrunk), PARAMS), "estimate")
        discard(params)
        params = after
    inner = chi2_quantile(0.975, P)
    once = _measured(sample, params, few).where(F.col("d2") <= inner).groupBy("gid").agg(*_moments())
    wide = 0.975 / gamma_share((P + 2) / 2, inner / 2)
    each = materialize(once.mapInArrow(_estimates(wide, invert=False), PARAMS), "estimate")
    discard(params)
    top = each.where("gid = ''").first()
    of_lang = each.select(F.col("gid").alias("of_lang"), *(F.col(n).alias(f"l_{n}") for n in NAMES))
    joined = sizes.join(each, "gid").join(of_lang, "of_lang").drop("of_lang").withColumns({f"a_{n}": F.lit(float(top[n]) if top else 0.0) for n in NAMES})
    params = materialize(joined.mapInArrow(_shrunk(shrink), PARAMS), "estimate")
    judged = _measured(usable, params, few).withColumn("kept", F.col("d2") <= chi2_quantile(1 - ALPHA, P))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    good = judged.select(*names, "kept", F.col("d2").alias("distance"))
    bad = rows.where("base_failed").select(*names, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return good.unionByName(bad)
