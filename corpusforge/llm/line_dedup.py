"""Line dedup over overlapping windows of three lines, by DataFrame functions alone.

A window is three consecutive lines of one text. Windows are hashed (128 bits), the first occurrence of each in the
order (doc_id, text hash, line number) is found by one aggregation that combines before the shuffle, and the lines
of every later occurrence are removed; overlapping windows merge in the set of covered positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _hashes(at: str) -> str:
    """Two independent 64-bit hashes of three neighbouring entries of the array h; no entry is null, as hashes skip nulls.

    The second starts from another value, so it isn't a function of the first.
    """
    return f"struct(xxhash64(h[{at}].a, h[{at} + 1].a, h[{at} + 2].a) as w1, xxhash64(7, h[{at}].b, h[{at} + 1].b, h[{at} + 2].b) as w2)"


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, doc_hash, at, w1, w2), one for each window that holds a word."""
    slim = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("doc_hash"), F.split(text_col, "\n").alias("l"))
    slim = slim.where(f"size(l) >= {WINDOW}")
    hashed = slim.select(
        "doc_id", "doc_hash", F.expr(r"transform(l, x -> struct(xxhash64(x) as a, xxhash64(7, x) as b, x rlike '[^\\x20\\x09-\\x0D]' as word))").alias("h")
    )
    at = hashed.select("doc_id", "doc_hash", "h", F.expr(f"explode(sequence(0, size(h) - {WINDOW}))").alias("at"))
    at = at.where("h[at].word or h[at + 1].word or h[at + 2].word")
    return at.select("doc_id", "doc_hash", "at", F.expr(_hashes("at")).alias("w")).select("doc_id", "doc_hash", "at", "w.w1", "w.w2")


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, doc_hash, covered): the sorted line numbers that later occurrences cover, where there are any."""
    windows = line_windows(docs, id_col, text_col)
    place = F.struct("doc_id", "doc_hash", "at")
    repeated = windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = windows.join(repeated, ["w1", "w2"]).where(~place.eqNullSafe(F.col("first")))
    starts = later.groupBy("doc_id", "doc_hash").agg(F.collect_set("at").alias("starts"))
    return starts.select("doc_id", "doc_hash", F.expr("array_sort(array_distinct(flatten(transform(starts, s -> array(s, s + 1, s + 2)))))").alias("covered"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", details: bool = False) -> DataFrame:
    """docs with the covered lines taken out of its text; every row stays, with details also n_lines and n_removed.

    Lines end at \\n only and are compared as they are. Texts of fewer than three lines and null texts have no
    window and stay as they are; windows without any word are no repeats. A text all of whose lines are covered
    becomes empty. Rows that repeat doc_id and text are one document: all keep the same lines. A null doc_id comes
    before all others. Other columns of docs are passed on; details replaces columns of its names.
    """
    key = F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("doc_hash"))
    found = covered_lines(docs, id_col, text_col).select(F.struct("doc_id", "doc_hash").alias("__ld_found"), F.col("covered").alias("__ld_covered"))
    marked = docs.withColumns({"__ld_key": key, "__ld_lines": F.split(text_col, "\n")})
    joined = marked.join(found, F.col("__ld_key").eqNullSafe(F.col("__ld_found")), "left")
    # by hashing, so the time grows with the lines, not with lines times covered ones
    kept = F.array_join(F.expr("transform(array_except(sequence(0, size(__ld_lines) - 1), __ld_covered), i -> __ld_lines[i])"), "\n")
    text = F.when(F.col("__ld_covered").isNull(), F.col(text_col)).otherwise(kept).alias(text_col)
    count = lambda name: F.coalesce(F.when(F.col(name).isNotNull(), F.size(name)), F.lit(0)).cast("long")
    more = {"n_lines": count("__ld_lines"), "n_removed": count("__ld_covered")} if details else {}
    return joined.select(*[text if c == text_col else F.col(c) for c in docs.columns if c not in more], *[c.alias(n) for n, c in more.items()])


ORACLE = r"""
with line as (
  select doc_id, hash(text) as dh, text, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as i
  from (select distinct doc_id, text from documents where text is not null)),
win as (
  select doc_id, text, i, l as a, lead(l) over w as b, lead(l, 2) over w as c from line window w as (partition by doc_id, text order by i)),
full_win as (
  select * from win where c is not null and regexp_matches(a || b || c, '[^\x20\x09-\x0D]')),
ranked as (
  select doc_id, text, i, row_number() over (partition by a, b, c order by doc_id, i) as r from full_win),
gone as (
  select distinct doc_id, text, i + k.k as i from ranked, (values (0), (1), (2)) k(k) where r > 1),
kept as (
  select line.doc_id, line.text, count(*) as n_lines, count(gone.i) as n_removed,
         coalesce(string_agg(line.l, chr(10) order by line.i) filter (gone.i is null), '') as new_text
  from line left join gone on line.doc_id = gone.doc_id and line.text = gone.text and line.i = gone.i group by line.doc_id, line.text)
select d.doc_id, k.new_text as text, coalesce(k.n_lines, 0)::bigint as n_lines, coalesce(k.n_removed, 0)::bigint as n_removed
from documents d left join kept k on d.doc_id = k.doc_id and d.text = k.text
"""
