"""Verification of a finished corpus: many checks in one scan, each a count of the rows against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import text as T

#: Checks of single texts as patterns that may occur in no text; (?U) where words aren't ASCII only.
FORBIDDEN = {
    "digits": "[0-9]", "percent sign": "%", "nothing said twice in figures": r"\.zero|zero,zero|,zero(?:[^\p{L}]|$)", "small initial": r"^\p{Ll}", "list mark": r"^\s*[•·◦‣▪*+>»]", "dash at the start": "^[-—–]", "dictionary entry": r"^\p{Ll}[\p{Ll}'-]*:\s+\p{Lu}",
    "impossible consonants": "[bcdfgjkpqtvwxz]{4,}", "no final mark": r"\p{L}$", "comma before the last quote": ', "$', "range of percentages": "per cent-", "bare units": r"(?:^|[^\p{L}])[kc]ms(?:[^\p{L}]|$)", "glued heading": r"\p{Lu}{5,}\p{Ll}{2,}", "stage direction": r"^\([^()]{1,80}\)\s+\p{Lu}{3,}\s",
    "glued sentences": r"[a-z]\.\p{Lu}[a-z]", "point between letters": r"\p{Ll}\.\p{Ll}", "grave i or u": "[ìù]", "dots or dashes in a row": r"\.\.\.|--", "empty brackets": r"\(\s*\)|«\s*»", "quotes at the start": r'^"\s*"', "letter thrice": "aaa|bbb|ccc|ddd|eee|fff|ggg|hhh|iii|jjj|kkk|lll|mmm|nnn|ooo|ppp|qqq|rrr|sss|ttt|uuu|vvv|www|xxx|yyy|zzz",
    "comma before a closing mark": r",\s*[)\]»]", "quote between letters": r'\p{Ll}"\p{Ll}', "mark repeated": "[,;:!?]{2,}", "space before a mark": r"\s[,.;:!?]", "zero-width characters": "[\u200b\u200e\u200f\ufeff]", "web address": "https?://|www[.]", "mail address": r"[^\s]+@[^\s]+\.[^\s]+", "page number": r"(?:^|\s)p\. (?:un|dus|tres|quate|cinc|sies|sèt|ueit|nau|dètz|vint|trenta|cent)(?:[^\p{L}]|$)",
}


def text_checks(text: str = "text", most_seconds: float = 30.0, chars: tuple[int, int] = (12, 350)) -> dict[str, Column]:
    """Name and condition of each check of a row; a row against it meets the condition."""
    t = F.col(text)
    count = lambda p: F.regexp_count(t, F.lit(p))
    return {
        "empty text": F.trim(F.coalesce(t, F.lit(""))) == "", "too long when spoken": T.seconds(t) > most_seconds, "too long when spoken slowly": T.seconds(t, T.SPEED_SLOW) > most_seconds, "length in characters": ~F.length(t).between(*chars), "odd number of quotes": count('"') % 2 == 1,
        "brackets without partner": count(r"\(") != count(r"\)"), "all capitals": t.rlike(r"\p{Lu}") & (F.upper(t) == t), **{name: t.rlike(pattern) for name, pattern in FORBIDDEN.items()},
    }


def verify(rows: DataFrame, checks: dict[str, Column], tolerated: dict[str, int] | None = None) -> DataFrame:
    """Rows (check, against, ok): how many rows each check counts, and whether they are no more than tolerated.

    One scan and one aggregation for all checks; a null condition isn't met; an empty table passes all.
    """
    names = list(checks)
    counts = rows.agg(*[F.count_if(F.coalesce(checks[n], F.lit(False))).alias(f"c{k}") for k, n in enumerate(names)])
    each = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{k}").alias("against"), (F.col(f"c{k}") <= (tolerated or {}).get(n, 0)).alias("ok")) for k, n in enumerate(names)])
    return counts.select(F.explode(each).alias("x")).select("x.*")


def verify_tables(rows: DataFrame, key: str, text: str, test: DataFrame | None = None, captured: DataFrame | None = None, traces: list[DataFrame] | None = None) -> DataFrame:
    """Checks between rows and tables: ids and texts that occur twice, texts of a test set, captured ids without a trace, traces without a captured id."""
    from corpusforge.operators import reports
    from corpusforge.operators.dedup import only

    twice = lambda c: rows.groupBy(c).agg(F.count("*").alias("n")).where("n > 1")
    checks = [("ids unique", twice(F.col(key))), ("texts unique", twice(T.dedup_key(text)))]
    if test is not None:
        checks.append(("no test text", only(rows, test, T.dedup_key(text), T.dedup_key("text"))))
    if captured is not None and traces:
        seen = traces[0].select(key)
        for t in traces[1:]:
            seen = seen.unionByName(t.select(key))
        base = lambda t: t.select(F.regexp_replace(F.col(key).cast("string"), r"(-\d{7})-\d+$", "$1").alias("_id")).distinct()
        checks += [("captured ids leave a trace", base(captured).join(base(seen), "_id", "left_anti")), ("traces were captured", base(seen).join(base(captured), "_id", "left_anti"))]
    return reports.audit(checks)
