"""URL filters: allow and block rules, and for the rest a logistic regression on hashed character n-grams.

The model is trained on the driver from a small labelled table (labelled_urls.tsv, or any of at most MAX_LABELLED rows),
without any library: a few hundred sparse rows. Both hosts and paths tell: n-grams of the two have slots of their own. Judging is one projection: host and path are cut into n-grams, each n-gram's hash names a
weight in a constant array, and the weights are summed. Weights are whole numbers of millionths, so sums are exact.
"""

from __future__ import annotations

import hashlib
import json
import math
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed rules of the contract: verdict, host, path.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
SIZES = (3, 4, 5)
SLOTS = 65_536
MAX_LABELLED = 10_000
EPOCHS, RATE, PENALTY = 20, 0.5, 5e-3
#: The labelled table: label (1: unwanted) and URL, made for this purpose; give another to fit and judge where there is one.
LABELS = Path(__file__).with_name("labelled_urls.tsv")


def read_labelled(path: Path = LABELS) -> tuple[tuple[str, int], ...]:
    """(url, label) of a table of tab-separated labels and URLs below a line of names."""
    rows = (line.split("\t", 1) for line in path.read_text(encoding="utf-8").splitlines()[1:])
    return tuple((url, int(y)) for y, url in rows)


LABELLED = read_labelled()


def parts(url: str | None) -> tuple[str, str]:
    """Host and path, as the contract cuts them."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[cut:]
    end = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


def slot(gram: str) -> int:
    return int(hashlib.md5(gram.encode(), usedforsecurity=False).hexdigest()[:4], 16) % SLOTS


def grams(host: str, path: str) -> list[str]:
    """Character n-grams of both, marked by where they come from; the host's ends count as characters."""
    both = (("h", f"^{host}$"), ("p", path))
    return [name + t[i : i + n] for name, t in both for n in SIZES for i in range(len(t) - n + 1)]


@cache
def fit(labelled: tuple[tuple[str, int], ...] = LABELLED) -> tuple[int, tuple[tuple[int, int], ...]]:
    """Bias and (slot, weight) of every slot in use, in millionths. Rows with a null label or URL don't count."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    rows = []
    for url, y in labelled:
        if url is not None and y in (0, 1):
            count: dict[int, int] = {}
            for g in grams(*parts(url)):
                count[slot(g)] = count.get(slot(g), 0) + 1
            norm = math.sqrt(sum(x * x for x in count.values())) or 1.0
            rows.append(({k: x / norm for k, x in count.items()}, y))
    weight: dict[int, float] = {}
    bias = 0.0
    for _ in range(EPOCHS):
        for x, y in rows:
            z = bias + sum(weight.get(k, 0.0) * v for k, v in x.items())
            d = RATE * (y - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            bias += 0.1 * d
            for k, v in x.items():
                weight[k] = weight.get(k, 0.0) * (1 - RATE * PENALTY) + d * v
    typical = sorted(math.sqrt(len(x)) for x, _ in rows)[len(rows) // 2] if rows else 1.0
    return round(bias * 1e6), tuple(sorted((k, round(w / typical * 1e6)) for k, w in weight.items()))


def score(url: str | None, labelled: tuple[tuple[str, int], ...] = LABELLED) -> int:
    bias, weights = fit(labelled)
    by_slot = dict(weights)
    return bias + sum(by_slot.get(slot(g), 0) for g in grams(*parts(url)))


def _slots(name: str, text: Column) -> Column:
    """The slots of a text's n-grams, as an array."""

    def cut(n: int) -> Column:  # the lambda takes one argument only: a second would be the element's place
        grams = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.concat(F.lit(name), F.substr(text, i, F.lit(n))))
        return F.when(F.length(text) >= n, grams).otherwise(F.array().cast("array<string>"))

    each = [cut(n) for n in SIZES]
    return F.transform(F.concat(*each), lambda g: F.conv(F.substring(F.md5(g), 1, 4), 16, 10).cast("int") % SLOTS)


def judge(pages: DataFrame, url_col: str = "url", rules: tuple[tuple[str, str, str], ...] = RULES, labelled: tuple[tuple[str, int], ...] = LABELLED) -> DataFrame:
    """pages with host, path, rule, score and verdict, one row for each row.

    A rule fits its host and all subdomains where the path starts with the rule's; the longest (host and path
    together) wins, the first of equals. Without a rule the verdict is block where the model's score is above
    zero. A null URL or one without :// has an empty host and path; no rule fits it and the model judges it by its
    bias. URLs of any length are judged as a whole; columns of pages are passed on, those of the five names
    replaced; an empty table gives an empty result, repeated rows are judged each.
    """
    bias, weights = fit(labelled)
    dense = [0] * SLOTS
    for k, w in weights:
        dense[k] = w
    cut = lambda k: F.coalesce(F.regexp_extract(url_col, "://([^/?#]*)([^?#]*)", k), F.lit(""))
    host = F.translate(cut(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = pages.withColumns({"host": host, "path": cut(2)})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, f"{h}{p}").otherwise(rule), F.when(fits, kind).otherwise(verdict)
    # one literal after constant folding; as an array of literals the plan would have as many nodes
    table = F.from_json(F.lit(json.dumps(dense, separators=(",", ":"))), "array<bigint>")
    used = F.concat(_slots("h", F.concat(F.lit("^"), F.col("host"), F.lit("$"))), _slots("p", F.col("path")))
    total = F.aggregate(used, F.lit(bias).cast("long"), lambda a, k: a + F.get(table, k))
    return out.withColumns({"rule": rule, "score": total}).withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")))


def oracle(labelled: tuple[tuple[str, int], ...] = LABELLED) -> str:
    """The query in SQL, the model's weights as a table."""
    bias, weights = fit(labelled)
    values = ", ".join(f"({k}, {w})" for k, w in weights)
    cases = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    when = lambda what: " ".join(f"when (cut.host = '{h}' or suffix(cut.host, '.{h}')) and starts_with(cut.path, '{p}') then '{what(k, h, p)}'" for k, h, p in cases)
    grams_of = lambda name, t: " || ".join(f"list_transform(range(1, greatest(length({t}) - {n - 2}, 1)), lambda i: '{name}' || substring({t}, i, {n}))" for n in SIZES)
    return rf"""
with cut as (
  select page_id, url, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path from pages),
hp as (select distinct host, path from cut),
gram as (select host, path, unnest({grams_of("h", "('^' || host || '$')")} || {grams_of("p", "path")}) as g from hp),
weight(k, w) as (values {values}),
model as (
  select host, path, sum(w) as s from gram join weight on ('0x' || substring(md5(g), 1, 4))::int % {SLOTS} = k group by host, path)
select page_id, cut.host, cut.path, case {when(lambda k, h, p: h + p)} end as rule,
       coalesce(case {when(lambda k, h, p: k)} end, case when {bias} + coalesce(s, 0) > 0 then 'block' else 'allow' end) as verdict
from cut left join model on cut.host = model.host and cut.path = model.path
"""
