"""What the queries share: tables, lines of documents, and SQL for the text functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query by its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (doc_id, lang, source, pos, text): the lines of documents that aren't blank, as they are."""
    each = docs(spark, sf_dir).select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return each.where("trim(text) <> ''")


LINES = """line0 as (select doc_id, lang, source, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
line as (select * from line0 where trim(text) <> '')"""
WORDS = r"[\p{L}]+(?:[''’][\p{L}]+)*"


def dedup(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(strip_accents(lower({x})), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"


def words(x: str) -> str:
    return rf"regexp_extract_all({x}, '{WORDS}')"


def seconds(x: str, speed: float = 14.7) -> str:
    return f"round_even(length({x}) / {speed}::double, 2)"


def hex_number(x: str, digits: int = 8) -> str:
    return f"('0x' || substr(sha256({x}), 1, {digits}))::ubigint"


def clean(x: str) -> str:
    for junk in (r"\[[0-9]+\]", r"==+[^=]*==+", r"https?://[^\s]+", r"[^\s]+@[^\s]+\.[^\s]+", r"[\x{200b}\x{200e}\x{200f}\x{feff}]"):
        x = f"regexp_replace({x}, '{junk}', ' ', 'g')"
    return f"trim(regexp_replace(replace(translate({x}, chr(160) || '’“”', ' ' || chr(39) || '\"\"'), '…', '...'), '[ \\t]+', ' ', 'g'))"


def half_even(amount: str, by: str) -> str:
    """A whole amount over a whole number, to the nearest, halves to even, as hundredths."""
    return f"(({amount}) // ({by}) + case when 2 * (({amount}) % ({by})) > ({by}) then 1 when 2 * (({amount}) % ({by})) = ({by}) then (({amount}) // ({by})) % 2 else 0 end)::double / 100"
