"""Text functions as columns; all of them stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_map() -> tuple[str, str]:
    """Lower-case Latin letters with marks and the letters without, from Unicode's own decompositions."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if c == c.lower() and len(base) == 1 and base != c:
            pairs.append((c, base))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


MARKED, BARE = _accent_map()
#: The same in capitals, where a letter has a single one.
CAPITALS_MARKED, CAPITALS_BARE = ("".join(x) for x in zip(*((m.upper(), b.upper()) for m, b in zip(MARKED, BARE, strict=True) if len(m.upper()) == 1 and m.upper() != m), strict=True))
WORD = r"[\p{L}]+(?:['’][\p{L}]+)*"
#: Reading speeds in characters a second.
SPEED_READ, SPEED_SPOKEN, SPEED_SLOW = 9.16, 14.7, 11.9
#: Characters that a lookup key turns into spaces.
KEY_PUNCTUATION = ".,;:!¡?¿\"'«»…—–-()[]"
#: Number words that a skeleton masks, accents off.
NUMBER_WORDS = (
    "zero un ua dus dues tres quate cinc sies set ueit nau detz onze dotze tretze catorze quinze setze vint trenta quaranta cinquanta seishanta setanta ueitanta nauanta cent cents mil milion milions coma punt"
).split()


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_accents(x: Column | str) -> Column:
    """Lower case, marks off; combining marks standing alone go too."""
    return F.regexp_replace(F.translate(F.lower(col(x)), MARKED, BARE), r"\p{Mn}", "")


def dedup_key(x: Column | str) -> Column:
    """Equal for texts that differ in case, accents, punctuation or spacing only."""
    return F.trim(F.regexp_replace(F.regexp_replace(strip_accents(x), r"[^\p{L}\p{N}_\s]", ""), r"\s+", " "))


def lookup_key(x: Column | str) -> Column:
    """Key of dictionaries: case and accents off but ñ kept, listed punctuation to spaces."""
    kept = F.translate(F.lower(col(x)), "ñ", "\u0001")
    bare = F.translate(F.regexp_replace(F.translate(kept, MARKED, BARE), r"\p{Mn}", ""), "\u0001" + KEY_PUNCTUATION, "ñ" + " " * len(KEY_PUNCTUATION))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def metric_key(x: Column | str) -> Column:
    """Form that error rates compare: lower case, one apostrophe, other punctuation to spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.translate(F.lower(col(x)), "’", "'"), r"[^\p{L}\p{N}'\s]", " "), r"\s+", " "))


def identity_hash(x: Column | str) -> Column:
    """Twelve hex digits that stand for a text up to its dedup key."""
    return F.substring(F.sha1(dedup_key(x)), 1, 12)


def clean(x: Column | str) -> Column:
    """Reference marks, wiki headings, URLs, addresses and zero-width characters go; quotes and blanks are unified."""
    out = col(x)
    for junk in (r"\[[0-9]+\]", r"==+[^=]*==+", r"https?://[^\s]+", r"[^\s]+@[^\s]+\.[^\s]+", "[\u200b\u200e\u200f\ufeff]"):
        out = F.regexp_replace(out, junk, " ")
    out = F.translate(out, "\u00a0’“”", " '\"\"")
    return F.trim(F.regexp_replace(F.replace(out, F.lit("…"), F.lit("...")), r"[ \t]+", " "))


def words(x: Column | str) -> Column:
    """Runs of letters, apostrophes inside allowed."""
    return F.regexp_extract_all(col(x), F.lit(WORD), F.lit(0))


def n_words(x: Column | str) -> Column:
    return F.regexp_count(col(x), F.lit(r"[^\s]+"))


def seconds(x: Column | str, speed: float = SPEED_SPOKEN) -> Column:
    """Estimated duration of a text when spoken, to hundredths, halves to even."""
    return F.bround(F.length(col(x)) / F.lit(float(speed)), 2)


def skeleton(x: Column | str) -> Column:
    """The dedup key with number words masked; runs of masks become one."""
    masked = F.array_join(F.transform(F.split(dedup_key(x), " "), lambda w: F.when(w.isin(NUMBER_WORDS), "#").otherwise(w)), " ")
    return F.trim(F.regexp_replace(F.regexp_replace(masked, r"#(?:[\s\-e]+#)*", "#"), r"\s+", " "))


def last_word(x: Column | str) -> Column:
    found = F.regexp_extract_all(F.lower(col(x)), F.lit(r"[\p{L}]+"), F.lit(0))
    return F.when(F.size(found) > 0, F.element_at(found, -1)).otherwise("")


def slug(x: Column | str) -> Column:
    """ASCII letters and digits, all else one hyphen; case stays."""
    plain = F.translate(F.translate(col(x), MARKED, BARE), CAPITALS_MARKED, CAPITALS_BARE)
    return F.trim(F.regexp_replace(plain, "[^A-Za-z0-9]+", "-"), F.lit("-"))


def short_id(x: Column | str) -> Column:
    """The slug if it has 12 characters at most, else ten hex digits of the name's hash."""
    s = slug(x)
    return F.when((F.length(s) <= 12) & (s != ""), s).otherwise(F.substring(F.sha1(col(x)), 1, 10))


def is_headline(x: Column | str) -> Column:
    """Three words or more, four fifths of the letters in capitals."""
    letters = F.regexp_count(col(x), F.lit(r"\p{L}"))
    return (n_words(x) >= 3) & (letters > 0) & (F.regexp_count(col(x), F.lit(r"\p{Lu}")) * 10 >= letters * 8)


def misnested(x: Column | str) -> Column:
    """A closing parenthesis before its opening one, or any without a partner."""
    marks = F.split(F.regexp_replace(col(x), r"[^()]", ""), "")
    end = F.aggregate(
        marks,
        F.struct(F.lit(0).alias("open"), F.lit(False).alias("bad")),
        lambda a, c: F.struct(
            (a["open"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("open"), (a["bad"] | ((c == ")") & (a["open"] <= 0))).alias("bad")
        ),
    )
    return end["bad"] | (end["open"] != 0)


def foreign_characters(x: Column | str, alphabet: str) -> Column:
    """Sorted distinct characters outside an alphabet."""
    return F.array_sort(F.array_distinct(F.array_remove(F.split(F.translate(col(x), alphabet, ""), ""), "")))


def is_acronym(word: Column) -> Column:
    """Two letters or more in a part between apostrophes: all capitals, or a capital after the first with small ones."""
    letters = lambda p: F.regexp_replace(p, r"[^\p{L}]", "")
    return F.exists(F.split(word, "['’]"), lambda p: (F.length(letters(p)) >= 2) & (letters(p).rlike(r"^\p{Lu}+$") | (letters(p).rlike(r"^.+\p{Lu}") & letters(p).rlike(r"\p{Ll}"))))


def context(x: Column | str, needle: Column | str, around: int = 70) -> Column:
    """The text around the first place of a needle; null without one."""
    at = F.locate(needle, col(x)) if isinstance(needle, str) else F.expr("0")
    return F.when(at > 0, F.substr(col(x), F.greatest(F.lit(1), at - around), F.length(F.lit(needle)) + 2 * around))


def transcript(x: Column | str) -> Column:
    """Up to the first tab, without marks like [Music]."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.split_part(col(x), F.lit("\t"), F.lit(1)), r"\[[^\]]*\]", " "), r"\s+", " "))


def repair_delimiters(x: Column | str) -> Column:
    """A lone quotation mark and parentheses without a partner are taken out, blanks squeezed."""
    one = F.when(F.regexp_count(col(x), F.lit('"')) == 1, F.replace(col(x), F.lit('"'), F.lit(""))).otherwise(col(x))
    step = lambda opening, closing: lambda a, c: F.struct(
        F.when((c == closing) & (a["open"] == 0), a["text"]).otherwise(F.concat(a["text"], c)).alias("text"),
        F.when(c == opening, a["open"] + 1).when((c == closing) & (a["open"] > 0), a["open"] - 1).otherwise(a["open"]).alias("open"),
    )
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("open"))
    left = F.aggregate(F.split(one, ""), start, step("(", ")"))["text"]
    right = F.reverse(F.aggregate(F.split(F.reverse(left), ""), start, step(")", "("))["text"])
    even = F.regexp_count(one, F.lit(r"\(")) == F.regexp_count(one, F.lit(r"\)"))
    return F.trim(F.regexp_replace(F.when(even, one).otherwise(right), r"\s{2,}", " "))


#: Abbreviations that end no sentence.
ABBREVIATIONS = "sr sra srs dr dra sta st núm pàg pag p fig vs etc aprox".split()
SENTENCE_END = r"(?:(?<=[.!?…])|(?<=[.!?…][\"»')”’]))\s+(?=[\"«'(“‘]?[A-ZÀÁÈÉÍÏÒÓÚÜÇ])"
NO_END = r"(?i)(?:(?U)\b(?:" + "|".join(ABBREVIATIONS) + r")\.|(?-i:\b\p{Lu})\.)$"


def sentences(x: Column | str) -> Column:
    """Sentences of a text: lines are cut at ends of sentences and joined again after abbreviations and initials."""
    lines = F.filter(F.transform(F.split(col(x), "\n"), clean), lambda line: line != "")
    # not F.trim itself, which would take the piece's place for the characters to trim
    cut = F.transform(lines, lambda line: F.filter(F.transform(F.split(line, SENTENCE_END), lambda s: F.trim(s)), lambda s: s != ""))
    joined = F.transform(
        cut,
        lambda parts: F.aggregate(
            parts,
            F.array().cast("array<string>"),
            lambda done, s: F.when((F.size(done) > 0) & F.coalesce(F.get(done, F.size(done) - 1).rlike(NO_END), F.lit(False)), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.concat_ws(" ", F.get(done, F.size(done) - 1), s)))).otherwise(
                F.concat(done, F.array(s))
            ),
        ),
    )
    return F.flatten(joined)


def variants(entity: Column | str) -> Column:
    """Ways in which a right transcript may write an entity, the longest first."""
    base = lookup_key(entity)
    letters = F.replace(base, F.lit(" "), F.lit(""))
    net = F.translate(col(entity), ". ", "")
    spaced = F.array_join(F.split(letters, ""), " ")
    capitals = F.length(net).between(2, 6) & net.rlike(r"\p{Lu}") & ~net.rlike(r"\p{Ll}")
    found = F.when(base == "", F.array().cast("array<string>")).when(capitals, F.array(base, spaced, letters)).when(base.contains(" ") & (F.length(letters) <= 6), F.array(base, letters)).otherwise(F.array(base))
    order = F.transform(F.array_distinct(found), lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))
    return F.transform(F.array_sort(order), lambda s: s["v"])


def strict_hit(entity: Column | str, heard: Column | str) -> Column:
    """Whether some variant stands as whole words in a transcript, silent h or not."""
    t = F.concat(F.lit(" "), lookup_key(heard), F.lit(" "))
    mute = lambda s: F.replace(s, F.lit("h"), F.lit(""))
    around = lambda v: F.concat(F.lit(" "), v, F.lit(" "))
    return F.exists(variants(entity), lambda v: t.contains(around(v)) | ((mute(v) != "") & mute(t).contains(around(mute(v)))))


def rough_sounds(x: Column | str) -> Column:
    """A cheap spelling-to-sound approximation for Spanish; letters said alike get one sign."""
    s = F.translate(F.lower(col(x)), "áéíóúü", "aeiouu")
    s = F.regexp_replace(s, "[^a-zñ ]", "")
    for old, new in (("ch", "C"), ("ll", "Y"), ("qu", "k"), ("gu", "g")):
        s = F.replace(s, F.lit(old), F.lit(new))
    s = F.regexp_replace(s, "c([ei])", "s$1")
    s = F.regexp_replace(F.translate(s, "czv", "ksb"), "g([ei])", "x$1")
    s = F.translate(F.translate(F.translate(s, "jñwh", "xNb"), "y", "i"), "Y", "y")
    return F.regexp_replace(s, r"(.)\1+", "$1")


def reason_label(x: Column | str) -> Column:
    return F.substring_index(col(x), " (", 1)


def json_block(x: Column | str) -> Column:
    """The JSON object inside a model's answer, fenced or not; null without one."""
    found = F.regexp_extract(col(x), r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)
