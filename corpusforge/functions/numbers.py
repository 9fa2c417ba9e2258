"""Number words, ordinals and Roman numerals: plain functions, and columns that look them up in constant arrays."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import col

# The language's number words, months, irregular ordinals, letters' names and units.
UNITS = "zero un dus tres quate cinc sies sèt ueit nau dètz onze dotze tretze catorze quinze setze dètz-e-sèt dètz-e-ueit dètz-e-nau".split()
TENS = "vint trenta quaranta cinquanta seishanta setanta ueitanta nauanta".split()
MONTHS = "gèr hereuèr març abriu mai junh juriòl agost seteme octobre noveme deseme".split()
FIRST, FIRST_FEMININE, SEVENTH = "prumèr", "prumèra", "setau"
LETTERS = {
    "a": "a", "b": "be", "c": "ce", "d": "de", "e": "e", "f": "efa", "g": "ge", "h": "hac", "i": "i", "j": "jota", "k": "ca", "l": "ela", "m": "ema", "n": "ena", "o": "o", "p": "pe", "q": "cu", "r": "erra", "s": "essa",
    "t": "te", "u": "u", "v": "ve", "w": "ve doble", "x": "ics", "y": "i grega", "z": "zeta",
}
UNITS_OF_MEASURE = {
    "kms": "quilomètres", "cms": "centimètres", "km²": "quilomètres quadrats", "km2": "quilomètres quadrats", "m²": "mètres quadrats", "m2": "mètres quadrats", "km/h": "quilomètres per ora", "km": "quilomètres", "cm": "centimètres",
    "mm": "milimètres", "m": "mètres", "kg": "quilograms", "gr": "grams", "ha": "ectàrees", "h": "ores", "min": "minutes", "kW": "quilovats", "MW": "megavats", "W": "vats", "V": "volts", "A": "amperes", "Hz": "hertz",
}
SYMBOLS = (("€", " èuros"), ("$", " dolars"), ("º C", " graus"), ("ºC", " graus"))
ROMAN = (("M", 1000), ("CM", 900), ("D", 500), ("CD", 400), ("C", 100), ("XC", 90), ("L", 50), ("XL", 40), ("X", 10), ("IX", 9), ("V", 5), ("IV", 4), ("I", 1))
SPANISH_UNITS = (
    "cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte veintiuno veintidós veintitrés veinticuatro veinticinco veintiséis veintisiete "
    "veintiocho veintinueve"
).split()
SPANISH_TENS = "treinta cuarenta cincuenta sesenta setenta ochenta noventa".split()
SPANISH_HUNDREDS = "ciento doscientos trescientos cuatrocientos quinientos seiscientos setecientos ochocientos novecientos".split()


def _below_thousand(n: int) -> str:
    hundreds, rest = divmod(n, 100)
    said = [] if not hundreds else ["cent"] if hundreds == 1 else [UNITS[hundreds], "cents"]
    if rest >= 20:
        ten, unit = divmod(rest, 10)
        glue = "-e-" if ten == 2 else " "
        said.append(TENS[ten - 2] + (glue + UNITS[unit] if unit else ""))
    elif rest or not hundreds:
        said.append(UNITS[rest])
    return " ".join(said)


@lru_cache(1)
def small() -> tuple[str, ...]:
    """The words of 0 to 999, by rule."""
    return tuple(_below_thousand(n) for n in range(1000))


def in_words(n: int) -> str | None:
    """A whole number below a thousand million in words; null beyond."""
    if not 0 <= n < 10**9:
        return None
    millions, thousands, rest = n // 10**6, n // 1000 % 1000, n % 1000
    said = []
    if millions:
        said.append("un milion" if millions == 1 else small()[millions] + " milions")
    if thousands:
        said.append("mil" if thousands == 1 else small()[thousands] + " mil")
    if rest or not said:
        said.append(small()[rest])
    return " ".join(said)


def ordinal(n: int, feminine: bool = False) -> str | None:
    said = in_words(n)
    if said is None:
        return None
    if n == 1:
        return FIRST_FEMININE if feminine else FIRST
    form = said[: -len(UNITS[7])] + SEVENTH if said.endswith(UNITS[7]) else said.removesuffix("e") + "au"
    return form + "a" if feminine else form


def to_roman(n: int) -> str:
    out = ""
    for letters, value in ROMAN:
        times, n = divmod(n, value)
        out += letters * times
    return out


@lru_cache(1)
def _romans() -> dict[str, int]:
    return {to_roman(n): n for n in range(1, 4000)}


def roman_value(s: str) -> int | None:
    """The value of a canonical Roman numeral, an ordinal's ending allowed; alone only I and X take one."""
    core = re.fullmatch(r"([IVXLCDM]+)(aua|AUA|au|AU)?", s)
    if not core or core[2] and len(core[1]) == 1 and core[1] not in "IX":
        return None
    return _romans().get(core[1])


def roman_said(s: str) -> str | None:
    n = roman_value(s)
    if n is None:
        return None
    ending = s.lstrip("IVXLCDM").lower()
    return ordinal(n, ending == "aua") if ending else in_words(n)


def words_column(n: Column | str) -> Column:
    """in_words for a column, from an array of 1,000 constants."""
    x = col(n).cast("long")
    said = F.lit(list(small()))
    part = lambda k: F.get(said, k.cast("int"))
    millions, thousands, rest = F.floor(x / 1_000_000), F.floor(x / 1000) % 1000, x % 1000
    words = F.array(
        F.when(millions == 1, "un milion").when(millions > 1, F.concat(part(millions), F.lit(" milions"))),
        F.when(thousands == 1, "mil").when(thousands > 1, F.concat(part(thousands), F.lit(" mil"))),
        F.when((rest > 0) | (x == 0), part(rest)),
    )
    return F.when((x >= 0) & (x < 10**9), F.array_join(words, " "))


def ordinal_column(n: Column | str, feminine: bool = False) -> Column:
    said, x = words_column(n), col(n).cast("long")
    form = F.when(said.endswith(UNITS[7]), F.concat(F.regexp_replace(said, UNITS[7] + "$", ""), F.lit(SEVENTH))).otherwise(F.concat(F.regexp_replace(said, "e$", ""), F.lit("au")))
    return F.when(x == 1, FIRST_FEMININE if feminine else FIRST).otherwise(F.concat(form, F.lit("a")) if feminine else form)


def roman_column(n: Column | str) -> Column:
    """A number below 4,000 as a Roman numeral, digit by digit."""
    x = col(n).cast("int")
    rows = [[to_roman(d * 10**p) if d else "" for d in range(10)] for p in range(3)] + [["", "M", "MM", "MMM"]]
    each = [F.get(F.lit(r), F.floor(x / 10**p).cast("int") % 10) for p, r in enumerate(rows)]
    return F.when((x > 0) & (x < 4000), F.concat(*reversed(each)))


def roman_value_column(s: Column | str) -> Column:
    """The value of a Roman numeral if it is canonical: added up with signs, then written again and compared."""
    values = F.transform(F.split(col(s), ""), lambda c: F.instr(F.lit("IVXLCDM"), c))
    amount = F.lit([0, 1, 5, 10, 50, 100, 500, 1000])
    signed = F.transform(values, lambda v, i: F.get(amount, v) * F.when((i + 1 < F.size(values)) & (F.get(values, i + 1) > v), -1).otherwise(1))
    total = F.aggregate(signed, F.lit(0), lambda a, v: a + v)
    return F.when(col(s).rlike("^[IVXLCDM]+$") & (roman_column(total) == col(s)), total)


def expand_digits(text: str) -> str:
    """Digits, dates, times, prices and units in words.

    One scan: at each place the first kind that fits is taken, in the order telephone, road, ordinal, date, time,
    percentage or range, decimal, whole number; a number may be followed by a symbol or a unit.
    """
    text = re.sub(r"(?<!\d)(\d{1,3}(?:[ \u00a0\u202f.]\d{3})+)(?![\d.]*\d)", lambda m: re.sub(r"\D", "", m[0]), _telephones(text))
    out, at = [], 0
    for m in _NUMBER.finditer(text):
        out.append(text[at : m.start()])
        out.append(_say(m))
        at = m.end()
    said = "".join(out) + text[at:]
    for sign, name in SYMBOLS:
        said = re.sub(r"\s*" + re.escape(sign), name, said)
    said = re.sub(r"\s*%", " per cent", said)
    said = re.sub(r"\bde (?=(?:agost|abriu|octobre)\b)", "d'", said)
    said = _UNIT.sub(lambda m: f"{m[1]} {UNITS_OF_MEASURE[m[2]]}", said)
    return re.sub(r"\s+", " ", said).strip()


def _telephones(text: str) -> str:
    number = r"(?<![\d.])(?:\+34[ \u00a0]?|0034[ \u00a0]?)?(\d{3}[ . ]\d{2}[ . ]\d{2}[ . ]\d{2}|\d{2}[ . ]\d{3}[ . ]\d{2}[ . ]\d{2}|\d{3}[ \u00a0-]\d{6})(?!\.?\d)"
    return re.sub(number, lambda m: " ".join(UNITS[int(c)] for c in m[1] if c.isdigit()), text)


_NUMBER = re.compile(
    r"\b(?P<road>[A-Z]{1,2})-(?P<roadno>\d{1,4})(?![\w-])"
    r"|\b(?P<ord>\d+)\s*(?P<end>aua|au|èra|èr|a|º|ª|er|r|n|t|è|é|éme|ème)\b(?!\w)|\b(?P<deg>\d+)(?=\s*º\s*C)"
    r"|\b(?P<day>\d{1,2})[/.-](?P<month>\d{1,2})[/.-](?P<year>\d{4})\b"
    r"|\b(?P<hour>[01]?\d|2[0-3])[.:](?P<min>[0-5]\d)(?:\s*h\b|\b)(?!\s*[.:]?\d)"
    r"|(?<![\w-])(?P<from>\d+)\s*(?P<pc>%?)\s*[-–—]\s*(?P<to>\d+)(?:\s*%)?(?![\w-])"
    r"|\b(?P<whole>\d+),(?P<part>\d+)"
    r"|(?P<n>\d+)"
)
_UNIT = re.compile(r"\b(" + "|".join(sorted({*UNITS, *TENS, "ua", "dues", "cent", "cents", "mil", "milion", "milions", "mieja", "mieg"}, key=len, reverse=True)) + r")\s*(" + "|".join(sorted(map(re.escape, UNITS_OF_MEASURE), key=len, reverse=True)) + r")(?![a-zà-ú0-9²])")


def _say(m: re.Match[str]) -> str:
    g = m.groupdict()
    number = lambda k: in_words(int(g[k])) if g[k] else None
    if g["road"]:
        return " ".join(LETTERS[c.lower()] for c in g["road"]) + " " + (number("roadno") or g["roadno"])
    if g["ord"]:
        return ordinal(int(g["ord"]), g["end"] in ("a", "aua", "èra")) or m[0]
    if g["deg"]:
        return number("deg") or m[0]
    if g["day"]:
        month = int(g["month"])
        return f"{number('day')} de {MONTHS[month - 1]} de {number('year')}" if 1 <= month <= 12 else m[0]
    if g["hour"]:
        return number("hour") + ("" if int(g["min"]) == 0 else f" e {number('min')}")
    if g["from"]:
        said = f"{number('from')} a {number('to')}"
        return said + " per cent" if g["pc"] or m[0].rstrip().endswith("%") else said
    if g["whole"]:
        return f"{number('whole')} coma {number('part')}"
    n = int(g["n"])
    after = m.string[m.end() : m.end() + 1]
    return (in_words(n) or m[0]) + (" " if after and (after.isalpha()) else "")


def spanish_words(n: int) -> str | None:
    """A whole number below a million million in Spanish words."""
    if not 0 <= n < 10**12:
        return None
    if n < 30:
        return SPANISH_UNITS[n]
    if n < 100:
        ten, unit = divmod(n, 10)
        return SPANISH_TENS[ten - 3] + (f" y {SPANISH_UNITS[unit]}" if unit else "")
    if n < 1000:
        hundreds, rest = divmod(n, 100)
        return "cien" if n == 100 else SPANISH_HUNDREDS[hundreds - 1] + (f" {spanish_words(rest)}" if rest else "")
    size, one, many = (1000, "mil", "mil") if n < 10**6 else (10**6, "un millón", "millones")
    head, rest = divmod(n, size)
    said = one if head == 1 else re.sub(r"veintiuno$", "veintiún", re.sub(r"\buno$", "un", spanish_words(head))) + f" {many}"
    return said + (f" {spanish_words(rest)}" if rest else "")


def expand_digits_spanish(text: str) -> str:
    """Numbers standing alone and four symbols in Spanish words."""
    for pattern, said in ((r"\s*%", " por ciento"), (r"\s*º\s*C\b", " grados Celsius"), (r"\s*km\s*/\s*h\b", " kilómetros por hora"), (r"\s*€", " euros")):
        text = re.sub(pattern, said, text)
    return re.sub(r"(?<!\S)([¿¡(\"'«]*)(\d+)([.,;:!?)\"'»]*)(?!\S)", lambda m: m[1] + (spanish_words(int(m[2])) or m[2]) + m[3], text)
