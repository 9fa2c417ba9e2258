"""Queries over text: functions, gates, usage, duplicates and leaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import dedup as D
from corpusforge.operators import gates, lexicon, records, reports
from corpusforge.plans.base import LINES, clean, dedup, docs, half_even, hex_number, lines, query, seconds, words
from corpusforge.session import table

PRIORITY = [f"src{i}" for i in (3, 1, 4, 0, 5)]
RANK = "case source " + " ".join(f"when '{s}' then {i}" for i, s in enumerate(PRIORITY)) + f" else {len(PRIORITY)} end"
# Marks for the tables at hand: function words of English against those of the other languages.
OWN = "the of and to in that is was for it with as be".split()
OTHER = "der die und das den von ist le la les des et en un de el los que y una por".split()


@query("select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents")
def sentence_split_newline(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


_ABBREVIATED = "|".join(T.ABBREVIATIONS)


@query(
    rf"""with l as (select doc_id, unnest(string_split(text, chr(10))) as x, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
    c as (select doc_id, i, {clean('x')} as x from l),
    m as (select doc_id, i, regexp_replace(x, '([.!?…]["»)”’]?)\s+(["«''(“‘]?[A-ZÀÁÈÉÍÏÒÓÚÜÇ])', '\1' || chr(1) || '\2', 'g') as x from c where x <> ''),
    j as (select doc_id, i, regexp_replace(regexp_replace(regexp_replace(x, '((?:^|[^\p{{L}}\p{{N}}_])(?i:{_ABBREVIATED})\.)\x01', '\1 ', 'g'), '((?:^|[^\p{{L}}\p{{N}}_])\p{{Lu}}\.)\x01', '\1 ', 'g'), '((?:^|[^\p{{L}}\p{{N}}_])\p{{Lu}}\.)\x01', '\1 ', 'g') as x from m),
    s as (select doc_id, i, list_filter(list_transform(string_split(x, chr(1)), lambda y: trim(y)), lambda y: y <> '') as p from j),
    f as (select doc_id, flatten(list(p order by i)) as p from s group by doc_id)
    select doc_id, unnest(p) as sentence, generate_subscripts(p, 1) - 1 as pos from f"""
)
def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.posexplode(T.sentences("text")).alias("pos", "sentence"))


@query(f"select doc_id, {clean('text')} as text from documents")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", T.clean("text").alias("text"))


@query(f"select doc_id, {dedup('text')} as key from documents")
def dedup_key(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", T.dedup_key("text").alias("key"))


@query(f"select doc_id, substr(sha1({dedup('text')}), 1, 12) as hash from documents")
def hash_identity(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", T.identity_hash("text").alias("hash"))


@query(f"select doc_id, {seconds('text', 9.16)} as read, {seconds('text')} as spoken, {seconds('text', 11.9)} as slow from documents")
def est_duration(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", T.seconds("text", T.SPEED_READ).alias("read"), T.seconds("text").alias("spoken"), T.seconds("text", T.SPEED_SLOW).alias("slow"))


@query(f"select doc_id, len({words('text')})::bigint as n_words, coalesce(list_last({words('text')}), '') as last from documents")
def tokenise_words(spark: SparkSession, sf: str) -> DataFrame:
    w = T.words("text")
    return docs(spark, sf).select("doc_id", F.size(w).cast("long").alias("n_words"), F.coalesce(F.try_element_at(w, F.lit(-1)), F.lit("")).alias("last"))


@query(
    f"""with {LINES}, n as (select *, row_number() over (partition by source order by doc_id, pos) - 1 as k from line)
    select source || '-' || lpad(k::varchar, 7, '0') as id, doc_id, source, text, len(regexp_extract_all(text, '[^\\s]+'))::int as n_words, length(text)::int as n_chars, {seconds('text')} as seconds, substr(sha1({dedup('text')}), 1, 12) as hash from n"""
)
def sentence_records(spark: SparkSession, sf: str) -> DataFrame:
    return records.numbered(lines(spark, sf), "source", ["doc_id", "pos"]).select("id", "doc_id", "source", "text", "n_words", "n_chars", "seconds", "hash")


_CAPTURE = f"""
c as (select doc_id, pos, source, lang, text as raw, {clean('text')} as text from line),
m as (select *, len(regexp_extract_all(text, '[^\\s]+')) as n, len(regexp_extract_all(text, '"')) as q, len(regexp_extract_all(text, '[(]')) as o, len(regexp_extract_all(text, '[)]')) as p from c),
g as (select *, case when text = '' then 'buida' when regexp_matches(text, '[0-9]') then 'conte xifres' when n < 3 or n > 60 then 'llargada ' || n || ' mots'
  when length(text) < 12 or length(text) > 350 then 'llargada ' || length(text) || ' caracters'
  when not regexp_matches(regexp_replace(text, '["»)\\]''’”]+$', ''), '[.!?]$') then 'sense puntuacio final'
  when q > 1 and q % 2 = 1 then 'cometes o parentesis desaparellats'
  when regexp_matches(text, '\\p{{Lu}}') and upper(text) = text then 'tot majuscules' end as reason from m)"""


@query(f"with {LINES}, {_CAPTURE} select doc_id, pos, reason from g")
def capture_gate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    _, reason = gates.capture_reason("text")
    return lines(spark, sf).select("doc_id", "pos", reason.alias("reason"))


@query(f"with {LINES}, {_CAPTURE} select split_part(coalesce(reason, 'ACCEPTADA'), ' (', 1) as reason, count(*) as n, 100.0::double * count(*) / sum(count(*)) over () as percent from g group by 1")
def reject_report(spark: SparkSession, sf: str) -> DataFrame:
    _, reason = gates.capture_reason("text")
    return reports.reasons(lines(spark, sf).select(reason.alias("reason")))


@query(
    f"""with {LINES}, {_CAPTURE} select source, count(*) as before, count(*) filter (reason is null) as after, 100.0::double * count(*) filter (reason is null) / count(*) as percent,
    {half_even("coalesce(sum(round_even(" + seconds('raw') + " * 100, 0)::bigint) filter (reason is null), 0)::bigint", "3600")} as hours from g group by source"""
)
def retention_by_source(spark: SparkSession, sf: str) -> DataFrame:
    _, reason = gates.capture_reason("text")
    return reports.retention(lines(spark, sf).withColumn("reason", reason))


_TOKENS = "list_filter(regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}_]+'), lambda t: t <> '')"
_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"


@query(
    f"""with {LINES}, t as (select doc_id, pos, {_TOKENS} as t from line),
    s as (select doc_id, pos, len(list_filter(t, lambda x: list_contains({_LIST(OWN)}, x)))::int as strong, len(list_filter(t, lambda x: list_contains({_LIST(OTHER)}, x)))::int - (case when list_contains({_LIST(['la', 'le', 'un'])}, t[1]) then 1 else 0 end) as other from t)
    select doc_id, pos, strong, other, case when other > 0 then 0 else strong end as score from s"""
)
def dialect_score(spark: SparkSession, sf: str) -> DataFrame:
    strong, other = gates.dialect_marks("text", OWN, OTHER, ["la", "le", "un"])
    return lines(spark, sf).select("doc_id", "pos", strong.alias("strong"), other.alias("other")).withColumn("score", F.when(F.col("other") > 0, 0).otherwise(F.col("strong")))


_EDGE_BEFORE, _EDGE_AFTER = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
_PAGES, _TENS = "|".join(gates.PAGE_NUMBERS), "|".join(w for w in gates.PAGE_NUMBERS if w != "un")


def _list(names) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in names) + "]"


def _has(pattern: str, x: str = "t") -> str:
    return f"regexp_matches({x}, '" + pattern.replace("'", "''") + "')"


#: The quality gate in SQL: (label, condition) in the gate's order; look-arounds become the characters that they look at.
_GATE = (
    ("'marca de llista'", _has(gates.LIST_MARK)),
    ("'caracter fora de l''alfabet (' || array_to_string(odd[1:4], '') || ')'", "len(odd) > 0"),
    ("'xifres'", _has("[0-9]")),
    ("'inicial en minuscula'", _has(r"^\p{Ll}")),
    ("'sense puntuacio final'", "not " + _has(r"""[.!?]["»)\]']*$""")),
    ("'acaba en abreviatura'", _has(_EDGE_BEFORE + r"[A-ZÀ-ÜÇ]\.$") + " or " + _has("(?i)" + _EDGE_BEFORE + r"(sr|sra|srs|etc|eca|núm|p|pag|pàg|fig|dr|dra|sta|ibid)\.$")),
    ("'capcalera de pagina'", _has("(?i)" + _EDGE_BEFORE + rf"p\.\s+({_PAGES})" + _EDGE_AFTER)),
    ("'parentesis mal niuats'", "len(depth) > 0 and (list_min(depth) < 0 or depth[-1] <> 0)"),
    ("'consonants impossibles'", _has(gates.CONSONANTS)),
    ("'consonant solta (mot partit)'", _has(r"(^|[^\p{L}\p{N}_'’(])[bcdfghjklmnpqrstvwxzç][^\p{L}\p{N}_'’.)]", "spelt")),
    ("'tot en majuscules'", r"n >= 5 and len(list_filter(regexp_extract_all(t, '[^\s]+'), lambda w: length(w) > 1 and regexp_matches(w, '\p{Lu}') and not regexp_matches(w, '\p{Ll}'))) * 10 >= n * 6"),
    ("'punt sense espai (web, nota al peu, frases enganxades)'", _has(gates.POINT_INSIDE)),
    ("'etiqueta de camp (Mot: Text)'", _has(gates.FIELD_LABEL) + " and not " + _has(rf"^(?:{'|'.join(gates.SPOKEN)})\s*:")),
    ("'inicial en minuscula (dins de cometes)'", _has(r"""^["«'][^\p{L}]*\p{Ll}""")),
    ("'truncada (acaba en preposicio o conjuncio)'", f"list_contains({_list(gates.TRUNCATED)}, reverse(regexp_extract(reverse(low), '^[^\\p{{L}}]*([\\p{{L}}]+(?:''[\\p{{L}}]+)?)', 1)))"),
    ("'apostrof perdut'", _has(r"(^|[^\p{L}\p{N}_'’])(d|l|qu|s)\s+[aeiouàèéíòóú]", "low")),
    ("'cometes desaparellades'", "(length(t) - length(replace(t, '\"', ''))) % 2 = 1"),
    ("'parentesis desaparellats'", "length(replace(t, '(', '')) <> length(replace(t, ')', ''))"),
    ("'enumeracio (' || commas || ' comes en ' || n || ' mots, ' || named || '/' || len(elements) || ' elements propis o numerals)'", "commas >= 4 and commas / greatest(n, 1) > 0.23 and len(elements) >= 5 and named * 10 >= len(elements) * 6"),
    ("'puntuacio repetida'", "regexp_matches(replace(t, '...', ''), '[.,;:!?]{2,}')"),
    ("'apostrof solt'", _has(gates.LOOSE_APOSTROPHE)),
    ("'text duplicat'", "(len(w) > 8 and len(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')))) < len(w) - 7) or coalesce(list_max(map_values(list_histogram(content))), 0) >= 4"),
    ("'mot sense vocals'", _has(r"(^|[^\p{L}\p{N}_'’\-])[bcdfghjklmnpqrstvwxz]{3,}($|[^\p{L}\p{N}_'’\-])")),
    ("'marcador de lletres repetides'", _has(r"\b(?:" + "|".join(f"{c}{{4,}}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ") + r")\b")),
    ("'rang de numerals enganxat'", _has("(?i)" + _EDGE_BEFORE + rf"[a-zà-ú]+-(?:mil|cents?|milions?|{'|'.join(gates.TENS_JOINED)})" + _EDGE_AFTER)),
    ("'rang de percentatges enganxat'", "contains(t, 'per cent-')"),
    ("'milers separats per espai mal expandits'", _has(_EDGE_BEFORE + rf"(?:un|{_TENS}|cents|milions?)(?:-e-[a-zà-ú]+)? zero" + _EDGE_AFTER)),
)
_ALLOWED = (gates.ALPHABET + gates.ALPHABET.replace("ß", "").upper() + gates.MARKS).replace("'", "''")


@query(
    rf"""with {LINES}, a as (select doc_id, pos, text as t, lower(text) as low, len(regexp_extract_all(text, '[^\s]+')) as n, length(text) - length(replace(text, ',', '')) as commas, regexp_replace(text, '[^()]', '', 'g') as marks from line),
    b as materialized (select *, regexp_replace(t, '(^|[^\p{{L}}\p{{N}}_])(ll?etr).{{0,28}}', '\1\2x', 'g') as spelt, {words('low')} as w, list_sort(list_distinct(list_filter(string_split(t, ''), lambda c: not contains('{_ALLOWED}', c)))) as odd, list_filter(string_split(t, ','), lambda e: trim(e) <> '') as elements,
      list_transform(range(1, length(marks) + 1), lambda i: 2 * length(replace(substr(marks, 1, i), ')', '')) - i) as depth from a),
    c as materialized (select *, list_filter(w, lambda x: length(x) >= 6 and not list_contains({_list((*gates.FUNCTION_WORDS, *gates.NUMERALS))}, x)) as content,
      len(list_filter(elements, lambda e: regexp_matches(trim(e), '^\p{{Lu}}') or list_contains({_list(gates.NUMERALS)}, lower(split_part(trim(e), ' ', 1))))) as named from b)
    select doc_id, pos, case {' '.join(f'when {c} then {label}' for label, c in _GATE)} end as reason from c"""
)
def quality_gate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).select("doc_id", "pos", gates.quality_reason("text").alias("reason"))


@query(f"with w as (select unnest({words('text')}) as word from documents) select word, count(*) as n from w where regexp_matches(word, '^\\p{{Ll}}') group by word having count(*) >= 3")
def lexicon_words(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.lexicon(docs(spark, sf), "text")


@query(
    f"""with lex as (select word from (select unnest({words('text')}) as word from documents) where regexp_matches(word, '^\\p{{Ll}}') group by word having count(*) >= 3),
    w as (select doc_id, unnest({words('text')}) as w0 from documents), f as (select doc_id, lower(w0) as word from w)
    select doc_id, count(*) as words, count(*) filter (lex.word is null) as unknown, (count(*) filter (lex.word is null))::double / count(*) as share from f left join lex using (word) group by doc_id"""
)
def oov_ratio(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf)
    return lexicon.unknown_share(d, "doc_id", "text", lexicon.lexicon(d, "text"))


_EACH = f"each as (select doc_id, unnest({words('text')}) as word, generate_subscripts({words('text')}, 1) - 1 as pos from documents)"
_SHORT = r"regexp_matches(regexp_replace(p, '[^\p{L}]', '', 'g'), '^\p{Lu}{2,}$') or (regexp_matches(regexp_replace(p, '[^\p{L}]', '', 'g'), '^.+\p{Lu}') and regexp_matches(p, '\p{Ll}'))"
_ACRONYM = f"list_bool_or(list_transform(regexp_split_to_array(word, '[''’]'), lambda p: {_SHORT}))"


@query(f"with {_EACH} select word, count(*) filter (pos > 0) as inside, count(*) filter (pos = 0) as initial from each where {_ACRONYM} group by word having count(*) filter (pos > 0) >= 2 and count(*) filter (pos > 0) > count(*) filter (pos = 0)")
def acronym_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.acronyms(docs(spark, sf), "doc_id", "text")


@query(
    f"""with {_EACH}, s as (select lower(word) as form, {_ACRONYM} as short, regexp_matches(word, '^\\p{{Lu}}') as up, pos from each)
    select form, count(*) filter (short) as acronym, count(*) filter (up and not short and pos > 0) as name, count(*) filter (not up) as lower from s group by form"""
)
def case_usage(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.usage(docs(spark, sf), "doc_id", "text")


@query(
    f"""with d as materialized (select doc_id, list_distinct({words('lower(text)')}) as ws,
      len(regexp_extract_all(text, '[^\\s]+')) >= 3 and len(regexp_extract_all(text, '\\p{{Lu}}')) * 10 >= 8 * len(regexp_extract_all(text, '\\p{{L}}')) and regexp_matches(text, '\\p{{L}}') as head from documents),
    w as (select doc_id, head, unnest(ws) as word from d), r as (select word, row_number() over (partition by word order by head::int, doc_id) as place, doc_id from w) select word, place, doc_id from r where place <= 2"""
)
def first_two_examples(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.first_examples(docs(spark, sf), "doc_id", "text")


_RANKED = f"r as (select doc_id, source, text, row_number() over w as place, first_value(source) over w as winner from documents window w as (partition by {dedup('text')} order by {RANK}, doc_id))"


@query(f"with {_RANKED} select doc_id, source from r where place = 1")
def dedup_priority(spark: SparkSession, sf: str) -> DataFrame:
    slim = docs(spark, sf).select("doc_id", "source", T.dedup_key("text").alias("k"))
    return D.keep_best(slim, "k", D.priority("source", PRIORITY), ["doc_id"]).select("doc_id", "source")


@query(f"with {_RANKED} select doc_id, source, 'duplicada (es queda la de ' || winner || ')' as reason from r where place > 1")
def dedup_losers(spark: SparkSession, sf: str) -> DataFrame:
    slim = docs(spark, sf).select("doc_id", "source", T.dedup_key("text").alias("k"))
    return D.losers(D.by_priority(slim, "k", D.priority("source", PRIORITY), ["doc_id"])).select("doc_id", "source", "reason")


_NUM = "[" + ", ".join(f"'{w}'" for w in T.NUMBER_WORDS) + "]"
_MASKED = f"array_to_string(list_transform(string_split({dedup('text')}, ' '), lambda w: case when list_contains({_NUM}, w) then '#' else w end), ' ')"
_SKELETON = rf"trim(regexp_replace(regexp_replace({_MASKED}, '#(?:[\s\-e]+#)*', '#', 'g'), '\s+', ' ', 'g'))"


@query(f"with {LINES}, s as (select doc_id, pos, {_SKELETON} as skeleton from line) select doc_id, pos, skeleton from s qualify row_number() over (partition by skeleton order by doc_id, pos) <= 2")
def template_cap(spark: SparkSession, sf: str) -> DataFrame:
    return D.template_cap(lines(spark, sf), "text", ["doc_id", "pos"], 2).select("doc_id", "pos", T.skeleton("text").alias("skeleton"))


@query(f"with {LINES}, b as (select distinct {dedup('t')} as k from (select unnest(string_split(text, chr(10))) as t from benchmark)) select doc_id, pos from line where {dedup('text')} not in (select k from b)")
def test_leak_anti(spark: SparkSession, sf: str) -> DataFrame:
    bench = table(spark, sf, "benchmark").select(F.explode(F.split("text", "\n")).alias("text"))
    return D.without(lines(spark, sf), bench, T.dedup_key("text"), T.dedup_key("text")).select("doc_id", "pos")


@query(f"with {LINES}, b as (select distinct {dedup('t')} as k from (select unnest(string_split(text, chr(10))) as t from benchmark)) select doc_id, pos from line where {dedup('text')} in (select k from b)")
def test_leak_semi(spark: SparkSession, sf: str) -> DataFrame:
    bench = table(spark, sf, "benchmark").select(F.explode(F.split("text", "\n")).alias("text"))
    return D.only(lines(spark, sf), bench, T.dedup_key("text"), T.dedup_key("text")).select("doc_id", "pos")


@query(f"with d as (select doc_id, {dedup('text')} as k from documents), b as (select item_id, {dedup('text')} as k from benchmark) select doc_id, item_id from d join b on contains(' ' || d.k || ' ', ' ' || b.k || ' ')")
def test_leak_contains(spark: SparkSession, sf: str) -> DataFrame:
    return D.containing(docs(spark, sf), table(spark, sf, "benchmark"), "text", "item_id", "text").select("doc_id", "item_id").distinct()


@query(
    f"""select d.doc_id, l.doc_id is not null as corrected, t as text, len(regexp_extract_all(t, '[^\\s]+'))::int as n_words, length(t)::int as n_chars, {seconds('t')} as seconds, substr(sha1({dedup('t')}), 1, 12) as hash
    from (select doc_id, text from documents) d left join labels l using (doc_id), lateral (select case when l.doc_id is null then d.text else d.text || ' corrected' end as t) where coalesce(l.quality, 1) = 1"""
)
def corrections_apply(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf)
    patches = table(spark, sf, "labels").join(d.select("doc_id", F.concat("text", F.lit(" corrected")).alias("new_text")), "doc_id").select(F.col("doc_id").alias("id"), "new_text", (F.col("quality") == 0).alias("remove"))
    out = records.correct(d.select(F.col("doc_id").alias("id"), "text"), patches)
    return out.select(F.col("id").alias("doc_id"), "corrected", "text", "n_words", "n_chars", "seconds", "hash")


@query(
    f"""with s as (select {seconds('text')} as v from documents), e as (select unnest([0, 1, 2, 3]) as bin, unnest([0.0, 30.0, 120.0, 300.0]) as a, unnest([30.0, 120.0, 300.0, 1e18]) as b, unnest(['0-30', '30-120', '120-300', '>=300']) as label)
    select bin, label, count(*) as n, 100.0::double * count(*) / (select count(*) from s) as percent from s join e on v >= a and v < b group by bin, label"""
)
def duration_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reports.histogram(docs(spark, sf).select(T.seconds("text").alias("v")), "v", [0, 30, 120, 300])


@query(
    f"""with m as (select source, length(text) as c, round_even({seconds('text')} * 100, 0)::bigint as s from documents)
    select source, count(*) as n, sum(c)::bigint as chars, {half_even("sum(s)::bigint", "3600")} as hours, {half_even("sum(s)::bigint", "count(*)")} as mean_seconds from m group by rollup (source)"""
)
def corpus_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.summary(docs(spark, sf))


@query(f"select doc_id, case when {hex_number('doc_id::varchar')} % 1000 < 5 then 'dev' else 'train' end as split from documents")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", records.split_of("doc_id").alias("split"))


@query(
    f"""with m as (select doc_id, case when {hex_number('doc_id::varchar')} % 1000 < 100 then 'dev' else 'train' end as s, {dedup('text')} as k from documents)
    select doc_id, case when s = 'train' and k in (select k from m where s = 'dev') then 'exclos' else s end as split from m"""
)
def split_with_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    return records.split_without_leaks(docs(spark, sf), "doc_id", "text", 100).select("doc_id", "split")


@query(
    f"""with {LINES}, s as (select doc_id, lang, source, text, {clean('text')} as c from line),
    g as (select doc_id, lang, source, c from s where c <> '' and not regexp_matches(c, '[0-9]') and len(regexp_extract_all(c, '[^\\s]+')) between 3 and 60 and length(c) between 12 and 350
      and regexp_matches(regexp_replace(c, '["»)\\]''’”]+$', ''), '[.!?]$') and not regexp_matches(c, '["()]') and not (regexp_matches(c, '\\p{{Lu}}') and upper(c) = c)),
    b as (select distinct {dedup('t')} as k from (select unnest(string_split(text, chr(10))) as t from benchmark)),
    r as (select *, row_number() over (partition by {dedup('c')} order by {RANK}, doc_id) as p from g where {dedup('c')} not in (select k from b))
    select lang, source, count(*) as n, sum(length(c))::bigint as chars from r where p = 1 group by lang, source"""
)
def surviving_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Which lines survive cleaning, decontamination and deduplication, by language and source."""
    fixed, reason = gates.capture_reason("text")
    good = lines(spark, sf).withColumns({"reason": reason, "c": fixed}).where(r"reason is null and not (c rlike '[\"()]')")
    bench = table(spark, sf, "benchmark").select(F.explode(F.split("text", "\n")).alias("text"))
    keyed = good.select("doc_id", "lang", "source", F.length("c").alias("chars"), T.dedup_key("c").alias("k"))
    unseen = D.without(keyed, bench, F.col("k"), T.dedup_key("text"))
    kept = D.keep_best(unseen, "k", D.priority("source", PRIORITY), ["doc_id"])
    return kept.groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
