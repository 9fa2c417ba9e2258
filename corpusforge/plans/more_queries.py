"""Queries over pages, dictionaries, plans, signals and streams; most of them beyond SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import boundary, metrics, rewriting, signal
from corpusforge.functions import numbers as N
from corpusforge.functions import text as T
from corpusforge.operators import dictionary, entities, gates, lexicon, planner, records
from corpusforge.operators import ordering as O
from corpusforge.plans.base import docs, hex_number, query, words
from corpusforge.session import shared_dir, table
from corpusforge.sources import readers
from corpusforge.streaming import resume


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


@query("select page_id, list_distinct(regexp_extract_all(html, '(?i)<a\\s[^>]*href\\s*=\\s*[\"'']([^\"'']+)[\"'']', 1)).list_sort() as links from pages")
def html_links(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", F.array_sort(readers.links("html", ".")).alias("links"))


_BODY = "html"
for _tag in readers.DROPPED.split("|"):
    _BODY = rf"regexp_replace({_BODY}, '(?is)<{_tag}\b.*?</{_tag}\s*>', ' ', 'g')"
_CUT = r"regexp_replace(regexp_replace(y, '(?is)(</p\s*>|</article|</body).*$', ''), '<[^>]*>', ' ', 'g')"
for _old, _new in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _CUT = f"replace({_CUT}, '{_old}', '{_new}')"


@query(
    rf"""with s as (select page_id, string_split(regexp_replace({_BODY}, '(?i)<p\b[^>]*>', chr(1), 'g'), chr(1))[2:] as p from pages)
    select page_id, array_to_string(list_filter(list_transform(p, lambda y: trim(regexp_replace({_CUT}, '\s+', ' ', 'g'))), lambda y: y <> ''), chr(10)) as text from s"""
)
def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", F.array_join(readers.paragraphs("html"), "\n").alias("text"))


@query(
    r"""with a as (select page_id, regexp_replace(html, '(?i)</?(?:p|div|br|li|h[1-6]|blockquote|tr)\b[^>]*>', chr(10), 'g') as x from pages),
    b as (select page_id, replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as y from a)
    select page_id, trim(regexp_replace(regexp_replace(y, '[ \t]+', ' ', 'g'), '\s*\n\s*', chr(10), 'g')) as text from b"""
)
def blog_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("page_id", F.substr(readers.blog_post(F.lit(""), "html"), F.lit(3)).alias("text"))


@query("with p as (select page_id, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1) as f, try_cast(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) as bigint) as n from pages) select page_id, case when f <> '' and n < 10000000 then f || '_' || lpad((n // 4000 * 4000)::varchar, 6, '0') || '-' || lpad((n // 4000 * 4000 + 3999)::varchar, 6, '0') end as folder from p")
def clip_folder(spark: SparkSession, sf: str) -> DataFrame:
    part = lambda k: F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", k)
    return pages(spark, sf).select("page_id", records.folder(F.concat(part(1), F.lit("-"), F.lpad(part(2), 7, "0"))).alias("folder"))


@query("select p_brand as spelling, case when count(*) % 2 = 0 then 'sense_canvi' else 'amb_fonetica' end as state, count(*) as n from part group by p_brand")
def dictionary_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the new values equal their spelling and become decisions to keep it."""
    counts = table(spark, sf, "part").groupBy(F.col("p_brand").alias("spelling")).agg(F.count("*").alias("n"))
    old = counts.select("spelling", F.lit("old").alias("value"), F.lit("pendent_fonetica").alias("state"), "n")
    new = counts.select(F.upper("spelling").alias("spelling"), F.when(F.col("n") % 2 == 0, F.upper("spelling")).otherwise("said").alias("value"), F.lit("x").alias("state"), "n")
    return dictionary.upsert_values(old, new).select("spelling", "state", "n")


@query("with o as (select c_custkey as k, c_mktsegment as v, c_acctbal > 5000 as r from customer where c_nationkey < 15), n as (select c_custkey as k, c_name as v from customer where c_acctbal > 2000) select case when n.k is null then 'untouched' when o.k is null then 'new' when o.r then 'protected' when o.v = n.v then 'same' else 'updated' end as outcome, count(*) as n from o full join n using (k) group by 1")
def dictionary_merge(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    name = F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("spelling")
    old = c.where("c_nationkey < 15").select(name, F.col("c_mktsegment").alias("value"), (F.col("c_acctbal") > 5000).alias("reviewed"))
    return dictionary.merge(old, c.where("c_acctbal > 2000").select(name, F.col("c_name").alias("value"), F.lit(False).alias("reviewed")))[1]


@query("select c_custkey, c_name in (select c_name from customer where c_mktsegment = 'BUILDING') as known, case when c_mktsegment = 'BUILDING' then 'x' || c_custkey else c_name end as said from customer")
def dictionary_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    entries = c.where("c_mktsegment = 'BUILDING'").select(F.upper("c_name").alias("spelling"), F.concat(F.lit("x"), F.col("c_custkey").cast("string")).alias("value"))
    return dictionary.lookup(c, "c_name", entries).select("c_custkey", (F.col("said") != F.col("c_name")).alias("known"), "said")


@query(f"with w as (select unnest({words('text')}) as word from documents), c as (select word, count(*) as n from w group by word) select word, n from c where n >= 50 and word not in (select word from w where regexp_matches(word, '^\\p{{Lu}}'))")
def words_to_decide(spark: SparkSession, sf: str) -> DataFrame:
    each = docs(spark, sf).select(F.explode(T.words("text")).alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("n"))
    return lexicon.candidates(counts, each.where(r"word rlike '^\\p{Lu}'"), F.col("n"), 50)


@query("select c_custkey, case when regexp_matches(c_name, '[%ºª°€$£¥&@#/\\\\+=<>~^*_|]') then 'conte_simbol_ambigu' when not regexp_matches(c_name, '\\p{L}') then 'sense_lletres' end as reason from customer")
def roundtrip_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", gates.roundtrip_reason("c_name").alias("reason"))


@query("select part, n from (select case when r < floor(t * 0.9) then 'train' else 'dev' end as part, count(*) as n from (select row_number() over (order by md5(doc_id::varchar), doc_id) - 1 as r, count(*) over () as t from documents) group by 1)")
def ratio_split(spark: SparkSession, sf: str) -> DataFrame:
    return O.hash_ratio_split(docs(spark, sf), "doc_id", 0.9).groupBy("part").agg(F.count("*").alias("n"))


@query("with e as (select distinct p_type as entity from part), s as (select distinct p_brand as style from part), d as (select p_type as entity, p_brand as style, count(*) as n from part group by 1, 2) select entity, style, 30 - coalesce(n, 0) as lacks from e cross join s left join d using (entity, style) where coalesce(n, 0) < 30")
def missing_combinations(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.col("p_type").alias("entity"), F.col("p_brand").alias("style"))
    return planner.missing_combinations(p.select("entity").distinct(), p.select("style").distinct(), p, 30)


@query(
    f"""with t as (select unnest(['say {{}}', 'hear {{}}.']) as template), v as (select unnest(['a', 'b', 'c']) as voice), c as (select unnest(['dry', 'wet']) as condition)
    select n_name as entity, template, voice, condition, replace(template, '{{}}', n_name) as text, ({hex_number("'42|' || condition || '|' || template", 16)} % 2147483648)::bigint as seed from nation, t, v, c"""
)
def measurement_plan(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda name, values: spark.createDataFrame([(v,) for v in values], f"{name} string")
    said = spark.createDataFrame([], "spelling string, value string")
    out = planner.measurements(table(spark, sf, "nation").select(F.col("n_name").alias("entity")), one("template", ["say {}", "hear {}."]), one("voice", "abc"), one("condition", ["dry", "wet"]), said)
    return out.select("entity", "template", "voice", "condition", "text", "seed")


@query()
def plan_full(spark: SparkSession, sf: str) -> DataFrame:
    rows = docs(spark, sf).select(F.col("doc_id").alias("id"), F.col("source").alias("font"), (T.seconds("text") * 100).cast("long").alias("seconds"))
    voices = table(spark, sf, "embeddings").select(F.col("label").cast("string").alias("id")).distinct()
    rooms = spark.createDataFrame([("hall", 1.0, ["src1"]), ("street", 0.5, ["src1", "src2"]), ("studio", 0.3, ["src0"])], "id string, weight double, styles array<string>")
    return planner.plan(rows, voices, rooms, trusted=["src0", "src1"])


@query(
    """with r as (select p_name as entity, sum((p_size > 25)::int)::double / count(*) as rate, avg(p_size) / 50 as distance from part group by 1),
    l as (select distinct upper(p_name) as entity, 10.0::double as priority from part where p_brand = 'Brand#1' union all select entity, 1 + rate + 0.1::double * distance from r where rate >= 0.3)
    select entity, priority from (select *, row_number() over (partition by lower(entity) order by priority desc, entity) as k from l where lower(entity) <> 'small ring') where k = 1"""
)
def candidate_fusion(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    rates = p.groupBy(F.col("p_name").alias("entity")).agg((F.sum((F.col("p_size") > 25).cast("int")) / F.count("*")).alias("rate"), (F.avg("p_size") / 50).alias("distance"))
    return planner.candidates(p.select(F.upper("p_name").alias("entity")).where("p_brand = 'Brand#1'").distinct(), rates, ["small ring"])


@query()
def digit_expansion(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", rewriting.expand_digits("text").alias("text"))


@query()
def long_split(spark: SparkSession, sf: str) -> DataFrame:
    cut = docs(spark, sf).select("doc_id", F.explode(T.sentences("text")).alias("s"))
    return cut.select("doc_id", F.posexplode(rewriting.split_long("s")).alias("pos", "piece"))


@query()
def normalise_full(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", rewriting.normalise("text").alias("text"))


_VOWELS = "aeouàèéíòóúïüAEOUÀÈÉÍÒÓÚÏÜ"
_NEAR = "['u', 'ú', 'o', 'ó', 'U', 'Ú', 'O', 'Ó']"
_FREE = f"not coalesce(list_contains({_NEAR}, c[i - 1]), false) and not coalesce(list_contains({_NEAR}, c[i + 1]), false)"
#: Of words in small and large letters only those that a capital sharp s makes occur in the tables: SS and a small letter.
_RESPELLED = f"""r0 as (select doc_id, i, regexp_replace(replace(text, '·h', ''), '(^|[^\\p{{L}}])SS(\\p{{Ll}})', '\\1Ss\\2', 'g') as t, (length(text) - length(replace(text, '·h', ''))) // 2 as punt_volat_h from source),
    r1 as (select *, replace(replace(replace(t, 'nh', 'ny'), 'NH', 'NY'), 'Nh', 'Ny') as t1, len(regexp_extract_all(t, 'nh|NH|Nh')) as nh from r0),
    r2 as (select *, replace(replace(replace(t1, 'lh', 'll'), 'LH', 'LL'), 'Lh', 'Ll') as t2, len(regexp_extract_all(t1, 'lh|LH|Lh')) as lh from r1),
    r3 as (select *, replace(replace(replace(regexp_replace(regexp_replace(t2, '([{_VOWELS}])sh', '\\1ix', 'g'), '([{_VOWELS}])SH', '\\1IX', 'g'), 'sh', 'x'), 'SH', 'X'), 'Sh', 'X') as t3, len(regexp_extract_all(t2, 'sh|SH|Sh')) as sh from r2),
    r4 as materialized (select *, string_split(t3, '') as c from r3),
    r5 as (select *, list_transform(range(1, len(c) + 1), lambda i: list_contains(['o', 'ó', 'O', 'Ó'], c[i]) and {_FREE}) as hit from r4),
    respelled as (select doc_id, i, array_to_string(list_transform(range(1, len(c) + 1), lambda i: case when hit[i] then translate(c[i], 'oóOÓ', 'uúUÚ') else c[i] end), '') as text, lh, nh, sh, punt_volat_h,
      len(list_filter(hit, lambda h: h)) as o_a_u, len(list_filter(c, lambda x: list_contains(['o', 'ó', 'O', 'Ó'], x))) - len(list_filter(hit, lambda h: h)) as ou_sense_tocar from r5)"""
_RULES = "lh nh o_a_u ou_sense_tocar punt_volat_h sh".split()


_WHOLE = "source as (select doc_id, 0 as i, text from documents)"
_TOKENS = r"source as (select doc_id, unnest(t) as text, generate_subscripts(t, 1) as i from (select doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') as t from documents))"


@query(f"with {_WHOLE}, {_RESPELLED} select doc_id, text, '{{' || array_to_string(list_filter([{', '.join(f"case when {r} > 0 then '{chr(34)}{r}{chr(34)}:' || {r} end" for r in _RULES)}], lambda x: x is not null), ',') || '}}' as rules from respelled")
def respell(spark: SparkSession, sf: str) -> DataFrame:
    done = rewriting.respell_counted(docs(spark, sf).select("doc_id", "text"), "text")
    return done.select("doc_id", F.col("respelled").alias("text"), F.to_json(F.map_from_entries(F.array_sort(F.map_entries("rules")))).alias("rules"))


@query(f"with {_WHOLE}, {_RESPELLED} select rule, sum(n)::bigint as n from ({' union all '.join(f"select '{r}' as rule, {r} as n from respelled" for r in _RULES)}) where n > 0 group by rule")
def rule_totals(spark: SparkSession, sf: str) -> DataFrame:
    done = rewriting.respell_counted(docs(spark, sf).select("text"), "text").select(F.explode_outer("rules").alias("rule", "n")).where("rule is not null")  # outer, or the rules are taken twice
    return done.groupBy("rule").agg(F.sum("n").alias("n"))


@query(f"with {_TOKENS}, {_RESPELLED} select doc_id, coalesce(string_agg(case when s.text in ('The', 'shore', 'Don') then s.text else r.text end, '' order by i), '') as text from source s join respelled r using (doc_id, i) group by doc_id")
def protected_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    keep = {"The": "The", "shore": "shore", "Don": "Don"}
    return docs(spark, sf).select("doc_id", rewriting.protected_respell("text", keep).alias("text"))


@query()
def dict_substitute(spark: SparkSession, sf: str) -> DataFrame:
    put = rewriting.substitute_column({"the": "ze", "of a": "ova", "Und": "unt"})
    return docs(spark, sf).select("doc_id", put("text").alias("s")).select("doc_id", "s.text", F.size("s.applied").alias("n"))


@query()
def signal_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of signals made from the vectors: each repeated to one second."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("k"), F.flatten(F.array_repeat("embedding", 250)).alias("x"))
    out = signal.measured(e, "k", "x")
    return out.withColumns({"reason": gates.clip_reason(), "score": signal.quality_score(), "clip_score": signal.clip_score()})


@query()
def snr_mix(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", F.flatten(F.array_repeat("embedding", 50)).alias("x"), records.stable_seed("vec_id").alias("s"))
    out = signal.simulated(e, "vec_id", "x", "s", {"rt60": 0.3, "snr_db": (10, 20), "channel": "telephone", "level_db": (-26, -20)})
    return out.select("key", F.size("samples").alias("n"), "snr_db", "level_db")


@query()
def word_regions(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "benchmark").select("item_id", T.metric_key("text").alias("r"))
    heard = F.array_join(F.filter(F.split("r", " "), lambda w, i: i % 7 != 3), " ")
    return b.select("item_id", F.explode(metrics.regions("r", heard)).alias("g")).select("item_id", F.array_join("g.ref", " ").alias("ref"), F.array_join("g.heard", " ").alias("heard"))


@query()
def model_calls(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "benchmark")
    cache = b.where("text like '%,%'").select(boundary.cache_key("stub", "text").alias("key"), F.lit("kept").alias("answer"))
    return boundary.ask_cached(b, "text", "stub", boundary.retried(boundary.stub(["name", "word", "acronym"])), cache)


@query("select event_type, count(*) as n, min(event_id) as first, max(event_id) as last from events group by event_type")
def resumable_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the events: the second finds nothing new; counts are those of the batch."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = table(spark, sf, "events")
    # the first file of the source; streams read folders
    rows.write.parquet(f"{base}/in")
    for _ in range(2):
        resume.process_new(spark, f"{base}/in", rows.schema.simpleString()[7:-1].replace(":", " "), f"{base}/out", f"{base}/state", lambda x: x.select("event_id", "event_type"), "event_id")
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query("select date_trunc('hour', ts) as start, date_trunc('hour', ts) + interval 1 hour as \"end\", event_type, count(*) as n from events group by all")
def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    return resume.windowed_counts(table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type").select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "n")


@query("select n, said from (select unnest([0, 7, 21, 100, 145, 2000, 21000]) as n, unnest(['cero', 'siete', 'veintiuno', 'cien', 'ciento cuarenta y cinco', 'dos mil', 'veintiún mil']) as said)")
def spanish_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(n, N.spanish_words(n)) for n in (0, 7, 21, 100, 145, 2000, 21000)], "n int, said string")


@query()
def capital_runs(spark: SparkSession, sf: str) -> DataFrame:
    return entities.runs(docs(spark, sf), "text")


@query()
def entity_funnel(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf)
    use = lexicon.usage(d, "doc_id", "text").select("form", F.col("name").alias("upper"), "lower")
    b = table(spark, sf, "benchmark").select(F.explode(F.split(T.metric_key("text"), " ")).alias("fragment")).where("length(fragment) > 4")
    errors = b.groupBy("fragment").agg(F.count("*").alias("n")).withColumn("variant", F.concat(F.substring("fragment", 1, 4), F.lit("x"), F.substr("fragment", F.lit(6), F.length("fragment"))))
    return entities.funnel(errors, entities.runs(d, "text"), use)


@query("select p_partkey, case when lower(p_name) = lower(x) then 'solo_mayusculas' when contains(' ' || lower(p_name) || ' ', ' ' || lower(x) || ' ') then 'expansion' else 'grafia_distinta' end as kind from (select p_partkey, p_name, case p_partkey % 3 when 0 then upper(p_name) when 1 then split_part(p_name, ' ', 2) else p_type end as x from part)")
def change_kinds(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    x = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).when(F.col("p_partkey") % 3 == 1, F.split_part("p_name", F.lit(" "), F.lit(2))).otherwise(F.col("p_type"))
    return p.withColumn("x", x).select("p_partkey", entities.change_kind("p_name", "x").alias("kind"))
