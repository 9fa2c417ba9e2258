"""Queries over single functions and small operators, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import metrics, rewriting
from corpusforge.functions import text as T
from corpusforge.operators import dictionary, gates, ordering, planner, records, reports
from corpusforge.operators import entities as E
from corpusforge.plans.base import dedup, docs, query, words
from corpusforge.session import table


def part(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part")


# --- texts


@query("select doc_id, md5(strip_accents(lower(text))) as bare from documents")
def bare_letters(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.md5(T.strip_accents("text")).alias("bare"))


@query(r"select doc_id, case when regexp_matches(text, '\p{L}') then regexp_extract(lower(text), '([\p{L}]+)[^\p{L}]*$', 1) else '' end as word from documents")
def last_words(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", T.last_word("text").alias("word"))


_SLUG = "trim(regexp_replace(strip_accents(x), '[^A-Za-z0-9]+', '-', 'g'), '-')"
_NAMED = "select p_partkey, case p_partkey % 3 when 0 then p_name when 1 then 'Çà ' || p_brand || ' É' else p_type end as x from part"


@query(f"with n as ({_NAMED}) select p_partkey, {_SLUG} as slug, case when length({_SLUG}) <= 12 then {_SLUG} else substr(sha1(x), 1, 10) end as short from n")
def name_slugs(spark: SparkSession, sf: str) -> DataFrame:
    x = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("Çà "), "p_brand", F.lit(" É"))).otherwise(F.col("p_type"))
    return part(spark, sf).withColumn("x", x).select("p_partkey", T.slug("x").alias("slug"), T.short_id("x").alias("short"))


@query(
    r"""with t as (select p_partkey, case p_partkey % 3 when 0 then upper(p_name) || ' AND MORE' when 1 then upper(p_name) else p_name || ' IN TOWN' end as x from part)
    select p_partkey, len(regexp_extract_all(x, '[^\s]+')) >= 3 and len(regexp_extract_all(x, '\p{L}')) > 0 and len(regexp_extract_all(x, '\p{Lu}')) * 10 >= 8 * len(regexp_extract_all(x, '\p{L}')) as headline from t"""
)
def headlines(spark: SparkSession, sf: str) -> DataFrame:
    x = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.upper("p_name"), F.lit(" AND MORE"))).when(F.col("p_partkey") % 3 == 1, F.upper("p_name")).otherwise(F.concat("p_name", F.lit(" IN TOWN")))
    return part(spark, sf).select("p_partkey", T.is_headline(x).alias("headline"))


@query(r"select conv_id, turn, trim(regexp_replace(regexp_replace(split_part(text || chr(9) || 'rest', chr(9), 1), '\[[^\]]*\]', ' ', 'g'), '\s+', ' ', 'g')) as said from conversations")
def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.transcript(F.concat("text", F.lit("\trest"))).alias("said"))


@query(r"select item_id, trim(regexp_replace(regexp_replace(replace(lower(text), '’', chr(39)), '[^\p{L}\p{N}''\s]', ' ', 'g'), '\s+', ' ', 'g')) as said from benchmark")
def metric_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("item_id", T.metric_key("text").alias("said"))


@query("select doc_id, case when position('the' in text) > 0 then substr(text, greatest(1, position('the' in text) - 70), 143) end as around from documents")
def contexts(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", T.context("text", "the").alias("around"))


@query("select event_id, case when event_id % 2 = 0 then props end as answer from events")
def fenced_json(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON object inside a fence, and none where there is none."""
    e = table(spark, sf, "events")
    answer = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\n"))).otherwise(F.lit("no object"))
    return e.select("event_id", T.json_block(answer).alias("answer"))


@query("select event_type || '/' || (event_id % 5) as label, count(*) as n from events group by 1")
def reason_labels(spark: SparkSession, sf: str) -> DataFrame:
    reason = F.concat("event_type", F.lit("/"), (F.col("event_id") % 5).cast("string"), F.lit(" ("), F.col("event_id").cast("string"), F.lit(" (x))"))
    return table(spark, sf, "events").groupBy(T.reason_label(reason).alias("label")).agg(F.count("*").alias("n"))


@query("select doc_id, length(text) - length(strip_accents(text)) + len(list_filter(string_split(lower(text), ''), lambda c: strip_accents(c) <> c)) as marks from documents")
def accents(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", E.marks("text").cast("long").alias("marks"))


_OPEN = r"\p{Lu}"


@query(
    f"""with w as (select doc_id, unnest({words('text')}) as w from documents) select doc_id, count(*) filter (regexp_matches(w, '^{_OPEN}')) as capital, count(*) as n from w group by 1"""
)
def capital_shares(spark: SparkSession, sf: str) -> DataFrame:
    w = docs(spark, sf).select("doc_id", F.explode(T.words("text")).alias("w"))
    return w.groupBy("doc_id").agg(F.count_if(F.col("w").rlike(f"^{_OPEN}")).alias("capital"), F.count("*").alias("n"))


# --- guards


_GUARD = "case p_partkey % 5 when 0 then upper(p_name) when 1 then p_name || ' & co' when 2 then 'sphinx ' || p_name when 3 then 'blanca casa' else 'cold pato' end"


@query(
    rf"""with e as (select p_partkey, {_GUARD} as e from part), t as (select *, regexp_extract_all(e, '[\p{{L}}\p{{N}}]+') as t from e)
    select p_partkey, regexp_matches(e, '[%ºª°€$£¥&@#/\\+=<>~^*_|]') or len(list_filter(t, lambda w: length(w) >= 2 and regexp_matches(w, '\p{{Lu}}') and not regexp_matches(w, '\p{{Ll}}'))) > 0
      or len(list_filter(t, lambda w: regexp_matches(lower(w), '^[bcdfghjklmnpqrstvwxyzñ]{{2}}') and not list_contains(string_split('bl br cl cr ch dr fl fr gl gr ll pl pr qu tr tl rr', ' '), substr(lower(w), 1, 2)))) > 0
      or regexp_matches(lower(array_to_string(t, ' ')), '(^|\s)sp|sh|th|ph|wh|[aeiou]ng|rr|ou|ow|ee|oo|[bcdfghjklmnpqrstvwxyz]y($|\s)|w|krasz|sz|cz|tsch|sch') as wanted from t"""
)
def guard_rail(spark: SparkSession, sf: str) -> DataFrame:
    return part(spark, sf).withColumn("e", F.expr(_GUARD)).select("p_partkey", gates.needs_evaluation("e").alias("wanted"))


_RAW = "case p_partkey % 4 when 0 then p_name when 1 then upper(p_name) when 2 then p_name || ' ' else p_type end"


@query(
    rf"""with x as (select p_partkey, trim({_RAW}) as a, trim(p_name) as b from part), l as (select *, regexp_replace(a, '[^\p{{L}}]', '', 'g') as la, regexp_replace(b, '[^\p{{L}}]', '', 'g') as lb from x)
    select p_partkey, a = b or (lower(a) = lower(b) and not (length(la) >= 2 and regexp_matches(la, '\p{{Lu}}') and not regexp_matches(la, '\p{{Ll}}') and not (regexp_matches(lb, '\p{{Lu}}') and not regexp_matches(lb, '\p{{Ll}}')))) as same from l"""
)
def unchanged_spellings(spark: SparkSession, sf: str) -> DataFrame:
    return part(spark, sf).withColumn("raw", F.expr(_RAW)).select("p_partkey", gates.same_spelling("raw", "p_name").alias("same"))


@query("select p_partkey, case when p_partkey % 3 = 0 then null when p_partkey % 3 = 1 then 'sortida_buida' else 'caracters_no_castellans:ß' end as reason from part")
def unsafe_respellings(spark: SparkSession, sf: str) -> DataFrame:
    said = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.lit("  ")).otherwise(F.concat("p_name", F.lit("ß")))
    return part(spark, sf).select("p_partkey", gates.unsafe_respelling("p_name", said).alias("reason"))


@query("select p_partkey, p_partkey % 2 = 0 as hit from part")
def strict_hits(spark: SparkSession, sf: str) -> DataFrame:
    """The name stands as whole words in every second transcript, in the others it is broken up."""
    heard = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("they said "), F.upper("p_name"), F.lit(", and left"))).otherwise(F.concat(F.lit("they said x"), F.replace("p_name", F.lit(" "), F.lit("x ")), F.lit("x")))
    return part(spark, sf).select("p_partkey", T.strict_hit("p_name", heard).alias("hit"))


# --- records


@query("with p as (select p_partkey, string_split(p_name, ' ') as l from part) select case when len(l) > 1 then p_partkey || '-' || k else p_partkey::varchar end as id, l[k] as text from p, lateral (select unnest(range(1, len(l) + 1)) as k)")
def fragment_ids(spark: SparkSession, sf: str) -> DataFrame:
    p = part(spark, sf).select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("text"))
    return records.fragments(p, F.split("text", " ")).select("id", "text")


@query("select 'a/' || doc_id || '.wav' as audio, text, n_chars / 10.0::double as duration, source as speaker, lang as entorn, source as font, doc_id::varchar as id, case when doc_id % 7 = 0 then 'dev' else 'train' end as split from documents")
def training_columns(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf)
    manifest = d.select(
        F.concat(F.lit("a/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("audio"), "text", (F.col("n_chars") / 10).alias("durada_s"), F.col("source").alias("veu_id"), F.col("lang").alias("entorn_id"), F.col("source").alias("font"), F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("doc_id") % 7 == 0, "dev").otherwise("train").alias("split"), F.lit(1).alias("unused"),
    )
    return records.training_view(manifest)


@query("select conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) as label from conversations where trim(text) <> '' and turn % 3 < 2")
def training_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels from the text, from the transcript where the text is blank, and none where both are."""
    c = table(spark, sf, "conversations").withColumn("said", F.when(F.col("turn") % 3 < 2, F.col("text")).otherwise(F.lit(" ")))
    c = c.select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, F.col("said")).otherwise(F.lit("")).alias("text"), F.col("said").alias("transcript"))
    return records.label_text(c).select("conv_id", "turn", "label")


@query("select doc_id, source, substr(text, 1, 300) as text, 3 as step from (select *, row_number() over (partition by source order by doc_id) as n from documents) where n <= 20")
def capped_rejects(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf).select("doc_id", "source", "text")
    return records.rejects(records.capped(d, "source", ["doc_id"], 20).withColumn("reason", F.lit("x")), 3).select("doc_id", "source", "text", "step")


@query("with u as (select p_partkey, p_brand as model, p_size * 1000 as i, p_size * 10 as o from part) select p_brand as model, (sum(p_size * 1000 * 3.0 + p_size * 10 * 15.0) / 1e6)::double as cost from part group by 1")
def call_costs(spark: SparkSession, sf: str) -> DataFrame:
    p = part(spark, sf).select(F.col("p_brand").alias("model"), (F.col("p_size") * 1000).alias("tokens_in"), (F.col("p_size") * 10).alias("tokens_out"))
    prices = p.select("model").distinct().select("model", F.lit(3.0).alias("per_million_in"), F.lit(15.0).alias("per_million_out"))
    totals = p.groupBy("model").agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))
    return records.cost(totals, prices).select("model", "cost")


# --- orders and plans


@query("select p_partkey, p_brand, row_number() over (partition by p_brand order by p_partkey) as round from part")
def turns_of_groups(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.interleave_groups(part(spark, sf), "p_brand", ["p_partkey"]).select("p_partkey", "p_brand", "round")


@query("select s_suppkey, row_number() over (order by (n_regionkey = 4)::int, k, n_regionkey, s_suppkey) - 1 as queue from (select *, row_number() over (partition by n_regionkey order by s_acctbal desc, s_suppkey) as k from supplier join nation on n_nationkey = s_nationkey)")
def speaker_queue(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", "s_acctbal", "n_regionkey")
    return ordering.balanced_queue(s, "n_regionkey", "s_acctbal", "s_suppkey", last=4).select("s_suppkey", "queue")


@query("with p as (select p_partkey, p_size as n, p_partkey % 4 as w from part) select p_partkey, w * (n // 4) + least(w, n % 4) as first, n // 4 + (w < n % 4)::int as size from p")
def equal_parts(spark: SparkSession, sf: str) -> DataFrame:
    first, size = ordering.equal_parts(F.col("p_size"), 4, F.col("p_partkey") % 4)
    return part(spark, sf).select("p_partkey", first.cast("long").alias("first"), size.cast("long").alias("size"))


@query("select event_type, event_id from (select *, row_number() over (partition by event_type order by md5(event_id::varchar), event_id) as n from events) where n <= 5")
def reason_examples(spark: SparkSession, sf: str) -> DataFrame:
    return reports.examples(table(spark, sf, "events"), "event_type", "event_id", 5, F.md5(F.col("event_id").cast("string"))).select("event_type", "event_id")


@query("select p_brand, p_partkey, p_retailprice from (select *, row_number() over (partition by p_brand order by p_retailprice, p_partkey) - 1 as k, count(*) over (partition by p_brand) as n from part) where k = n // 2")
def median_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reports.middle_row(part(spark, sf), ["p_brand"], "p_retailprice", "p_partkey").select("p_brand", "p_partkey", "p_retailprice")


@query("with n as (select p_name as name, any_value(p_name) || ' ' || min(p_type) as long_form from part group by 1), l as (select name, long_form from n union all select long_form, null from n where length(long_form) % 2 = 0) select name from l where long_form is null or long_form not in (select name from l)")
def without_long_forms(spark: SparkSession, sf: str) -> DataFrame:
    n = part(spark, sf).groupBy(F.col("p_name").alias("name")).agg(F.min("p_type").alias("t")).select("name", F.concat_ws(" ", "name", "t").alias("long_form"))
    both = n.unionByName(n.where(F.length("long_form") % 2 == 0).select(F.col("long_form").alias("name"), F.lit(None).cast("string").alias("long_form")))
    return planner.without_long_forms(both).select("name")


@query("select n_name as key, case when n_nationkey % 3 = 0 then 'manual' when n_nationkey % 3 = 1 then 'checked' else 'guessed' end as value from nation")
def first_source_wins(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").withColumnRenamed("n_name", "key")
    given = lambda name, where: n.select("key", F.when(F.expr(where), name).alias("value"))
    return planner.by_sources([given("manual", "n_nationkey % 3 = 0"), given("checked", "n_nationkey % 3 < 2"), given("guessed", "true")], "key", "value")


@query("select lower(p_name) as key, max(p_name) as name, sum(p_size)::bigint as n, array_to_string(list_sort(list(distinct p_brand)), '|') as brands from part group by 1")
def merged_names(spark: SparkSession, sf: str) -> DataFrame:
    p = part(spark, sf).select("p_name", F.col("p_size").cast("long").alias("n"), F.array("p_brand").alias("brands"))
    out = planner.merged_groups(p, "p_name", "n", "brands")
    return out.select("key", F.col("p_name").alias("name"), "n", F.array_join("brands", "|").alias("brands"))


@query("with v as (select distinct label from embeddings), s as (select distinct p_type from part) select p_type as style, label as environment from s, v where lower(p_type) like '%' || chr((97 + label % 26)::int) || '%' or not exists (select 1 from v w where lower(s.p_type) like '%' || chr((97 + w.label % 26)::int) || '%')")
def style_environments(spark: SparkSession, sf: str) -> DataFrame:
    tag = F.chr((97 + F.col("label") % 26).cast("long"))
    environments = table(spark, sf, "embeddings").select("label").distinct().select(F.col("label").alias("id"), F.lit(1.0).alias("weight"), F.array(tag).alias("styles"))
    return planner.compatible(part(spark, sf).select(F.col("p_type").alias("style")), environments).select("style", "environment")


# --- distances


@query("select vec_id, [0.333333::double, 0.666667::double] as share from embeddings")
def softmax(spark: SparkSession, sf: str) -> DataFrame:
    x = F.array(F.col("embedding")[0].cast("double"), F.col("embedding")[0].cast("double") + F.log(F.lit(2.0)))
    return table(spark, sf, "embeddings").select("vec_id", F.transform(metrics.softmax(x), lambda v: F.bround(v, 6)).alias("share"))


@query("select event_id, case when value + 5 < 100 then 'below' when value - 5 > 100 then 'above' else 'open' end as verdict from events")
def verdicts(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    return table(spark, sf, "events").select("event_id", metrics.verdict(v - 5 - 100, v + 5 - 100).alias("verdict"))


# --- dictionaries


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries with repeated keys: spellings in three forms."""
    p = part(spark, sf)
    spelling = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.upper("p_name")).otherwise(F.concat("p_name", F.lit("!")))
    source = F.when(F.col("p_partkey") % 2 == 0, "llm:x").otherwise("hand")
    return p.select(spelling.alias("spelling"), F.col("p_brand").alias("value"), (F.col("p_size") > 25).alias("reviewed"), source.alias("source"), F.col("p_partkey").alias("pos"))


_ENTRIES = "e as (select case p_partkey % 3 when 0 then p_name when 1 then upper(p_name) else p_name || '!' end as spelling, p_brand as value, p_size > 25 as reviewed, case when p_partkey % 2 = 0 then 'llm:x' else 'hand' end as source, p_partkey as pos, lower(p_name) as key from part)"


@query(f"with {_ENTRIES} select key, min_by(spelling, pos) as spelling, min_by(value, pos) as value, min(value) <> max(value) as conflict from e group by key")
def dictionary_index(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.index(entries(spark, sf)).select("key", "spelling", "value", "conflict")


@query(f"with {_ENTRIES} select pos from e where key not in (select lower(p_name) from part where p_size = 7)")
def dictionary_delete(spark: SparkSession, sf: str) -> DataFrame:
    gone = part(spark, sf).where("p_size = 7").select(F.upper("p_name").alias("spelling"))
    return dictionary.delete(entries(spark, sf), gone).select("pos")


@query(f"with {_ENTRIES} select pos from e where key in (select lower(p_name) from part where p_size = 7)")
def dictionary_prune(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.subset(entries(spark, sf), part(spark, sf).where("p_size = 7").select(F.col("p_name").alias("spelling"))).select("pos")


@query(f"with {_ENTRIES} select spelling, value from e where pos % 2 = 0 and pos % 5 <> 0")
def dictionary_overrides(spark: SparkSession, sf: str) -> DataFrame:
    e = entries(spark, sf).withColumns({"state": F.when(F.col("pos") % 2 == 0, dictionary.GIVEN).otherwise(dictionary.KEPT), "value": F.when(F.col("pos") % 5 != 0, F.col("value"))})
    return dictionary.overrides(e)


@query(f"with {_ENTRIES} select pos from e where reviewed or source not like 'llm%' or pos % 3 <> 0")
def dictionary_invalidate(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.invalidate(entries(spark, sf), F.col("pos") % 3 == 0).select("pos")


@query("select p_partkey, case p_partkey % 4 when 0 then true when 1 then false when 2 then false end as wanted, case when p_size > 40 then 'validated' when p_size > 20 then 'review' else 'rejected' end as decision from part")
def dictionary_states(spark: SparkSession, sf: str) -> DataFrame:
    state = F.when(F.col("p_partkey") % 4 == 0, dictionary.WAITING).when(F.col("p_partkey") % 4 == 1, dictionary.KEPT).when(F.col("p_partkey") % 4 == 2, dictionary.GIVEN)
    return part(spark, sf).select("p_partkey", dictionary.needs_value(state).alias("wanted"), dictionary.decision(F.col("p_size") > 20, F.col("p_size") > 40).alias("decision"))


# --- rewriting


@query(
    r"""with t as (select conv_id, turn, replace(lower(text), '·h', '') as t from conversations), d as (select conv_id, turn, replace(replace(t, 'nh', 'ny'), 'lh', 'll') as t from t),
    s as (select conv_id, turn, regexp_replace(regexp_replace(t, '([aeouàèéíòóúïü])sh', '\1ix', 'g'), 'sh', 'x', 'g') as t from d) select conv_id, turn, t as text from s"""
)
def respell_digraphs(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").withColumn("text", F.lower("text"))
    return c.select("conv_id", "turn", rewriting.respell("text", digraphs_only=True).alias("text"))


@query(f"select count(distinct {dedup('text')}) as keys, count(distinct text) as texts from documents")
def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).agg(F.count_distinct(T.dedup_key("text")).alias("keys"), F.count_distinct("text").alias("texts"))
