"""Queries over the verification of a corpus and the small steps of studies and training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import boundary
from corpusforge.operators import gates, prefix, records, study, verification
from corpusforge.plans.base import LINES, dedup, docs, lines, query, seconds
from corpusforge.session import shared_dir, table


def _sql(text: str) -> str:
    return text.replace("'", "''").replace("\u200b", "\\x{200b}").replace("\u200e", "\\x{200e}").replace("\u200f", "\\x{200f}").replace("\ufeff", "\\x{feff}")


_CHECKS = {
    "empty text": "trim(text) = ''", "too long when spoken": f"{seconds('text')} > 30", "too long when spoken slowly": f"{seconds('text', 11.9)} > 30", "length in characters": "not (length(text) between 12 and 350)", "odd number of quotes": "(length(text) - length(replace(text, '\"', ''))) % 2 = 1",
    "brackets without partner": "length(replace(text, '(', '')) <> length(replace(text, ')', ''))", "all capitals": "regexp_matches(text, '\\p{Lu}') and upper(text) = text", **{name: f"regexp_matches(text, '{_sql(pattern)}')" for name, pattern in verification.FORBIDDEN.items()},
}


@query(f"with {LINES}, c as (select {', '.join(f'count(*) filter ({c}) as c{k}' for k, c in enumerate(_CHECKS.values()))} from line) " + " union all ".join(f"select '{n}' as \"check\", c{k} as against, c{k} = 0 as ok from c" for k, n in enumerate(_CHECKS)))
def corpus_verification(spark: SparkSession, sf: str) -> DataFrame:
    """Every check of single texts over all lines, in one scan."""
    return verification.verify(lines(spark, sf), verification.text_checks())


@query(
    f"""with k as (select {dedup('text')} as k from documents), b as (select distinct {dedup('text')} as k from benchmark), c as (
    select 'ids unique' as "check", (select count(*) from (select doc_id from documents group by 1 having count(*) > 1)) as against
    union all select 'texts unique', (select count(*) from (select k from k group by k having count(*) > 1))
    union all select 'no test text', (select count(*) from k where k in (select k from b))
    union all select 'captured ids leave a trace', (select count(*) from documents where doc_id % 5 = 4)
    union all select 'traces were captured', 0)
    select "check", against, against = 0 as ok from c"""
)
def table_verification(spark: SparkSession, sf: str) -> DataFrame:
    """Checks between tables; a fifth of the captured documents has neither been kept nor rejected."""
    d = docs(spark, sf)
    return verification.verify_tables(d, "doc_id", "text", table(spark, sf, "benchmark"), d, [d.where("doc_id % 5 < 3"), d.where("doc_id % 5 = 3")])


@query("select p_partkey, case p_size % 4 when 0 then 'female' when 1 then 'male' else 'unknown' end as gender from part")
def canonical_values(spark: SparkSession, sf: str) -> DataFrame:
    said = F.when(F.col("p_size") % 4 == 0, " F ").when(F.col("p_size") % 4 == 1, "Male").when(F.col("p_size") % 4 == 2, "other")
    return table(spark, sf, "part").select("p_partkey", study.canonical(said, {"f": "female", "female": "female", "m": "male", "male": "male"}, "unknown").alias("gender"))


@query("select event_id, case when user_id % 3 <> 0 then value / (user_id % 3) end as ratio from events")
def ratios(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", study.ratio("value", F.col("user_id") % 3).alias("ratio"))


@query("select doc_id from documents where contains(strip_accents(lower(text)), 'schen') or contains(strip_accents(lower(text)), 'cion')")
def keyword_filter(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).where(study.mentions_any("text", ["schen", "cion"])).select("doc_id")


@query("select doc_id, coalesce(quality, -1) as quality, coalesce(toxic, 0) as toxic from documents left join labels using (doc_id)")
def joined_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return study.with_defaults(docs(spark, sf).select("doc_id"), table(spark, sf, "labels"), "doc_id", {"quality": -1, "toxic": 0})


@query("select s_suppkey from (select *, 'a' || (s_nationkey % 4) as accent, s_acctbal / 100 as snr_db, s_suppkey % 3 as transients from supplier) where accent in ('a0', 'a2') and snr_db >= 45 and transients = 0")
def reserved_voices(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("a"), (F.col("s_nationkey") % 4).cast("string")).alias("accent"), (F.col("s_acctbal") / 100).alias("snr_db"), (F.col("s_suppkey") % 3).alias("transients"))
    return study.reserved_voices(v, ["a0", "a2"]).select("s_suppkey")


@query("with r as (select p_brand as item, p_type as condition, (p_size % 8) / 8.0::double as rate from part where p_brand in ('Brand#1', 'Brand#2')) select condition, avg(rate) as mean, count(*) as n from r group by rollup (condition)")
def anchor_calibration(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "part").select(F.col("p_brand").alias("item"), F.col("p_type").alias("condition"), (F.col("p_size") % 8 / 8).alias("rate"))
    return study.anchor_rates(r, r.where("item in ('Brand#1', 'Brand#2')").select("item"))


@query("select l_partkey, count(distinct l_orderkey) as documents from lineitem group by 1")
def documents_of_items(spark: SparkSession, sf: str) -> DataFrame:
    return study.documents_of(table(spark, sf, "lineitem"), "l_partkey", "l_orderkey")


@query("select user_id, count(*) as clips, sum(value::decimal(28,4))::double as seconds from (select *, row_number() over (partition by user_id order by event_id) as k from events) where k <= 5 group by 1 order by 1 limit 10")
def speaker_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return study.speaker_profiles(table(spark, sf, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", 5, 10)


@query(f"with d as (select source, lang, {dedup('text')} as k from documents), c as (select source, lang, count(*) as n from d group by all) select source, string_agg(lang || ':' || n, ' ' order by lang) as splits, sum(n)::bigint as clips, (select count(distinct k) from d where d.source = c.source) as texts from c group by source")
def speakers_across_splits(spark: SparkSession, sf: str) -> DataFrame:
    out = study.speakers_across(docs(spark, sf), "source", "lang", "text")
    return out.select("source", F.array_join(F.transform("splits", lambda s: F.concat_ws(":", s["split"], s["n"].cast("string"))), " ").alias("splits"), "clips", "texts")


@query("select p_partkey from part where p_partkey % 2 = 1 and p_size <= 25 and p_brand <> 'Brand#3' and lower(p_name) not in (select lower(p_name) from part where p_partkey % 2 = 0 or p_brand = 'Brand#3')")
def orphan_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries that are neither active (even keys) nor typed (one brand) nor reviewed."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("spelling"), (F.col("p_size") > 25).alias("reviewed"), "p_brand")
    return study.without_orphans(p, p.where("p_partkey % 2 = 0"), p.where("p_brand = 'Brand#3'"))[1].select("p_partkey")


@query("select p_partkey, (len(string_split(p_name, 'e')))::double / length(replace(p_name, ' ', '')) as fragmentation, greatest(length(p_type) - length(replace(p_type, 'E', '')) - (length(p_name) - length(replace(p_name, 'E', ''))), 0) as extra from part")
def token_shares(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", study.fragmentation(F.split("p_name", "e"), "p_name").alias("fragmentation"), study.letters_extra("p_type", "p_name", "E").cast("long").alias("extra"))


@query(
    """with w as (select p_partkey, string_split(p_name, ' ')[1] as w from part), n as (select *, regexp_extract_all(w, '([aeiouàèéíòóúïü]+)') as n from w)
    select p_partkey, len(n) as nuclei, case when len(n) > 0 then greatest(len(n) - case when regexp_matches(w, '(?:[aeiouàèéíòóúïü]|[aeiouàèéíòóúïü]s|en|in)$') then 2 else 1 end, 0) end as stressed from n"""
)
def vowel_nuclei(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w"))
    return p.select("p_partkey", F.size(study.nuclei("w")).cast("long").alias("nuclei"), study.stressed_place("w").cast("long").alias("stressed"))


@query("select p_partkey, array_to_string(list_concat(list_transform(range(1, p_partkey % 5 + 1), lambda i: i::varchar), list_transform(range(p_partkey % 5, 4), lambda i: '-100')), ' ') as labels from part where p_partkey % 5 < 4")
def label_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Labels 9 1 2 ..., those of five tokens too long; batches of all lengths, the start token cut, the rest masked."""
    p = table(spark, sf, "part").select("p_partkey", F.lit(1).alias("batch"), F.concat(F.array(F.lit(9)), F.expr("if(p_partkey % 5 > 0, transform(sequence(1, p_partkey % 5), x -> int(x)), array())").cast("array<int>")).alias("labels"))
    p = p.withColumn("labels", F.when(F.col("p_partkey") % 5 == 4, F.concat("labels", F.array(F.lit(7)))).otherwise(F.col("labels")))
    fit = study.fit_labels(p, "labels", 6)
    filler = fit.limit(1).select(F.lit(-1).cast("long").alias("p_partkey"), "batch", F.array(*[F.lit(k) for k in (9, 1, 2, 3, 4)]).alias("labels"))
    out = study.padded_labels(fit.unionByName(filler), "batch", "labels", start=9).where("p_partkey >= 0")
    return out.select("p_partkey", F.array_join("labels", " ").alias("labels"))


@query("select n_nationkey, 'Say ' || n_name || ' of region ' || n_regionkey || ', again: ' || n_name as prompt from nation")
def prompts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select("n_nationkey", study.prompt("Say {name} of region {region}, again: {name}", name="n_name", region="n_regionkey").alias("prompt"))


@query("select o_orderkey, case when o_orderkey % 3 < 2 then o_orderdate::date end as day from orders")
def iso_dates(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    said = F.when(F.col("o_orderkey") % 3 == 0, day).when(F.col("o_orderkey") % 3 == 1, F.concat(day, F.lit("T10:00:00+00:00"))).otherwise(F.lit("soon"))
    return table(spark, sf, "orders").select("o_orderkey", study.iso_date(said).alias("day"))


@query("select 'written' as first, 'refused' as second, 'written' as third")
def single_writer(spark: SparkSession, sf: str) -> DataFrame:
    """A lock that is held refuses a second writer and lets a third one in afterwards."""
    import uuid

    path, said = f"{shared_dir(spark)}/locked-{uuid.uuid4().hex}", []
    with study.single_writer(spark, path):
        said.append("written")
        try:
            with study.single_writer(spark, path):
                said.append("written")
        except RuntimeError:
            said.append("refused")
    with study.single_writer(spark, path):
        said.append("written")
    return spark.createDataFrame([tuple(said)], "first string, second string, third string")


@query(
    """with recursive c as (select vec_id as id, embedding::double[] as v, row_number() over (order by label desc, vec_id) as k from embeddings where vec_id % 10 = 0),
    r as (select 0::bigint as k, []::bigint[] as ids, 0 as n
      union all select r.k + 1, case when r.n < 8 and not exists (select 1 from c o where list_contains(r.ids, o.id) and list_cosine_similarity(o.v, c.v) >= 0.3) then list_append(r.ids, c.id) else r.ids end,
        case when r.n < 8 and not exists (select 1 from c o where list_contains(r.ids, o.id) and list_cosine_similarity(o.v, c.v) >= 0.3) then r.n + 1 else r.n end from r join c on c.k = r.k + 1)
    select unnest(ids) as id from (select ids from r order by k desc limit 1)"""
)
def voice_bank(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").where("vec_id % 10 = 0").select(F.col("vec_id").alias("id"), F.col("label").cast("double").alias("score"), "embedding")
    return study.accept_until_full(e, e.where("false"), 8, most_similar=0.3).select("id")


@query("select doc_id, row_number() over (order by source, n_chars desc, doc_id) - 1 as place from documents")
def ordered_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A composite order over the whole table, as places."""
    return prefix.global_place(docs(spark, sf).select("doc_id", "source", "n_chars"), ["source", -F.col("n_chars"), "doc_id"]).select("doc_id", "place")


@query("select doc_id from (select doc_id, row_number() over (partition by source order by doc_id) as k from documents) where k <= 7")
def first_of_each_source(spark: SparkSession, sf: str) -> DataFrame:
    return records.capped(docs(spark, sf).select("doc_id", "source"), "source", ["doc_id"], 7).select("doc_id")


@query("select 'documents' as origin, length(text) as chars from documents union all select 'benchmark', length(text) from benchmark union all select 'conversations', length(text) from conversations")
def united_sources(spark: SparkSession, sf: str) -> DataFrame:
    parts = [table(spark, sf, n).select(F.lit(n).alias("origin"), F.length("text").alias("chars")) for n in ("documents", "benchmark", "conversations")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("select doc_id, 'unlabelled' as state from documents where doc_id not in (select doc_id from labels) union all select doc_id, 'both' from labels where toxic = 1 and doc_id in (select doc_id from labels where quality = 0)")
def set_operations(spark: SparkSession, sf: str) -> DataFrame:
    lab = table(spark, sf, "labels")
    rest = docs(spark, sf).select("doc_id").subtract(lab.select("doc_id")).withColumn("state", F.lit("unlabelled"))
    return rest.unionByName(lab.where("toxic = 1").select("doc_id").intersect(lab.where("quality = 0").select("doc_id")).withColumn("state", F.lit("both")))


@query("select doc_id from documents where n_chars / 9.16::double between 1 and 120 and source <> 'src3'")
def windows_and_sources(spark: SparkSession, sf: str) -> DataFrame:
    """A window of durations at reading speed, one source left out."""
    return docs(spark, sf).where((F.col("n_chars") / F.lit(9.16)).between(1, 120) & (F.col("source") != "src3")).select("doc_id")


@query("select event_type, verdict, count(*) as n from (select event_type, case when value > 150 then 'massa llarg' when user_id % 11 = 0 then 'vots' else null end as verdict from events) where verdict is not null group by all")
def vote_and_length_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Clips too long, or with more votes against than for, by the first reason that holds."""
    e = table(spark, sf, "events").withColumns({"up": F.when(F.col("user_id") % 11 == 0, 1).otherwise(3), "down": F.lit(2)})
    reason = gates.first_reason([("massa llarg", F.col("value") > 150), ("vots", F.col("down") > F.col("up"))])
    return e.withColumn("verdict", reason).where("verdict is not null").groupBy("event_type", "verdict").agg(F.count("*").alias("n"))


@query("select vec_id::varchar as id, 'l' || label as source, len(embedding) as size from embeddings where vec_id % 3 <> 0")
def known_speakers(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest of voices, a third of them without an embedding, and beside it one that isn't there."""
    import uuid

    path = f"{shared_dir(spark)}/bank-{uuid.uuid4().hex}"
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.concat(F.lit("l"), F.col("label").cast("string")).alias("source"), F.when(F.col("vec_id") % 3 != 0, F.col("embedding").cast("array<double>")).alias("embedding"))
    e.write.json(path)
    found = study.known_speakers(spark, path).unionByName(study.known_speakers(spark, f"{path}-none"))
    return found.select("id", "source", F.size("embedding").cast("long").alias("size"))


@query("select n_nationkey, n_regionkey from nation where n_regionkey not in (select n_regionkey from nation where n_name like '%3')")
def voices_without_failures(spark: SparkSession, sf: str) -> DataFrame:
    """A call fails for some names; halving finds them, and their whole regions are left out."""
    n = table(spark, sf, "nation")

    def call(texts: list[str]) -> list[str]:
        if any(t.endswith("3") for t in texts):
            raise ValueError("out of memory")
        return texts

    answers = boundary.ask(n, "n_nationkey", "n_name", call)
    return boundary.without_failing(n, answers, "n_nationkey", "n_regionkey").select("n_nationkey", "n_regionkey")
