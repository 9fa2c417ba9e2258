"""Queries over orders, splits, packs, joins, aggregations and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusforge.functions import metrics as M
from corpusforge.functions import numbers as N
from corpusforge.functions import text as T
from corpusforge.operators import dedup as D
from corpusforge.operators import lexicon, records, reports
from corpusforge.operators import ordering as O
from corpusforge.plans.base import dedup, docs, hex_number, query, seconds
from corpusforge.session import table

_KEY = lambda *p: f"sha256(concat_ws('|', '42', {', '.join(p)}))"
_DUR = f"s as (select doc_id, lang, source, {seconds('text')} as d, round_even({seconds('text')} * 100, 0)::bigint as c from documents)"


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their duration in hundredths of a second, so that sums are exact."""
    return docs(spark, sf).select("doc_id", "lang", "source", F.bround(T.seconds("text") * 100).cast("long").alias("c"))


@query(f"with {_DUR} select doc_id, lang, (sum(c) over (partition by lang = 'en' order by doc_id))::double / case when lang = 'en' then 3.0 else 1.0 end as turn from s")
def tier_interleave(spark: SparkSession, sf: str) -> DataFrame:
    tiers = _timed(spark, sf).withColumn("tier", F.col("lang") == "en")
    return O.interleave(tiers, "tier", "c", ["doc_id"], {True: 3.0}).select("doc_id", "lang", "turn")


@query(
    f"""with {_DUR}, r as (select source, doc_id, sum(c) over (partition by source order by doc_id) as run from s)
    select source, mark::double as mark, min_by(doc_id, run) as doc_id, min(run)::bigint as reached from r, (select unnest([10000.0, 100000.0]) as mark) where run >= mark group by source, mark"""
)
def running_milestones(spark: SparkSession, sf: str) -> DataFrame:
    return O.milestones(_timed(spark, sf), "c", ["source"], ["doc_id"], [10_000, 100_000], "doc_id")


@query(f"with {_DUR} select doc_id, source from s qualify sum(c) over (partition by source order by doc_id) - c < 50000")
def budget_cut(spark: SparkSession, sf: str) -> DataFrame:
    return O.budget_cut(_timed(spark, sf), "c", ["source"], ["doc_id"], 50_000).select("doc_id", "source")


_PLACED = f"p as (select doc_id, source, lang, row_number() over (order by {_KEY('doc_id::varchar')}, doc_id) - 1 as place from documents), v as (select distinct label from embeddings), nv as (select count(*) as n from v)"
_SEATS = f"laps as (select distinct place // n as lap from p, nv), seats as (select lap, label, row_number() over (partition by lap order by {_KEY('lap::varchar', 'label::varchar')}, label) - 1 as seat from laps, v)"


@query(f"with {_PLACED}, {_SEATS} select doc_id, place, label from p, nv join seats on seats.lap = p.place // n and seats.seat = p.place % n")
def round_robin_voice(spark: SparkSession, sf: str) -> DataFrame:
    placed = O.global_place(docs(spark, sf).select("doc_id"), [O.hash_order("doc_id"), "doc_id"])
    return O.round_robin(placed, "place", table(spark, sf, "embeddings").select("label").distinct(), "label").select("doc_id", "place", "label")


@query("select label, copy from (select label, greatest(1, round_even(count(*)::double / 100 * 10, 0)::int) as k from embeddings group by label), lateral (select unnest(range(1, k + 1))::int as copy)")
def weighted_env(spark: SparkSession, sf: str) -> DataFrame:
    weights = table(spark, sf, "embeddings").groupBy("label").agg((F.count("*") / 100).alias("w"))
    return O.by_weight(weights, "w").select("label", "copy")


@query(
    f"""with {_PLACED}, {_SEATS} select doc_id, source, place, label as voice, ('env' || (place % 3)) as environment,
    round_even(0.94 + 0.12 * (({hex_number("'speed|42|' || doc_id", 16)} % 2147483648)::double / 2147483648.0), 3) as speed, ({hex_number("'42|' || doc_id", 16)} % 2147483648)::bigint as seed
    from p, nv join seats on seats.lap = p.place // n and seats.seat = p.place % n"""
)
def plan(spark: SparkSession, sf: str) -> DataFrame:
    placed = O.global_place(docs(spark, sf).select("doc_id", "source"), [O.hash_order("doc_id"), "doc_id"])
    seated = O.round_robin(placed, "place", table(spark, sf, "embeddings").select(F.col("label").alias("voice")).distinct(), "voice")
    speed = F.bround(0.94 + 0.12 * records.uniform(F.lit("speed"), F.lit("42"), "doc_id"), 3)
    return seated.select("doc_id", "source", "place", "voice", F.concat(F.lit("env"), (F.col("place") % 3).cast("string")).alias("environment"), speed.alias("speed"), records.stable_seed(F.lit("42"), "doc_id").alias("seed"))


@query(f"with {_DUR} select doc_id, doc_id // 200 as block, (row_number() over (partition by doc_id // 200, source order by d, doc_id) - 1) // 4 as lot from s")
def lots_by_length(spark: SparkSession, sf: str) -> DataFrame:
    rows = docs(spark, sf).select("doc_id", "source", T.seconds("text").alias("d"))
    return O.lots(rows, "doc_id", "source", "d", "doc_id", 200).select("doc_id", "block", "lot")


@query(
    f"""with recursive t as (select conv_id, turn, text, {seconds('text')} as d, row_number() over (partition by conv_id order by turn) as k from conversations),
    f as (select conv_id, k, turn, text, d, 0 as pack, d as dur, 1 as n from t where k = 1 union all
      select t.conv_id, t.k, t.turn, t.text, t.d, case when f.dur + t.d + 0.5 * f.n > 28 then f.pack + 1 else f.pack end, case when f.dur + t.d + 0.5 * f.n > 28 then t.d else f.dur + t.d end, case when f.dur + t.d + 0.5 * f.n > 28 then 1 else f.n + 1 end
      from f join t on t.conv_id = f.conv_id and t.k = f.k + 1)
    select conv_id, pack, list(turn order by turn) as clips, string_agg(text, ' ' order by turn) as text, count(*) as n from f group by conv_id, pack having count(*) >= 2"""
)
def session_pack(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").withColumn("d", T.seconds("text"))
    return O.pack_sessions(turns, "conv_id", ["turn"], "d", "turn", "text").select("conv_id", "pack", "clips", "text", "n")


@query("select doc_id, copy from (select doc_id, case when quality = 1 then 5 else 1 end as k from documents left join labels using (doc_id)), lateral (select unnest(range(1, k + 1))::int as copy)")
def oversample(spark: SparkSession, sf: str) -> DataFrame:
    marked = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    return O.oversample(marked, F.col("quality") == 1, 5).select("doc_id", "copy")


@query("with c as (select source, count(*) as n from documents group by source), m as (select *, sum(n) over () / count(*) over () as mean from c) select source, n, mean::double as mean from m where n > 2 * mean")
def voice_balance(spark: SparkSession, sf: str) -> DataFrame:
    return reports.unbalanced(docs(spark, sf), "source")


@query(
    f"""with a as (select doc_id, source, lang, row_number() over (partition by source, lang order by {_KEY('doc_id::varchar')}, doc_id) as r from documents),
    b as (select *, row_number() over (partition by source order by r, {_KEY('lang', 'source')}, lang) as n from a) select doc_id, source, lang from b where n <= 6"""
)
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return O.stratified(docs(spark, sf).select("doc_id", "source", "lang"), "source", "lang", "doc_id", 6)


@query("with r as (select p_brand, p_partkey, p_retailprice, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as n from part) select p_brand, p_partkey from r where n <= 5")
def quota_by_score(spark: SparkSession, sf: str) -> DataFrame:
    return O.quota(table(spark, sf, "part"), "p_brand", "p_retailprice", "p_partkey", 5).select("p_brand", "p_partkey")


@query("with r as (select p_brand, p_partkey, p_retailprice, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as n from part) select p_brand, max(p_partkey) filter (n = 1) as best, max(p_retailprice) filter (n = 1) as score, list(p_partkey order by n) filter (n between 2 and 4) as others from r group by p_brand")
def best_with_alternatives(spark: SparkSession, sf: str) -> DataFrame:
    return O.alternatives(table(spark, sf, "part"), ["p_brand"], "p_retailprice", "p_partkey")


@query(
    """with a as (select *, row_number() over (partition by p_brand order by abs(p_size - 4.0), p_partkey) as n from part), b as (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as m from a where n <= 10)
    select p_brand, p_partkey from b where m = 1"""
)
def nearest_then_best(spark: SparkSession, sf: str) -> DataFrame:
    return O.nearest_then_best(table(spark, sf, "part"), "p_brand", "p_size", 4.0, "p_retailprice", "p_partkey").select("p_brand", "p_partkey")


@query(
    """with l as (select user_id, event_id, event_type, case when lag(event_type) over w is not distinct from event_type and row_number() over w > 1 then 0 else 1 end as c from events window w as (partition by user_id order by event_id)),
    r as (select *, sum(c) over (partition by user_id order by event_id) as run from l) select user_id, run::bigint as run, min(event_type) as event_type, min(event_id) as start, max(event_id) as "end", count(*) as n from r group by user_id, run"""
)
def islands_runs(spark: SparkSession, sf: str) -> DataFrame:
    return O.runs(table(spark, sf, "events"), ["user_id"], ["event_id"], "event_type", "event_id")


@query(
    """with g as (select user_id, event_id, event_type, epoch_us(ts) as a, coalesce(lead(epoch_us(ts)) over (partition by user_id order by ts, event_id), epoch_us(ts) + 1000000) as b from events),
    w as (select distinct user_id, w * 86400000000 as a, (w + 1) * 86400000000 as b from (select user_id, unnest(range(a // 86400000000, b // 86400000000 + 1)) as w from g)),
    o as (select w.user_id, w.a as day, g.event_id, least(w.b, g.b) - greatest(w.a, g.a) as overlap from w join g on w.user_id = g.user_id and least(w.b, g.b) - greatest(w.a, g.a) > 0)
    select user_id, day, event_id, overlap from o qualify row_number() over (partition by user_id, day order by overlap desc, event_id) = 1"""
)
def interval_overlap_argmax(spark: SparkSession, sf: str) -> DataFrame:
    """For each user and day the event whose span covers most of it; spans meet days by equi-join on the days they touch."""
    day = 86_400_000_000
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    spans = table(spark, sf, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("a"), F.lead(F.unix_micros(F.col("ts").cast("timestamp"))).over(w).alias("b"))
    spans = spans.withColumn("b", F.coalesce("b", F.col("a") + 1_000_000))
    each = spans.withColumn("k", F.explode(F.sequence(F.floor(F.col("a") / day), F.floor(F.col("b") / day))))
    each = each.withColumn("overlap", F.least((F.col("k") + 1) * day, "b") - F.greatest(F.col("k") * day, "a")).where("overlap > 0").withColumn("day", F.col("k") * day)
    best = F.row_number().over(Window.partitionBy("user_id", "day").orderBy(F.desc("overlap"), "event_id"))
    return each.withColumn("n", best).where("n = 1").select("user_id", "day", "event_id", "overlap")


@query(
    """select event_type as item, m as condition, u as voice, count(*) as n, sum((value > 50)::int)::bigint as failed, sum((value > 50)::int)::double / count(*) as rate, sum(value::decimal(28,6))::double / count(*) as distance
    from (select event_type, event_id % 3 as m, user_id % 5 as u, value from events) group by grouping sets ((event_type), (event_type, m), (event_type, u))"""
)
def error_rate_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumns({"m": F.col("event_id") % 3, "u": F.col("user_id") % 5})
    return reports.error_rates(e, "event_type", "m", "u", F.col("value") > 50, "value")


@query("select r_name, n_name, p_type, row_number() over (order by r_name, n_name, p_type) - 1 as place from region join nation on n_regionkey = r_regionkey, (select distinct p_type from part)")
def cross_product_plan(spark: SparkSession, sf: str) -> DataFrame:
    places = table(spark, sf, "region").join(table(spark, sf, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    return O.global_place(places.crossJoin(F.broadcast(table(spark, sf, "part").select("p_type").distinct())).select("r_name", "n_name", "p_type"), ["r_name", "n_name", "p_type"])


@query(
    """with n as (select p_name as name, count(*) as f from part group by p_name union all select split_part(p_name, ' ', 2), count(*) from part group by 1),
    l as (select distinct unnest(string_split(name, ' ')) as t, name, f from n where contains(name, ' ')), b as (select t, max_by(name, (f, name)) as long from l group by t) select name, f, long from n join b on b.t = n.name where not contains(name, ' ')"""
)
def token_containment_join(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    names = p.groupBy(F.col("p_name").alias("name")).agg(F.count("*").alias("f")).unionByName(p.groupBy(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name")).agg(F.count("*").alias("f")))
    return lexicon.contained_names(names, "name", "f")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_linestatus = 'F')")
def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    return D.pending(table(spark, sf, "orders").select("o_orderkey"), done, "o_orderkey", F.col("l_linestatus") == "F")


@query("with a as (select c_custkey, c_nationkey, c_mktsegment from customer) select c_custkey from a where c_mktsegment = 'BUILDING' and c_nationkey in (select c_nationkey from a where c_mktsegment = 'MACHINERY')")
def self_semi_leak(spark: SparkSession, sf: str) -> DataFrame:
    return D.semi_self(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment", "MACHINERY", "BUILDING").select("c_custkey")


@query("with c as (select l_shipmode as g, v, n from (select l_returnflag as l_shipmode, unnest([l_quantity]) as v, 1 as n from lineitem)) select g as l_returnflag, count(*) as n, list_sort(list(v))[(count(*) // 2) + 1] as median, list_sort(list(v))[(count(*) * 95 // 100) + 1] as p95, list_sort(list(v))[((count(*) - 1) * 9 // 10) + 1] as p90 from c group by g")
def group_median_p90(spark: SparkSession, sf: str) -> DataFrame:
    li, g = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity"), ["l_returnflag"]
    out = reports.upper_median(li, g, "l_quantity").join(reports.p95(li, g, "l_quantity").drop("n"), g).join(reports.p90(li, g, "l_quantity").drop("n"), g)
    return out


@query("select event_type, spearman from (select event_type, corr(a, b) as spearman from (select event_type, row_number() over (partition by event_type order by value, event_id) as a, row_number() over (partition by event_type order by user_id, event_id) as b from events) group by event_type)")
def spearman(spark: SparkSession, sf: str) -> DataFrame:
    return M.spearman(table(spark, sf, "events"), ["event_type"], "value", "user_id", "event_id")


@query(
    """with d as (select n_regionkey as g, s_suppkey as k, s_acctbal - 4500 as v from supplier join nation on n_nationkey = s_nationkey), r as (select g, v, row_number() over (partition by g order by k) - 1 as i, count(*) over (partition by g) as n from d),
    draws as (select g, n, b, k, (('0x' || substr(sha256('42|' || b || '|' || k), 1, 8))::ubigint % n)::bigint as i from (select distinct g, n from r), lateral (select unnest(range(0, 200)) as b), lateral (select unnest(range(0, n)) as k)),
    m as (select g, b, (sum(v::decimal(28,6)) / count(*))::double as m from draws join r using (g, i) group by g, b), s as (select g, list_sort(list(m)) as ms from m group by g)
    select g, count(*) as n, (sum(v::decimal(28,6)) / count(*))::double as mean, any_value(ms)[6] as low, any_value(ms)[196] as high, len(list_filter(any_value(ms), lambda x: x < 0)) / 200.0::double as p_below from d join s using (g) group by g"""
)
def bootstrap_ci(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return M.bootstrap(s.select(F.col("n_regionkey").alias("g"), "s_suppkey", (F.col("s_acctbal") - 4500).alias("v")), "g", "v", "s_suppkey", 200)


@query(
    """with c as (select source, list(n order by lang) as p from (select s.source, l.lang, count(d.doc_id)::double as n from (select distinct source from documents) s cross join (select distinct lang from documents) l left join documents d on d.source = s.source and d.lang = l.lang group by 1, 2) group by source),
    a as (select list(n order by lang) as q from (select lang, count(*)::double as n from documents group by lang)), z as (select source, list_transform(p, lambda x: x / list_sum(p)) as p, list_transform(q, lambda x: x / list_sum(q)) as q from c, a)
    select source, sqrt(greatest(sum(case when x > 0 then x * log2(x / ((x + y) / 2)) else 0 end + case when y > 0 then y * log2(y / ((x + y) / 2)) else 0 end) / 2, 0)) as distance from (select source, unnest(p) as x, unnest(q) as y from z) group by source"""
)
def js_distance(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf)
    langs = d.select("lang").distinct()
    counts = d.groupBy("source", "lang").agg(F.count("*").cast("double").alias("n"))
    full = d.select("source").distinct().crossJoin(F.broadcast(langs)).join(counts, ["source", "lang"], "left").fillna(0.0, ["n"])
    vector = F.transform(F.array_sort(F.collect_list(F.struct("lang", "n"))), lambda s: s["n"])
    q = d.groupBy("lang").agg(F.count("*").cast("double").alias("n")).agg(vector.alias("q"))
    return full.groupBy("source").agg(vector.alias("p")).crossJoin(F.broadcast(q)).select("source", M.js_distance("p", "q").alias("distance"))


@query("with a as (select c_custkey, c_name, lead(c_name) over (partition by c_nationkey order by c_custkey) as next from customer) select c_custkey, jaro_winkler_similarity(c_name, next) as likeness from a where next is not null")
def jaro_winkler(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    pairs = table(spark, sf, "customer").withColumn("next", F.lead("c_name").over(w)).where("next is not null")
    return pairs.select("c_custkey", M.jaro_winkler_column("c_name", "next").alias("likeness"))


_PLAIN = lambda x: f"strip_accents(lower({x}))"


@query(
    f"""with a as (select conv_id, turn, replace({_PLAIN('text')}, 'ß', 's') as t, replace({_PLAIN('lead(text) over (partition by conv_id order by turn)')}, 'ß', 's') as h from conversations)
    select conv_id, turn, levenshtein(t, h)::double / length(t) as cer from a where h is not null and t <> ''"""
)
def char_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    plain = lambda c: F.replace(T.strip_accents(c), F.lit("ß"), F.lit("s"))
    pairs = table(spark, sf, "conversations").withColumn("h", F.lead("text").over(w)).where("h is not null and text <> ''")
    return pairs.select("conv_id", "turn", M.cer(plain("text"), plain("h")).alias("cer"))


@query(
    """with w as (select a.p_partkey, split_part(b.p_name, ' ', 1) as e, a.p_name, unnest([string_split(a.p_name, ' ')[1], string_split(a.p_name, ' ')[2], a.p_name]) as c from part a join part b on b.p_partkey = a.p_partkey + 1)
    select p_partkey, e, p_name, round_even(least(min(levenshtein(e, c)::double / length(e)), 1.0), 3) as cer from w group by all"""
)
def window_cer(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    after = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("e"))
    return p.join(after, "p_partkey").select("p_partkey", "e", "p_name", M.window_cer("e", "p_name").alias("cer"))


@query()
def wer_corpus(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    return M.corpus_rates(table(spark, sf, "conversations").withColumn("h", F.lead("text").over(w)).where("h is not null"), "text", "h")


@query(
    """with c as (select p_type as g, p_name as t, count(*) as n from part group by 1, 2), p as (select a.g, a.t, (sum(b.n * round_even(levenshtein(a.t, b.t)::double / length(a.t), 6)::decimal(18,6)) / sum(b.n))::double as m from c a join c b on a.g = b.g and a.t <> b.t group by 1, 2)
    select g as p_type, min_by(t, (m, t)) as medoid, min(m) as mean from p group by g"""
)
def medoid(spark: SparkSession, sf: str) -> DataFrame:
    return M.medoid(table(spark, sf, "part"), "p_type", "p_name")


_UNIT_SQL = "[" + ", ".join(f"'{w}'" for w in N.UNITS) + "]"
_TEN_SQL = "[" + ", ".join(f"'{w}'" for w in N.TENS) + "]"
_SAID = f"case when n < 20 then ({_UNIT_SQL})[n + 1] when n % 10 = 0 then ({_TEN_SQL})[n // 10 - 1] when n < 30 then 'vint-e-' || ({_UNIT_SQL})[n % 10 + 1] else ({_TEN_SQL})[n // 10 - 1] || ' ' || ({_UNIT_SQL})[n % 10 + 1] end"


@query(f"select p_partkey, n, {_SAID} as words from (select p_partkey, p_size::int as n from part)")
def number_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("n"), N.words_column("p_size").alias("words"))


@query(f"select n, case when n = 1 then 'prumèr' when {_SAID} like '%sèt' then regexp_replace({_SAID}, 'sèt$', 'setau') else regexp_replace({_SAID}, 'e$', '') || 'au' end as ordinal from (select distinct p_size::int as n from part where p_size > 0)")
def ordinals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where("p_size > 0").select(F.col("p_size").alias("n")).distinct().withColumn("ordinal", N.ordinal_column("n"))


@query("select n, ['', 'M', 'MM', 'MMM'][n // 1000 + 1] || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][n // 100 % 10 + 1] || ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][n // 10 % 10 + 1] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][n % 10 + 1] as roman, n as back from (select distinct (p_partkey % 3999 + 1)::int as n from part)")
def roman_numerals(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "part").select((F.col("p_partkey") % 3999 + 1).cast("int").alias("n")).distinct()
    return n.withColumn("roman", N.roman_column("n")).withColumn("back", N.roman_value_column("roman"))


@query("select dimension, value, count(*) as n, sum(v::decimal(28,4))::double as seconds from (select unnest(['o_orderstatus', 'o_orderpriority']) as dimension, unnest([o_orderstatus, o_orderpriority]) as value, o_totalprice as v from orders) group by 1, 2")
def breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return reports.breakdown(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "o_totalprice")


@query("with c as (select p_type as correct, p_brand as variant, count(*) as n from part group by 1, 2) select correct, sum(n)::bigint as total, list(variant || ':' || n order by n desc, variant) as variants from c group by correct")
def nested_error_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = reports.nested_counts(table(spark, sf, "part").select(F.col("p_type").alias("correct"), F.col("p_brand").alias("v")), "correct", "v")
    return out.select("correct", "total", F.transform("variants", lambda x: F.concat(x["variant"], F.lit(":"), x["n"].cast("string"))).alias("variants"))


@query("with v as (select user_id, event_type, count(*) as n, min(event_id) as f from events group by 1, 2) select user_id, event_type, n from v qualify row_number() over (partition by user_id order by n desc, f) = 1")
def majority_label(spark: SparkSession, sf: str) -> DataFrame:
    return reports.majority(table(spark, sf, "events"), "user_id", "event_type", "event_id")


@query("with u as (select unnest(['lang', 'source']) as \"column\", unnest([lang, source]) as value from documents), c as (select \"column\", coalesce(nullif(trim(value), ''), '(blank)') as value, count(*) as n from u group by 1, 2), r as (select *, row_number() over (partition by \"column\" order by n desc, value) as place from c) select * from r where place <= 20")
def top_values(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_values(docs(spark, sf), ["lang", "source"])


@query("with t as (select o_orderkey as k, 1 as a, 0 as b from orders where o_orderstatus = 'O' union all select l_orderkey, 0, 1 from lineitem where l_returnflag = 'R'), s as (select k, sum(a) as kept, sum(b) as rejected from t group by k) select coalesce(o.o_orderkey, s.k) as k, case when o.o_orderkey is null then 'orphan' when s.k is null then 'lost' else 'traced' end as state, coalesce(kept, 0)::bigint as kept, coalesce(rejected, 0)::bigint as rejected from (select o_orderkey from orders where o_orderpriority <> '5-LOW') o full join s on s.k = o.o_orderkey")
def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    o, li = table(spark, sf, "orders").withColumn("k", F.col("o_orderkey")), table(spark, sf, "lineitem").withColumn("k", F.col("l_orderkey"))
    return reports.reconcile(o.where("o_orderpriority <> '5-LOW'"), o.where("o_orderstatus = 'O'"), li.where("l_returnflag = 'R'"), "k")


@query("with g as (select o_orderstatus, count(*) as n, sum((o_totalprice > 250000)::int)::bigint as hits from orders group by 1), p as (select *, hits::double / n as share, 1.96::double as z from g) select o_orderstatus, n, hits, share, (share + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(share * (1 - share) / n + z * z / (4 * n * n)) / (1 + z * z / n) as low, (share + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(share * (1 - share) / n + z * z / (4 * n * n)) / (1 + z * z / n) as high from p")
def share_interval(spark: SparkSession, sf: str) -> DataFrame:
    return reports.wilson(table(spark, sf, "orders"), ["o_orderstatus"], F.col("o_totalprice") > 250_000)


@query(
    f"""select * from (select 'no empty text' as "check", count(*) filter (trim(coalesce(text, '')) = '') as against from documents union all select 'unique ids', count(*) - count(distinct doc_id) from documents
    union all select 'no test text', count(*) from documents where {dedup('text')} in (select {dedup('text')} from benchmark) union all select 'labels have documents', count(*) from labels where doc_id not in (select doc_id from documents)
    union all select 'known languages', count(*) from documents where lang not in ('en', 'de', 'fr', 'es') union all select 'length as stored', count(*) from documents where length(text) <> n_chars), lateral (select against = 0 as ok)"""
)
def audit_report(spark: SparkSession, sf: str) -> DataFrame:
    d, b, lab = docs(spark, sf), table(spark, sf, "benchmark"), table(spark, sf, "labels")
    repeated = d.groupBy("doc_id").agg((F.count("*") - 1).alias("more")).where("more > 0").select(F.explode(F.sequence(F.lit(1), F.col("more"))))
    return reports.audit(
        [
            ("no empty text", d.where("trim(coalesce(text, '')) = ''")), ("unique ids", repeated), ("no test text", D.only(d, b, T.dedup_key("text"), T.dedup_key("text"))),
            ("labels have documents", lab.join(d, "doc_id", "left_anti")), ("known languages", d.where("lang not in ('en', 'de', 'fr', 'es')")), ("length as stored", d.where("length(text) <> n_chars")),
        ]
    )


_COS = "list_cosine_similarity(a.embedding::double[], b.embedding::double[])"


@query(f"with a as (select * from embeddings where vec_id % 100 = 0) select a.vec_id, arg_max(b.vec_id, ({_COS}, -b.vec_id)) as nearest, max({_COS}) as similarity from a, embeddings b where a.vec_id <> b.vec_id group by a.vec_id")
def cosine_top1(spark: SparkSession, sf: str) -> DataFrame:
    """Of every hundredth vector the nearest of all others; the stated query set goes against all rows in blocks of bounded size."""
    e = table(spark, sf, "embeddings")
    return M.nearest(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding")


@query("with x as (select vec_id, label, unnest(embedding) as v, generate_subscripts(embedding, 1) as k from embeddings), c as (select label, k, avg(v::double) as m from x group by label, k) select vec_id, label, sum(v::double * m) / (sqrt(sum(v::double * v::double)) * sqrt(sum(m * m))) as similarity from x join c using (label, k) group by vec_id, label")
def centroid_similarity(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    means = e.select("label", F.posexplode("embedding").alias("k", "v")).groupBy("label", "k").agg(F.avg(F.col("v").cast("double")).alias("m"))
    centroids = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "m"))), lambda s: s["m"]).alias("c"))
    return e.join(centroids, "label").select("vec_id", "label", M.cosine("embedding", "c").alias("similarity"))
