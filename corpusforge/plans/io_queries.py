"""Queries that write through the sinks and read through the sources, in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.operators import dictionary, reports
from corpusforge.plans.base import docs, half_even, query, seconds
from corpusforge.session import shared_dir, table
from corpusforge.sources import readers, sinks

_VALUE = "case p_partkey % 4 when 0 then '{\"text\": \"' || p_name || '\"}' when 1 then '[{\"text\": \"' || p_name || '\"}, {\"text\": \"' || p_type || '\"}]' when 2 then '[]' else p_name end"
_LIST = (
    "case p_partkey % 4 when 0 then '[\"' || p_name || '\", \"' || p_type || '\", \"' || p_name || '\"]' when 1 then '[{\"entidad\": \"' || p_name || '\"}, {\"entitat\": \"' || p_type || '\"}]' "
    "when 2 then '[{\"grafia_correcta\": \"' || p_type || '\", \"entrada\": \"' || p_name || '\"}]' else '[\"\", \"' || p_brand || '\"]' end"
)


def here(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("select doc_id, lang, source, n_chars from documents")
def jsonl_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = here(spark, "jsonl")
    sinks.write_jsonl(docs(spark, sf).select("doc_id", "lang", "source", "n_chars"), path)
    return readers.read_jsonl(spark, path, "doc_id long, lang string, source string, n_chars long")


@query("select p_partkey, p_name from part")
def tsv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns of a headed table of four, quotes left as they are."""
    path = here(spark, "tsv")
    table(spark, sf, "part").select("p_partkey", "p_brand", "p_name", "p_type").write.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return readers.read_tsv(spark, path, ["p_partkey", "p_name"], "p_partkey long, p_brand string, p_name string, p_type string")


@query("select md5(text) as hash, count(*) as n from documents where trim(text) <> '' group by 1")
def capture_once(spark: SparkSession, sf: str) -> DataFrame:
    """A source captured into a table; a second capture, of another field, finds the first."""
    path = here(spark, "capture")
    for field in ("text", "lang"):
        blocks = readers.capture(spark, {"kind": "hf", "path": f"{sf}/documents.parquet", "field": field, "name": "documents"}, path)
    return blocks.groupBy(F.md5("text").alias("hash")).agg(F.count("*").alias("n"))


@query("select distinct url as origen from pages where url is not null")
def encyclopaedia_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Captured articles, each title once."""
    path = here(spark, "articles")
    table(spark, sf, "pages").where("url is not null").select(F.col("url").alias("title"), F.substring("html", 1, 200).alias("extract")).write.json(path)
    return readers.read_source(spark, {"kind": "wikipedia", "path": path}).select("origen")


@query("select p_brand, sum(length(p_name))::bigint as chars, count(*) as n from part group by 1")
def text_files(spark: SparkSession, sf: str) -> DataFrame:
    """Whole files below a folder: one line for each part, a folder for each brand."""
    path = here(spark, "texts")
    table(spark, sf, "part").select("p_brand", "p_name").write.partitionBy("p_brand").text(path)
    files = readers.read_text(spark, path).select(F.regexp_extract("origen", "p_brand=([^/]*)", 1).alias("b"), F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return files.groupBy(F.url_decode(F.url_decode("b")).alias("p_brand")).agg(F.sum(F.length("line")).alias("chars"), F.count("*").alias("n"))


@query(f"select p_partkey, case p_partkey % 4 when 0 then p_name when 1 then p_name || ' ' || p_type when 2 then '' else p_name end as text from (select *, {_VALUE} as v from part)")
def mixed_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").withColumn("v", F.expr(_VALUE)).select("p_partkey", readers.mixed_text("v").alias("text"))


@query("select p_partkey, case p_partkey % 4 when 0 then p_name || '|' || p_type when 1 then p_name || '|' || p_type when 2 then p_type else p_brand end as names from part")
def entity_list(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").withColumn("v", F.expr(_LIST)).select("p_partkey", F.array_join(readers.entity_names("v"), "|").alias("names"))


@query(
    """with p as (select 'f' || (p_partkey % 10) || '/' || p_partkey as stem, p_partkey as k from part)
    select stem || '.json' as json, case when k % 3 = 0 then stem || '.wav' else 'f' || (k % 10) || '/output.wav' end as wav from p where k % 3 = 0 or k % 10 in (1, 2)"""
)
def file_pairs(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.expr("concat('f', p_partkey % 10, '/', p_partkey)").alias("stem"), F.col("p_partkey").alias("k"))
    names = p.select(F.concat("stem", F.lit(".json")).alias("path")).unionByName(p.where("k % 3 = 0").select(F.concat("stem", F.lit(".wav")).alias("path")))
    names = names.unionByName(p.where("k % 10 in (1, 2)").select(F.expr("concat('f', k % 10, '/output.wav')").alias("path")).distinct())
    return readers.pair_files(names)


@query("select n_name as spelling, lower(n_name) as value, n_nationkey % 2 = 0 as reviewed from nation")
def dictionary_file(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary in one JSON file: entries of the newer and of the older form, and a key that is no entry."""
    path = here(spark, "dictionary")
    entry = F.expr("""concat('"', n_name, '": ', if(n_nationkey % 2 = 0, concat('{"fonetica": "', lower(n_name), '", "revisat": true}'), concat('"', lower(n_name), '"')))""")
    whole = table(spark, sf, "nation").agg(F.concat(F.lit('{"_meta": "x", '), F.array_join(F.collect_list(entry), ", "), F.lit("}")).alias("value"))
    whole.coalesce(1).write.text(path)
    return readers.read_dictionary(spark, path)


_STATE = "case n_nationkey % 4 when 0 then 'sense_canvi' when 1 then 'pendent_fonetica' when 2 then 'amb_fonetica' else 'unknown' end"
_SAID = "case when n_nationkey % 8 = 2 then n_name when n_nationkey % 4 = 2 then n_name || 'x' end"


@query(f"with e as (select n_name as spelling, {_STATE} as s, {_SAID} as v from nation) select spelling, case when s = 'amb_fonetica' and v = spelling then 'sense_canvi' else s end as state, case when v <> spelling then v end as value from e where s <> 'unknown'")
def cache_load(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "nation").select(F.col("n_name").alias("spelling"), F.expr(_STATE).alias("state"), F.expr(_SAID).alias("value"))
    return dictionary.load_cache(e)


@query("select doc_id, case when doc_id % 3 = 0 then 1 else 2 end as step, case when doc_id % 3 = 0 then 'old' else 'new' end as why from documents where doc_id % 3 < 2")
def rejects_by_step(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects of two steps; the second step runs again and replaces its own only."""
    path = here(spark, "rejects")
    d = docs(spark, sf)
    first = d.where("doc_id % 3 <> 1").select("doc_id", F.lit("old").alias("why"), F.when(F.col("doc_id") % 3 == 0, 1).otherwise(2).alias("step"))
    sinks.write_rejects(first, path)
    sinks.write_rejects(d.where("doc_id % 3 = 1").select("doc_id", F.lit("new").alias("why"), F.lit(2).alias("step")), path)
    return spark.read.parquet(path).select("doc_id", "step", "why")


@query(f"with d as (select *, (round_even({seconds('text')} * 100, 0))::bigint as c from documents) select count(*) filter (n_chars >= 100) as accepted, coalesce(sum(length(text)) filter (n_chars >= 100), 0)::bigint as chars, {half_even('sum(c) filter (n_chars >= 100)', '3600')} as hours, count(*) filter (n_chars < 100) as rejected from d")
def source_commit(spark: SparkSession, sf: str) -> DataFrame:
    from corpusforge.functions import text as T

    d = docs(spark, sf).select("doc_id", "text", "n_chars", T.seconds("text").alias("seconds"))
    meta = sinks.commit_source(d.where("n_chars >= 100"), d.where("n_chars < 100").withColumn("step", F.lit(1)), here(spark, "source"))
    return meta.select("accepted", "chars", "hours", "rejected")


@query("select n_nationkey, n_name, case when n_nationkey % 2 = 0 then 'b' else 'a' end as version, case when n_nationkey % 2 = 0 then n_regionkey end as extra from nation")
def manifest_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest written, then merged with rows that replace half of it and bring a column."""
    path, n = here(spark, "manifest"), table(spark, sf, "nation")
    sinks.merge_into(n.select("n_nationkey", "n_name", F.lit("a").alias("version")), path, "n_nationkey")
    sinks.merge_into(n.where("n_nationkey % 2 = 0").select("n_nationkey", "n_name", F.lit("b").alias("version"), F.col("n_regionkey").alias("extra")), path, "n_nationkey")
    return sinks.read_merged(spark, path)


@query("select '## Parts by brand' || chr(10) || chr(10) || '| brand | n |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || p_brand || ' | ' || n || ' |', chr(10) order by p_brand) as report from (select p_brand, count(*) as n from part group by 1)")
def markdown_report(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n")).orderBy("brand")
    return spark.createDataFrame([(reports.markdown(counts, "Parts by brand"),)], "report string")


@query("select n_nationkey, n_name, null::varchar as mark, null::varchar as note from nation")
def annotation_sheet(spark: SparkSession, sf: str) -> DataFrame:
    path = here(spark, "sheet")
    sinks.write_sheet(table(spark, sf, "nation").select("n_nationkey", "n_name"), path, ["mark", "note"])
    return spark.read.option("header", True).schema("n_nationkey int, n_name string, mark string, note string").csv(path)


@query("select p_brand, count(*) as n, sum(p_size)::bigint as size from part group by 1")
def folder_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in a folder for each bucket; one bucket is read without the others."""
    path = here(spark, "folders")
    sinks.write_by_folder(table(spark, sf, "part").select("p_partkey", "p_size", "p_brand"), path, "p_brand")
    return spark.read.parquet(path).groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("size"))
