"""Sources: files in several formats, pages, blogs and registered kinds. All paths go through Spark's readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructType

from corpusforge.functions import text as T


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines under a fixed schema; a missing path is an empty table, blank lines are skipped."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_tsv(spark: SparkSession, path: str, columns: list[str], schema: str) -> DataFrame:
    """Named columns of a headed TSV without quoting; broken lines are dropped, missing values become empty."""
    rows = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("mode", "DROPMALFORMED").schema(schema).csv(path)
    return rows.select(*columns).fillna("", [c for c in columns if dict(rows.dtypes)[c] == "string"])


def read_first(spark: SparkSession, path: str, field: str, name: str, most: int | None = None) -> DataFrame:
    """One field of a Parquet set as blocks (origen, text); blank ones are skipped, the rest of the columns not read."""
    rows = spark.read.parquet(path).select(F.col(field).alias("text"))
    rows = rows.limit(most) if most else rows
    return rows.where("trim(text) <> ''").select(F.concat(F.lit(f"{name}#"), F.monotonically_increasing_id().cast("string")).alias("origen"), "text")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, folders below included; hidden files are skipped."""
    return spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(path).select(F.input_file_name().alias("origen"), F.col("value").alias("text"))


def read_tar(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Rows (shard, name, data) of the files in tar shards; with wanted (name) those alone."""

    def members(parts):
        import io
        import tarfile

        import pandas as pd

        for part in parts:
            for shard, content in zip(part["path"], part["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    for m in tar:
                        if m.isfile():
                            yield pd.DataFrame({"shard": [shard], "name": [m.name], "data": [tar.extractfile(m).read()]})

    rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(members, "shard string, name string, data binary")
    return rows if wanted is None else rows.join(wanted.select("name").distinct(), "name", "left_semi").select("shard", "name", "data")


def mixed_text(value: Column | str) -> Column:
    """The text of a plain file, of {"text": ...} or of [{"text": ...}, ...]."""
    v = T.col(value)
    one, many = F.from_json(v, "text string")["text"], F.from_json(v, "array<struct<text:string>>")
    return F.when(v.rlike(r"^\s*\{"), one).when(v.rlike(r"^\s*\["), F.array_join(F.filter(F.transform(many, lambda x: x["text"]), lambda t: t != ""), " ")).otherwise(v)


def entity_names(value: Column | str) -> Column:
    """The names in a JSON list of strings or of objects with one of four keys, in order, without repeats."""
    v = T.col(value)
    keys = ("grafia_correcta", "entrada", "entidad", "entitat")
    objects = F.from_json(v, "array<struct<" + ",".join(f"{k}:string" for k in keys) + ">>")
    plain = F.from_json(v, "array<string>")
    named = F.transform(objects, lambda x: F.coalesce(*[x[k] for k in keys]))
    return F.array_distinct(F.filter(F.when(v.rlike(r"^\s*\[\s*\{"), named).otherwise(plain), lambda n: n.isNotNull() & (n != "")))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Rows (spelling, value) of a JSON object, keys that begin with _ left out; the older flat and the newer nested form."""
    whole = spark.read.option("wholetext", True).text(path)
    pairs = whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("spelling", "_v")).where("not startswith(spelling, '_')")
    return pairs.select("spelling", F.coalesce(F.get_json_object("_v", "$.fonetica"), F.col("_v")).alias("value"), F.coalesce(F.get_json_object("_v", "$.revisat") == "true", F.lit(False)).alias("reviewed"))


def pair_files(names: DataFrame, path: str = "path") -> DataFrame:
    """Each JSON file with its sibling sound file, else with the output.wav of its folder."""
    stem, folder = F.regexp_replace(path, r"\.[^./]+$", ""), F.regexp_replace(path, r"/[^/]*$", "")
    listed = names.select(path, stem.alias("_stem"), folder.alias("_folder"))
    wavs = listed.where(F.col(path).endswith(".wav")).select(F.col(path).alias("wav"), "_stem")
    outs = listed.where(F.col(path).endswith("/output.wav")).select(F.col(path).alias("_out"), "_folder")
    joined = listed.where(F.col(path).endswith(".json")).join(wavs, "_stem", "left").join(outs, "_folder", "left")
    return joined.select(F.col(path).alias("json"), F.coalesce("wav", "_out").alias("wav")).where("wav is not null")


def links(page: Column | str, pattern: str) -> Column:
    """Distinct link targets of a page that match a pattern."""
    found = F.regexp_extract_all(T.col(page), F.lit(r"""(?i)<a\s[^>]*href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    return F.array_distinct(F.filter(found, lambda u: u.rlike(pattern)))


DROPPED = "script|style|nav|header|footer|aside|figcaption"


def paragraphs(page: Column | str) -> Column:
    """The texts of a page's p elements, without those in scripts, navigation, headers, footers and asides."""
    body = F.regexp_replace(T.col(page), rf"(?is)<({DROPPED})\b.*?</\1\s*>", " ")
    found = F.regexp_extract_all(body, F.lit(r"(?is)<p\b[^>]*>(.*?)(?=</p\s*>|<p\b|</article|</body|$)"), F.lit(1))
    plain = F.transform(found, lambda p: F.trim(F.regexp_replace(unescape(F.regexp_replace(p, "<[^>]*>", " ")), r"\s+", " ")))
    return F.filter(plain, lambda p: p != "")


def unescape(x: Column) -> Column:
    """The five character references of XML and the non-breaking space."""
    for old, new in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def blog_post(title: Column | str, body: Column | str) -> Column:
    """A post as title and text: block tags end lines, other tags are blanks."""
    lines = F.regexp_replace(T.col(body), r"(?i)</?(?:p|div|br|li|h[1-6]|blockquote|tr)\b[^>]*>", "\n")
    plain = unescape(F.regexp_replace(lines, "<[^>]*>", " "))
    return F.concat(F.trim(T.col(title)), F.lit(".\n"), F.trim(F.regexp_replace(F.regexp_replace(plain, r"[ \t]+", " "), r"\s*\n\s*", "\n")))


@pandas_udf(StringType())
def unescape_all(x):
    """Every character reference of HTML."""
    import html

    return x.map(html.unescape, na_action="ignore")


Reader = Callable[[SparkSession, dict], DataFrame]
READERS: dict[str, Reader] = {
    "hf": lambda spark, c: read_first(spark, c["path"], c["field"], c["name"], c.get("most")),
    "html": lambda spark, c: spark.read.parquet(c["path"]).select(F.col(c["url"]).alias("origen"), F.array_join(paragraphs(c["html"]), "\n").alias("text")).where("text <> ''"),
    "wp": lambda spark, c: read_jsonl(spark, c["path"], "link string, title string, content string").select(F.col("link").alias("origen"), blog_post("title", "content").alias("text")),
    "wikipedia": lambda spark, c: read_jsonl(spark, c["path"], "title string, extract string").dropDuplicates(["title"]).select(F.col("title").alias("origen"), F.col("extract").alias("text")),
}


def read_source(spark: SparkSession, config: dict) -> DataFrame:
    """Blocks (origen, text) of a registered kind of source; pages and posts come as captured files."""
    return READERS[config["kind"]](spark, config)


def capture(spark: SparkSession, config: dict, path: str, force: bool = False) -> DataFrame:
    """A source's blocks, read once and kept: what is there is used again unless forced."""
    if force or not exists(spark, f"{path}/_SUCCESS"):
        read_source(spark, config).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
