"""Readers: JSON lines, plain text, WET archives, cutoff tables, tag directories, encyclopedia dumps."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.urls import netloc

DOCUMENT = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("date_download", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("nlines", T.IntegerType()),
        T.StructField("source_domain", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("raw_content", T.StringType()),
        T.StructField("cc_segment", T.StringType()),
        T.StructField("original_nlines", T.IntegerType()),
        T.StructField("original_length", T.IntegerType()),
        T.StructField("line_ids", T.ArrayType(T.IntegerType())),
        T.StructField("language", T.StringType()),
        T.StructField("language_score", T.DoubleType()),
        T.StructField("perplexity", T.DoubleType()),
        T.StructField("bucket", T.StringType()),
    ]
)


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value, file``: lines of text files (globs and gzip too), split by Hadoop at line ends."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType | str | None = DOCUMENT, strict: bool = False) -> DataFrame:
    """JSON-lines documents. Bad and empty lines drop out, or end the job with ``strict``.

    With a schema the files are read once; without one Spark infers it.
    """
    reader = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)


def read_jsonl_counted(spark: SparkSession, paths: str | list[str], schema: T.StructType = DOCUMENT) -> tuple[DataFrame, Observation]:
    """``read_jsonl`` in one pass with counts: after an action the observation holds ``lines``, ``empty`` and ``bad`` ones."""
    lines = spark.read.text(paths)
    parsed = lines.select("value", F.from_json("value", T.StructType([*schema.fields, T.StructField("bad", T.StringType())]), {"columnNameOfCorruptRecord": "bad"}).alias("doc"))
    empty = F.trim("value") == ""
    bad = ~empty & (F.col("doc").isNull() | F.col("doc.bad").isNotNull())
    seen = Observation()
    counted = parsed.observe(seen, F.count("*").alias("lines"), F.count_if(empty).alias("empty"), F.count_if(bad).alias("bad"))
    return counted.filter(~empty & ~bad).select("doc.*").drop("bad"), seen


def bad_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value, file``: lines that are neither empty nor JSON objects."""
    lines = read_lines(spark, paths).filter(F.trim("value") != "")
    parsed = F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"})
    return lines.filter(parsed.isNull())


def wet_documents(records: DataFrame, min_len: int = 1) -> DataFrame:
    """Documents from ``record`` texts of WET archives (head and body), with their other columns.

    Only conversions count. Head fields are found by name. The first body line is the title; two empty lines at the end belong to the
    format. A body of one line has empty content and drops out with any ``min_len`` above 0.
    """
    text = F.replace(F.col("record"), F.lit("\r"), F.lit(""))
    text = F.regexp_replace(text, r"^\s+", "")
    head = F.regexp_extract(text, r"(?s)^(.*?)\n[ \t]*\n", 1)
    body = F.regexp_replace(F.regexp_extract(text, r"(?s)^.*?\n[ \t]*\n(.*)$", 1), r"\n[ \t]*\n[ \t]*\n?$", "")

    def field(name: str):
        return F.regexp_extract("head", rf"(?m)^{name}:[ \t]*(\S+)", 1)

    others = [c for c in records.columns if c != "record"]
    parts = records.select(*others, head.alias("head"), body.alias("body")).filter(field("WARC-Type") == "conversion")
    lines = F.transform(F.split("body", "\n"), lambda x: F.trim(x))
    parts = parts.withColumn("lines", lines)
    content = F.array_join(F.slice("lines", 2, F.size("lines")), "\n")
    return parts.select(
        field("WARC-Target-URI").alias("url"),
        field("WARC-Date").alias("date_download"),
        field("WARC-Block-Digest").alias("digest"),
        field("Content-Length").cast("bigint").alias("length"),
        (F.size("lines") - 1).alias("nlines"),
        netloc(field("WARC-Target-URI")).alias("source_domain"),
        F.element_at("lines", 1).alias("title"),
        content.alias("raw_content"),
        *others,
    ).filter(F.length("raw_content") >= min_len)


def read_wet(spark: SparkSession, paths: str | list[str], min_len: int = 300) -> DataFrame:
    """Documents of WET files, plain or gzip, with ``cc_segment`` from the file name.

    The reader cuts files at lines that begin with the record mark, so plain files split over tasks and no task holds a whole file; the mark
    inside a line is text.
    """
    rows = spark.read.option("lineSep", "\nWARC/1.0").text(paths)
    record = F.regexp_replace("value", "^WARC/1\\.0", "")  # the first one of a file
    rows = rows.select(record.alias("record"), F.col("_metadata.file_path").alias("cc_segment"))
    return wet_documents(rows.filter(F.col("record").contains("WARC-Type")), min_len)


def shard_segments(segments: list[str], shard: int, num_shards: int, limit: int = -1) -> list[str]:
    """The consecutive slice of a manifest that belongs to a shard, at most ``limit`` segments of it."""
    if not 0 <= shard < num_shards:
        raise ValueError("shard out of range")
    n = len(segments)
    own = segments[shard * n // num_shards : (shard + 1) * n // num_shards]
    return own if limit < 0 else own[:limit]


def read_shards(
    spark: SparkSession, manifest: list[str], num_shards: int, shards: list[int] | None = None, limit: int = -1, min_len: int = 300, root: str = ""
) -> DataFrame:
    """Documents of some shards (all by default) of a manifest of WET files: those of ``read_wet`` with ``shard`` and the manifest's name as ``cc_segment``.

    Only the files of these shards are opened, at most ``limit`` of each; names are taken below ``root``. A manifest has a name a file.
    """
    names = [(name, s) for s in (range(num_shards) if shards is None else shards) for name in shard_segments(manifest, s, num_shards, limit)]
    keys = {name.rsplit("/", 1)[-1]: (name, s) for name, s in names}
    if len(keys) < len(names):
        raise ValueError("two segments of one file name")
    if not names:
        return spark.createDataFrame([], DOCUMENT).withColumn("shard", F.lit(0)).limit(0)
    docs = read_wet(spark, [f"{root}/{n}" if root else n for n, _ in names], min_len)
    known = spark.createDataFrame([(k, *v) for k, v in keys.items()], "file string, segment string, shard int")
    joined = docs.withColumn("file", F.substring_index("cc_segment", "/", -1)).join(F.broadcast(known), "file")  # a row a file
    return joined.withColumn("cc_segment", F.col("segment")).drop("file", "segment")


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Names of a manifest, a line each."""
    return [r["value"].strip() for r in spark.read.text(path).filter("trim(value) <> ''").collect()]


def assign_shards(manifest: DataFrame, name: str, num_shards: int) -> DataFrame:
    """``name, shard``: the consecutive slice of the sorted manifest to which each segment belongs, as ``shard_segments`` cuts it.

    A manifest has a row an archive file, so that one window over it is small.
    """
    ranked = manifest.select(name).withColumn("i", F.row_number().over(W.orderBy(name)) - 1).withColumn("n", F.count("*").over(W.partitionBy()))
    # the first shard whose end lies behind the row: ends are floor((shard + 1) n / N)
    shards = F.sequence(F.lit(0), F.lit(num_shards - 1))
    shard = F.size(F.filter(shards, lambda k: F.floor((k + 1) * F.col("n") / num_shards) <= F.col("i")))
    return ranked.select(name, shard.alias("shard"))


def dump_names(page: str) -> list[str]:
    """Names of the dumps that an index page mentions, sorted."""
    return sorted(set(re.findall(r"CC-MAIN-(\d{4}-\d{2})", page)))


def read_cutoffs(spark: SparkSession, path: str) -> DataFrame:
    """Percentile table: ``pct`` (row number where the file has no such column) and a column per language."""
    df = spark.read.csv(path, header=True, inferSchema=True)
    first = df.columns[0]
    return df.withColumnRenamed(first, "pct")


def read_tag_directory(spark: SparkSession, path: str) -> DataFrame:
    """``key, tag, source``: of each external page of an RDF directory the parts of its topic, by URL and by host."""
    schema = "_about string, topic string"
    pages = spark.read.format("xml").option("rowTag", "ExternalPage").schema(schema).load(path)
    rows = pages.select(F.col("_about").alias("url"), F.explode(F.split("topic", "/")).alias("tag")).filter("tag <> '' and tag <> 'Top'")
    both = F.explode(F.array(F.col("url"), netloc(F.col("url"))))
    return rows.select(both.alias("key"), "tag", F.col("url").alias("source")).filter("key <> ''")


def opening_texts(articles: DataFrame, n_docs: int | None = None, text: str = "opening_text") -> DataFrame:
    """``text``: normalized non-empty opening texts, at most ``n_docs``."""
    from siltworks.functions.text import normalize

    rows = articles.filter(F.length(articles[text]) > 0).select(normalize(articles[text], accent=False).alias("text"))
    return rows.limit(n_docs) if n_docs else rows
