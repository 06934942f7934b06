"""Writers: splits, shards, size-driven compaction."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.hashing import line_hash
from siltworks.operators.verbs import split_name
from siltworks.session import materialize, scratch


def parse_size(text: str) -> int:
    """``"4G"`` and the like in bytes."""
    found = re.fullmatch(r"([\d.]+)\s*([BKMG])", text.strip().upper())
    if not found:
        raise ValueError(f"not a size: {text}")
    return int(float(found[1]) * 1024 ** "BKMG".index(found[2]))


def write_jsonl(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists") -> None:
    """JSON lines; null fields are left out. Spark writes beside the target and renames on success."""
    df.write.mode(mode).option("compression", compression).option("ignoreNullFields", True).json(path)


def write_sharded(df: DataFrame, path: str, shards: int, compression: str = "gzip") -> None:
    write_jsonl(df.repartition(shards), path, compression)


def write_sized(df: DataFrame, path: str, total_bytes: int, target: str = "4G", compression: str = "gzip") -> None:
    """As many files as ``total_bytes`` of input need at ``target`` size each."""
    write_sharded(df, path, max(1, -(-total_bytes // parse_size(target))), compression)


def write_split(df: DataFrame, path: str, pattern: str = "{language}_{bucket}", compression: str = "gzip") -> None:
    """One folder per split; documents with a null or empty field in the pattern drop out.

    A hot split keeps the parallelism of the input: rows are not gathered by split.
    """
    named = df.withColumn("split", split_name(df, pattern)).filter("split is not null")
    named.write.partitionBy("split").option("compression", compression).option("ignoreNullFields", True).json(path)


def segment_file(segment: Column) -> Column:
    """Output name of a segment: base name with ``.json.gz`` for ``.warc.wet`` or ``.warc.wet.gz``."""
    return F.regexp_replace(F.substring_index(segment, "/", -1), r"\.warc\.wet(\.gz)?$", ".json.gz")


def write_by_segment(df: DataFrame, path: str, segment: str = "cc_segment") -> None:
    """One folder per segment with one file: a segment is one archive file, so a task holds no more than that."""
    named = df.withColumn("file", segment_file(df[segment])).filter("file <> ''")
    named.repartition("file").write.partitionBy("file").option("compression", "gzip").json(path)


def write_text_by_language(df: DataFrame, path: str) -> None:
    """``text`` lines, a folder per ``language``."""
    df.select("language", "text").filter("language is not null and text is not null").write.partitionBy("language").option("compression", "gzip").text(path)


def size_groups(files: DataFrame, target: int, by: str = "prefix", first: int = 10) -> DataFrame:
    """``by, name, size, ordinal, grp, offset``: consecutive files in groups of about ``target`` bytes.

    The number of files a group follows from the mean of the first ``first`` sizes; ``offset`` is where a file starts within its group.
    """
    order = W.partitionBy(by).orderBy("name")
    ranked = files.withColumn("ordinal", F.row_number().over(order) - 1)
    mean = F.avg(F.when(F.col("ordinal") < first, F.col("size"))).over(W.partitionBy(by))
    n = F.count("*").over(W.partitionBy(by))
    per = F.greatest(F.lit(1), F.least(F.floor(F.lit(target) / mean), n))
    grouped = ranked.withColumn("grp", F.floor(F.col("ordinal") / per).cast("int"))
    own = W.partitionBy(by, "grp").orderBy("name").rowsBetween(W.unboundedPreceding, -1)
    return grouped.withColumn("offset", F.coalesce(F.sum("size").over(own), F.lit(0)))


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Paths and sizes of the data files below a folder, sorted."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    found, each = [], system.listFiles(root, True)
    while each.hasNext():
        f = each.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), f.getLen()))
    return sorted(found)


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file, unless the target is there already."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    a, b = hadoop.Path(source), hadoop.Path(target)
    system = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(b.getParent())
    return not system.exists(b) and system.rename(a, b)


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_numbered(df: DataFrame, pattern: str, max_size: str = "4G", compression: str = "gzip") -> list[str]:
    """JSON lines in files named by a pattern in which ``?`` are digits, e.g. ``out/a_????.json.gz``; the names in order.

    There are as many files as the text needs at ``max_size`` characters each, and no more than the pattern has numbers.
    """
    spark = df.sparkSession
    digits = pattern.count("?")
    if not 0 < digits < 8 or "?" * digits not in pattern:
        raise ValueError(f"one run of 1 to 7 question marks: {pattern}")
    whole = materialize(df, "numbered")
    size = whole.select(F.coalesce(F.sum(F.length(F.to_json(F.struct("*"))) + 1), F.lit(0))).first()[0]
    files = min(max(1, -(-size // parse_size(max_size))), 10**digits)
    path = scratch(spark, "numbered-files")
    write_jsonl(whole.repartition(files) if files > 1 else whole.coalesce(1), path, compression)
    names = []
    for i, (f, _) in enumerate(_files(spark, path)):
        names.append(pattern.replace("?" * digits, f"{i:0{digits}}"))
        _move(spark, f, names[-1])
    return names


def regroup_splits(spark: SparkSession, source: str, target: str, size: str = "4G", cleanup: bool = False) -> DataFrame:
    """Compact every split of ``write_split`` into files ``{split}_{number}.json.gz`` of about ``size``; ``split, name, size, grp`` of the inputs.

    Consecutive files make a group, in whose order the lines stay; a group is written by one task. With ``cleanup`` the input goes.
    """
    found = [(re.search(r"/split=([^/]+)/", p)[1], p, n) for p, n in _files(spark, source)]
    groups = size_groups(spark.createDataFrame(found, "prefix string, name string, size bigint"), parse_size(size))
    groups = materialize(groups.select(F.col("prefix").alias("split"), "name", "size", "grp"), "regroup")
    if not found:
        return groups
    lines = spark.read.text([p for _, p, _ in found]).select("value", F.col("_metadata.file_path").alias("name"), F.monotonically_increasing_id().alias("at"))
    n = groups.select("split", "grp").distinct().count()
    rows = lines.join(F.broadcast(groups.select("split", "name", "grp")), "name")  # a row a file
    rows = rows.repartition(n, "split", "grp").sortWithinPartitions("split", "grp", "name", "at")
    path = scratch(spark, "regrouped")
    rows.select("value", "split", "grp").write.partitionBy("split", "grp").option("compression", "gzip").text(path)
    for f, _ in _files(spark, path):
        split, grp = re.search(r"/split=([^/]+)/grp=(\d+)/", f).groups()
        _move(spark, f, f"{target}/{split}_{int(grp):04}.json.gz")
    if cleanup:
        remove(spark, source)
    return groups


def move_segments(spark: SparkSession, source: str, target: str) -> list[str]:
    """Move what ``write_by_segment`` wrote to ``{target}/{segment file}``, numbered where a segment has several; what is there already stays."""
    moved, seen = [], {}
    for p, _ in _files(spark, source):
        name = re.search(r"/file=([^/]+)/", p)[1]
        seen[name] = seen.get(name, -1) + 1
        to = f"{target}/{name}" if not seen[name] else f"{target}/{seen[name]:04}-{name}"
        if _move(spark, p, to):
            moved.append(to)
    return moved


def dump_perplexities(df: DataFrame, path: str) -> None:
    """All perplexities as 4-byte floats."""
    df.select(F.col("perplexity").cast("float").alias("perplexity")).filter("perplexity is not null").write.parquet(path)


def dump_line_hashes(df: DataFrame, path: str, text: str = "raw_content") -> None:
    """The hash of every line, once for each time it stands in the texts."""
    df.select(F.explode(F.transform(F.split(df[text], "\n"), line_hash)).alias("hash")).write.parquet(path)


def regroup(spark: SparkSession, source: str, target: str, files: int, key: list[str] | None = None) -> None:
    """Compact JSON lines into ``files`` files; with ``key`` in its order over all files."""
    df = spark.read.json(source)
    df = df.repartitionByRange(files, *key).sortWithinPartitions(*key) if key else df.coalesce(files)
    write_jsonl(df, target)


def checksum(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``rows, sum``: order-insensitive check of a table's content, by adding 60 bits of each row's SHA-1.

    A row is its columns in the order of their names as text, separated by U+001F, null as U+0000.
    """
    cols = sorted(columns or df.columns)
    row = F.concat_ws("\x1f", *[F.coalesce(df[c].cast("string"), F.lit("\0")) for c in cols])
    value = F.conv(F.substring(F.sha1(F.encode(row, "UTF-8")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0).cast("decimal(38,0)")).alias("sum"))
