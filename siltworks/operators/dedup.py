"""Paragraph deduplication across documents.

A line is a duplicate if its normalized hash occurs in two or more documents of a scope; repeats inside one document
are dropped after their first. Only ``(scope, hash, doc)`` travels: texts stay where they are until the kept
positions, one short array per document, come back to them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.binding import let
from siltworks.functions.hashing import line_hash


def documents_with_lines(df: DataFrame, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc``, ``keep`` columns and ``hashes``: one hash per line. Null and empty texts drop out."""
    hashes = F.transform(F.split(df[text], "\n"), line_hash)
    return df.filter(F.length(df[text]) > 0).select(df[doc].alias("doc"), *[df[c].alias(c) for c in keep], hashes.alias("hashes"))


def exploded(lines: DataFrame) -> DataFrame:
    """One row per line: the other columns, ``pos`` and ``hash``."""
    others = [c for c in lines.columns if c != "hashes"]
    return lines.select(*others, F.posexplode("hashes").alias("pos", "hash"))


def collect_hashes(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``by``, ``hash``, ``n_docs``: in how many documents each hash occurs (not how often)."""
    others = [*by, "doc"]
    once = lines.select(*others, F.explode(F.array_distinct("hashes")).alias("hash")).distinct()
    return once.groupBy(*by, "hash").agg(F.count("*").alias("n_docs"))


def merge_hashes(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Final counts from partial ones, e.g. of shards or earlier runs."""
    return parts.groupBy(*by, "hash").agg(F.sum("n_docs").alias("n_docs"))


def save_hashes(hashes: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Append counts of hashes to a table, a folder for each value of ``by`` (e.g. a shard)."""
    hashes.write.mode("append").partitionBy(*by).option("compression", "zstd").parquet(path)


def load_hashes(spark: SparkSession, *paths: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Saved counts of one or more tables, merged."""
    parts = [spark.read.parquet(p).select(*by, "hash", "n_docs") for p in paths]
    return merge_hashes(reduce(DataFrame.union, parts), by)


def duplicate_hashes(hashes: DataFrame) -> DataFrame:
    return hashes.filter("n_docs >= 2").drop("n_docs")


def first_in_document(lines: DataFrame) -> DataFrame:
    """One row per different line of a document, its first: the other columns, ``pos`` and ``hash``. Sorted within the row; no shuffle."""
    others = [c for c in lines.columns if c != "hashes"]
    return lines.select(*others, F.inline(_firsts(F.col("hashes")))).select(*others, "pos", "hash")


def _firsts(hashes: Column) -> Column:
    """``hash, pos`` of the first of each different hash, in the order of hashes."""
    numbered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("pos"))))
    return let(numbered, lambda s: F.filter(s, lambda x, i: (i == 0) | (x["hash"] != F.get(s, i - 1)["hash"])))


def two_pass_lines(lines: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Lines whose hash no other document of the scope has."""
    rows = first_in_document(lines)
    dups = duplicate_hashes(collect_hashes(lines, scope))
    return rows.join(dups, [*scope, "hash"], "left_anti")


def keep_first_lines(lines: DataFrame) -> DataFrame:
    """Of equal lines of the whole corpus the first, in the order of documents and positions."""
    # partial minimum before the shuffle: a hash that every document has costs one row a task
    first = exploded(lines).groupBy("hash").agg(F.min(F.struct("doc", "pos")).alias("at"))
    return first.select("at.doc", "at.pos", "hash")


def known_lines_removed(lines: DataFrame, known: DataFrame) -> DataFrame:
    """Lines whose hash is not in ``known`` (column ``hash``), first occurrence per document."""
    return first_in_document(lines).join(known.select("hash").distinct(), "hash", "left_anti").select("doc", "pos", "hash")


def rebuild(df: DataFrame, kept: DataFrame, doc: str = "doc_id", text: str = "text", keep_empty: bool = False, columns: tuple[str, ...] = ()) -> DataFrame:
    """Documents of the kept lines: ``text``, ``nlines``, ``length``, ``original_nlines``, ``original_length``, ``line_ids``.

    ``keep_empty`` keeps documents that lost all lines (empty text, no ids). Lengths are code points.
    """
    ids = kept.groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("line_ids"))
    base = df.filter(F.length(df[text]) > 0).select(df[doc].alias("doc"), df[text].alias("full"), *[df[c] for c in columns])
    out = base.join(ids, "doc", "left" if keep_empty else "inner")
    out = out.withColumn("line_ids", F.coalesce("line_ids", F.array().cast("array<int>")))
    lines = F.split("full", "\n")
    body = let(lines, lambda x: F.array_join(F.transform("line_ids", lambda i: F.element_at(x, i + 1)), "\n"))
    out = out.withColumn("body", body)
    return out.select(
        F.col("doc").alias(doc),
        *columns,
        F.col("body").alias(text),
        F.size("line_ids").alias("nlines"),
        F.length("body").alias("length"),
        F.size(lines).alias("original_nlines"),
        F.length("full").alias("original_length"),
        "line_ids",
    )


def intra_document(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document without its own repeated lines; no shuffle."""
    lines = documents_with_lines(df, doc, text, (text,))
    kept = lines.withColumn("line_ids", F.array_sort(F.transform(_firsts(F.col("hashes")), lambda x: x["pos"])))
    return kept.select(F.col("doc").alias(doc), F.size("line_ids").alias("nlines"), "line_ids")


def shard_scope(shard: Column, shards_per_scope: int) -> Column:
    """The group of shards within which hashes are compared."""
    return F.floor(shard / shards_per_scope).cast("int")


def duplicate_rate(lines: DataFrame, shard: str, steps: list[int]) -> DataFrame:
    """``shards, n_lines, n_duplicates``: lines that are duplicates if hashes of the first k shards are known, for each k.

    A hash becomes known as a duplicate when its second document's shard is reached, so each step is a
    filter on that shard, not another pass.
    """
    firsts = exploded(lines).select("hash", "doc", shard).distinct()
    order = W.partitionBy("hash").orderBy(shard, "doc")
    second = firsts.withColumn("rn", F.row_number().over(order)).filter("rn = 2").select("hash", F.col(shard).alias("since"))
    rows = exploded(lines).join(second, "hash", "left")
    counted = [F.count_if(F.col("since") < k).alias(f"k{k}") for k in steps]
    one = rows.agg(F.count("*").alias("n_lines"), *counted)
    pairs = F.array(*[F.struct(F.lit(k).alias("shards"), F.col(f"k{k}").alias("n_duplicates")) for k in steps])
    return one.select("n_lines", F.explode(pairs).alias("x")).select("x.shards", "n_lines", "x.n_duplicates")
