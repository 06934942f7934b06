"""Tags of sites: intersection per key, and labelled training lines from tagged pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.urls import netloc


def intersect_tags(df: DataFrame, key: str = "key", tag: str = "tag", source: str = "source") -> DataFrame:
    """``key, tag``: tags that every ``source`` of a key gives it. Counts, not sets, meet in the shuffle."""
    rows = df.select(df[key].alias("key"), df[tag].alias("tag"), df[source].alias("source")).distinct()
    sources = rows.select("key", "source").distinct().groupBy("key").agg(F.count("*").alias("sources"))
    given = rows.groupBy("key", "tag").agg(F.count("*").alias("n"))
    return given.join(sources, "key").filter("n = sources").select("key", "tag")


def tag_map(pairs: DataFrame) -> DataFrame:
    """``key, tags``: sorted array of tags per key; keys without tags are absent."""
    return pairs.groupBy("key").agg(F.array_sort(F.collect_set("tag")).alias("tags"))


def labelled_lines(docs: DataFrame, tags: DataFrame, min_len: int = 200, url: str = "url", text: str = "raw_content") -> DataFrame:
    """``url, line``: ``__label__`` tags and the text in lower case on one line, for texts longer than ``min_len``.

    Tags of the URL come first, else those of its host; documents with neither drop out.
    """
    by_url = tags.select(F.col("key").alias("u"), F.col("tags").alias("url_tags"))
    by_host = tags.select(F.col("key").alias("h"), F.col("tags").alias("host_tags"))
    base = docs.filter(F.length(docs[text]) > min_len).select(docs[url].alias("url"), netloc(docs[url]).alias("host"), docs[text].alias("text"))
    joined = base.join(by_url, F.col("url") == F.col("u"), "left").join(by_host, F.col("host") == F.col("h"), "left")
    own = F.coalesce("url_tags", "host_tags")
    labels = F.array_join(F.transform(own, lambda t: F.concat(F.lit("__label__"), t)), " ")
    body = F.lower(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    return joined.filter(F.size(own) > 0).select("url", F.concat_ws(" ", labels, body).alias("line"))
