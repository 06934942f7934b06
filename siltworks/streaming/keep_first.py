"""Keep-first deduplication of a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.hashing import line_hash


def keep_first_lines(docs: DataFrame, time: str, delay: str = "1 hour", text: str = "raw_content") -> DataFrame:
    """Lines of a stream whose hash was not seen within ``delay`` of event time; state older than that is dropped."""
    lines = docs.withWatermark(time, delay).withColumn("line", F.explode(F.split(docs[text], "\n")))
    return lines.withColumn("hash", line_hash(F.col("line"))).dropDuplicatesWithinWatermark(["hash"])
