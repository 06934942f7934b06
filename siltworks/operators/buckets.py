"""Perplexity buckets per language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cutoff_table(cutoffs: DataFrame, head: int = 30, tail: int = 60) -> DataFrame:
    """``lang, pp_head, pp_tail`` from a table of percentiles with a column per language; one row per column."""
    langs = [c for c in cutoffs.columns if c != "pct"]
    long = cutoffs.filter(F.col("pct").isin(head, tail)).unpivot("pct", langs, "lang", "value")
    return long.groupBy("lang").agg(F.max(F.when(F.col("pct") == head, F.col("value"))).alias("pp_head"), F.max(F.when(F.col("pct") == tail, F.col("value"))).alias("pp_tail"))


def perplexity_bucket(df: DataFrame, cutoffs: DataFrame, language: str = "language", head: int = 30, tail: int = 60) -> DataFrame:
    """``bucket``: head below the first cutoff, middle below the second, else tail; all for languages without cutoffs and for missing,
    negative or not-a-number perplexity."""
    table = cutoff_table(cutoffs, head, tail).withColumnRenamed("lang", "cut_lang")
    # as many rows as the table of percentiles has columns
    joined = df.join(F.broadcast(table), df[language] == F.col("cut_lang"), "left")
    pp = F.col("perplexity")
    none = F.col("pp_head").isNull() | F.col("pp_tail").isNull() | pp.isNull() | F.isnan(pp) | (pp < 0)
    bucket = F.when(none, "all").when(pp < F.col("pp_head"), "head").when(pp < F.col("pp_tail"), "middle").otherwise("tail")
    return joined.withColumn("bucket", bucket).drop("cut_lang", "pp_head", "pp_tail")
