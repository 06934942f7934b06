"""Problem 3: the score cutoff that keeps a target fraction of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.urls import bare_host
from siltworks.llm.common import language_key
from siltworks.session import materialize, table

FRACTIONS = (0.3, 0.6, 0.9)


def keep_cutoffs(scores: DataFrame, fractions: tuple[float, ...] = FRACTIONS) -> DataFrame:
    """``kind, key, fraction, cutoff, kept, scored`` from rows ``(kind, key, score)``; the highest scores are kept.

    Only finite scores count. For each (kind, key) and fraction f the cutoff is the distinct score
    whose number of records at or above it lies closest to f x scored; of two equally close the
    higher one, which keeps fewer. All records tied at the cutoff are kept. A null key is a group
    of its own; a key without scores gives no row; repeated rows each count.

    Scores are first counted (partial counts before the shuffle), then the distinct ones are range-partitioned
    by (kind, key, score): sums run inside one partition and key, and the totals of the partitions
    before are added, so neither a hot key nor one with many distinct scores ends in one task.
    """
    finite = F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < F.lit(float("inf")))
    freq = scores.filter(finite).groupBy("kind", "key", "score").agg(F.count("*").alias("n"))
    order = [F.col("kind"), F.col("key"), F.col("score").desc()]
    parts = materialize(freq.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "p3")
    block = W.partitionBy("kind", "key", "part").orderBy(F.col("score").desc())
    sums = parts.groupBy("kind", "key", "part").agg(F.sum("n").alias("in_part"))
    # as many rows as there are partitions that hold a piece of the key
    blocks = sums.select(
        "kind",
        "key",
        "part",
        F.sum("in_part")
        .over(W.partitionBy("kind", "key").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow))
        .alias("upto"),
        F.sum("in_part").over(W.partitionBy("kind", "key")).alias("scored"),
        "in_part",
    )
    same = (
        (F.col("a.kind") == F.col("b.kind")) & F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.part") == F.col("b.part"))
    )
    running = (
        parts.withColumn("within", F.sum("n").over(block))
        .alias("a")
        .join(blocks.alias("b"), same)
        .select(
            "a.kind",
            "a.key",
            "a.score",
            (F.col("within") + F.col("upto") - F.col("in_part")).alias("kept"),
            "scored",
        )
    )
    wanted = F.explode(F.array(*map(F.lit, fractions)))
    gap = F.abs(F.col("kept") - F.col("fraction") * F.col("scored"))
    return (
        running.withColumn("fraction", wanted)
        .groupBy("kind", "key", "fraction")
        .agg(F.min(F.struct(gap.alias("gap"), "kept", F.col("score").alias("cutoff"), "scored")).alias("best"))
        .select("kind", "key", "fraction", F.col("best.cutoff").alias("cutoff"), F.col("best.kept").alias("kept"), F.col("best.scored").alias("scored"))
    )


def perplexity_cutoffs(mined: DataFrame, cutoffs: DataFrame, fractions: tuple[float, ...] = FRACTIONS) -> DataFrame:
    """``kind, key, fraction, cutoff, kept, scored, table_cutoff`` for each language and each host of ``mined``.

    Low perplexity is good, so ``score`` is its negative and records at or below ``cutoff`` are
    kept. A record is scored if its perplexity is finite and above 0. ``table_cutoff`` is the
    value of ``cutoffs`` in the column named like the language at the percentile of the fraction
    (null for hosts, languages without a column and null entries). Languages come in one spelling,
    hosts in lower case without port; rows with neither host nor URL are the null key.
    """
    pp = F.col("perplexity").cast("double")
    base = mined.select(
        language_key(mined["language"]).alias("language"),
        bare_host(mined["source_domain"], mined["url"]).alias("source_domain"),
        mined["perplexity"].alias("perplexity"),
    ).filter(pp > 0)
    pairs = F.explode(
        F.array(
            F.struct(F.lit("language").alias("kind"), F.col("language").alias("key")),
            F.struct(F.lit("source_domain").alias("kind"), F.col("source_domain").alias("key")),
        )
    )
    scores = base.select(pairs.alias("p"), (-pp).alias("score")).select("p.kind", "p.key", "score")
    found = keep_cutoffs(scores, fractions).withColumn("cutoff", -F.col("cutoff"))
    langs = [c for c in cutoffs.columns if c != "pct"]
    stacked = cutoffs.select(
        F.col("pct"), F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("table_cutoff")) for c in langs])).alias("x")
    ).select(F.lit("language").alias("kind"), "pct", "x.key", "x.table_cutoff")
    stacked = stacked.groupBy("kind", "key", "pct").agg(F.min("table_cutoff").alias("table_cutoff"))
    return (
        found.withColumn("pct", F.round(F.col("fraction") * 100).cast("int"))
        .join(stacked, ["kind", "key", "pct"], "left")
        .select("kind", "key", "fraction", "cutoff", "kept", "scored", "table_cutoff")
    )


def p3_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_cutoffs(table(spark, sf_dir, "mined_docs"), table(spark, sf_dir, "cutoffs"))


P3_CUTOFFS_SQL = r"""
WITH base AS (
  SELECT CASE WHEN regexp_extract(lower(trim(language)), '^([^-_]+)', 1) <> ''
              THEN regexp_extract(lower(trim(language)), '^([^-_]+)', 1) ELSE 'und' END AS language,
         regexp_replace(regexp_replace(lower(coalesce(nullif(trim(source_domain), ''),
           regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))), '^.*@', ''), ':\d*$', '') AS host,
         perplexity
  FROM mined_docs WHERE perplexity > 0 AND NOT isnan(perplexity) AND NOT isinf(perplexity)),
scores AS (
  SELECT 'language' AS kind, language AS key, perplexity FROM base
  UNION ALL SELECT 'source_domain', nullif(host, ''), perplexity FROM base),
freq AS (SELECT kind, key, perplexity, count(*) AS n FROM scores GROUP BY ALL),
running AS (
  SELECT kind, key, perplexity,
         sum(n) OVER (PARTITION BY kind, key ORDER BY perplexity) AS kept,
         sum(n) OVER (PARTITION BY kind, key) AS scored
  FROM freq),
ranked AS (
  SELECT r.*, f.fraction, row_number() OVER (PARTITION BY kind, key, fraction
           ORDER BY abs(kept - fraction * scored), kept) AS rn
  FROM running r, (SELECT unnest([0.3::DOUBLE, 0.6::DOUBLE, 0.9::DOUBLE]) AS fraction) f),
tab AS (UNPIVOT (SELECT * FROM cutoffs) ON COLUMNS(* EXCLUDE pct) INTO NAME key VALUE table_cutoff)
SELECT r.kind, r.key, r.fraction, r.perplexity AS cutoff, r.kept::BIGINT AS kept, r.scored::BIGINT AS scored, t.table_cutoff
FROM ranked r LEFT JOIN tab t ON r.kind = 'language' AND t.key = r.key AND t.pct = round(r.fraction * 100)::INT
WHERE rn = 1
"""
