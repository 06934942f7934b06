"""Problem 1: tokens per document and totals per slice."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.urls import bare_host
from siltworks.llm.bpe import counter, vocabulary
from siltworks.llm.common import bucket_key, language_key
from siltworks.session import materialize, table

#: Columns of the totals, and the slices they are given for.
SLICES = [
    (),
    ("language",),
    ("bucket",),
    ("language", "bucket"),
    ("cc_segment",),
    ("source_domain",),
    ("cc_segment", "language"),
    ("source_domain", "language"),
]


def token_counts(df: DataFrame, tokenizers: str | None = None) -> DataFrame:
    """One row per row of ``mined_docs``: ``mined_id, cc_segment, source_domain, language, bucket, tokens, method``.

    ``tokens`` is the number of pieces in ``tokenized`` (``method`` = ``pieces``). Where that is
    null or blank, ``raw_content`` is cut into symbols by ``byte_bpe_multi_50k``, merged on a
    linked list with a priority queue, and the surviving symbols, counted once per distinct word and weighted by its
    frequency, are scaled by pieces over symbols of all usable rows of the language (of all
    languages where it has none; 1 where there is none at all): ``method`` = ``estimate``. A row
    with no text either has 0 tokens, ``method`` = ``none``. Language, bucket and host come out in one spelling
    (``und``, ``other``, null). Repeated rows each count; further columns are not read.
    """
    path = vocabulary(tokenizers, "byte_bpe_multi_50k.tiktoken")

    def run(batches):
        count = counter(path).count
        for b in batches:
            tokenized, raw = (b.column(i).to_pylist() for i in (5, 6))
            pieces = pa.array([len(t.split()) if t else 0 for t in tokenized], pa.int64())
            symbols = pa.array([count(t) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pieces, symbols], names)

    slim = df.select(
        df["mined_id"].alias("mined_id"),
        df["cc_segment"].alias("cc_segment"),
        bare_host(df["source_domain"], df["url"]).alias("source_domain"),
        language_key(df["language"]).alias("language"),
        bucket_key(df["bucket"]).alias("bucket"),
        df["tokenized"].alias("tokenized"),
        df["raw_content"].alias("raw_content"),
    )
    names = ["mined_id", "cc_segment", "source_domain", "language", "bucket", "pieces", "symbols"]
    counted = materialize(
        slim.mapInArrow(
            run,
            "mined_id bigint, cc_segment string, source_domain string, language string, bucket string, "
            "pieces bigint, symbols bigint",
        ),
        "p1",
    )
    usable = counted.filter((F.col("pieces") > 0) & (F.col("symbols") > 0))
    # one row a language and one overall, both sums of partial sums
    ratios = usable.groupBy("language").agg(F.sum("pieces").alias("p"), F.sum("symbols").alias("s"))
    overall = usable.agg(F.coalesce(F.sum("pieces") / F.sum("symbols"), F.lit(1.0)).alias("overall"))
    scaled = counted.join(ratios, "language", "left").join(F.broadcast(overall))  # one row by construction
    estimate = F.round(F.col("symbols") * F.coalesce(F.col("p") / F.col("s"), F.col("overall"))).cast("bigint")
    return scaled.select(
        "mined_id",
        "cc_segment",
        "source_domain",
        "language",
        "bucket",
        F.when(F.col("pieces") > 0, F.col("pieces")).otherwise(estimate).alias("tokens"),
        F.when(F.col("pieces") > 0, "pieces").when(F.col("symbols") > 0, "estimate").otherwise("none").alias("method"),
    )


def token_budget(counts: DataFrame, slices: list[tuple[str, ...]] = SLICES) -> DataFrame:
    """Totals over ``token_counts``: ``slice`` (names joined by ``+``, ``all``), the four keys, ``docs, tokens, estimated_tokens``.

    Keys outside the slice are null; ``slice`` tells them from null keys. Exact bigint sums; partial sums are made
    before the shuffle, so a hot source costs one row a task. An empty table gives the row of the
    empty slice only, with 0 documents.
    """
    keys = ["cc_segment", "source_domain", "language", "bucket"]
    label = F.when(F.lit(False), "")
    for s in slices:
        mask = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s)
        label = label.when(F.grouping_id(*keys) == mask, "+".join(s) or "all")
    return (
        counts.groupingSets([[F.col(k) for k in s] for s in slices], *[F.col(k) for k in keys])
        .agg(
            label.alias("slice"),
            F.count("*").alias("docs"),
            F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
            F.coalesce(F.sum(F.when(F.col("method") == "estimate", F.col("tokens"))), F.lit(0)).alias("estimated_tokens"),
        )
        .select("slice", *keys, "docs", "tokens", "estimated_tokens")
    )


def p1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "mined_docs"))


def p1_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_budget(token_counts(table(spark, sf_dir, "mined_docs")))


def p1_piece_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the rows whose pieces are there, which SQL can count too."""
    return token_budget(token_counts(table(spark, sf_dir, "mined_docs")).filter("method = 'pieces'"))


def _budget_sql() -> str:
    keys = ["cc_segment", "source_domain", "language", "bucket"]
    space = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    rows = f"""SELECT cc_segment, nullif(regexp_replace(regexp_replace(lower(coalesce(nullif(trim(source_domain), ''),
        regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))), '^.*@', ''), ':\\d*$', ''), '') AS source_domain,
      coalesce(nullif(regexp_extract(lower(trim(language)), '^([^-_]+)', 1), ''), 'und') AS language,
      CASE WHEN lower(trim(bucket)) IN ('head', 'middle', 'tail', 'all') THEN lower(trim(bucket)) ELSE 'other' END AS bucket,
      len(list_filter(regexp_split_to_array(tokenized, '{space}'), lambda x: x <> '')) AS n FROM mined_docs"""
    parts = []
    for found in SLICES:
        columns = ", ".join(k if k in found else f"NULL::VARCHAR AS {k}" for k in keys)
        group = f"GROUP BY {', '.join(found)}" if found else ""
        parts.append(f"SELECT '{'+'.join(found) or 'all'}' AS slice, {columns}, count(*) AS docs, coalesce(sum(n), 0)::BIGINT AS tokens, 0::BIGINT AS estimated_tokens FROM r {group}")
    return f"WITH every AS ({rows}), r AS (SELECT * FROM every WHERE n > 0) " + " UNION ALL ".join(parts)


P1_PIECES_SQL = _budget_sql()
