"""Compact metadata of documents, and joining it back to texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.binding import let
from siltworks.functions.hashing import decode_line_ids, encode_line_ids

PUBLIC = ["url", "digest", "cc_segment"]
COMPUTED = ["language", "language_score", "perplexity", "bucket", "line_ids"]


def minify(df: DataFrame) -> DataFrame:
    """Public and computed fields only; ``line_ids`` packed, perplexity to one decimal, language score to two."""
    return df.select(
        *PUBLIC,
        "language",
        F.round("language_score", 2).alias("language_score"),
        F.round("perplexity", 1).alias("perplexity"),
        "bucket",
        encode_line_ids(df["line_ids"]).alias("line_ids"),
    )


def one_version(meta: DataFrame, keys: list[str], latest: list[str]) -> DataFrame:
    """One row per key, the last by ``latest``; nulls come first."""
    order = [F.col(c).desc_nulls_last() for c in latest]
    return meta.withColumn("rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("rn = 1").drop("rn")


def fetch_metadata(docs: DataFrame, meta: DataFrame, latest: list[str], once: bool = True, order: list[str] | None = None) -> DataFrame:
    """Documents whose (segment, digest) has metadata, with its fields over their own and only the lines it names.

    Of several rows of metadata the last counts. With ``once`` a row serves the first document of its key (by ``order``)
    and no other. Lines out of range are skipped. Keys with null never match.
    """
    keys = ["cc_segment", "digest"]
    known = one_version(meta.filter("cc_segment is not null and digest is not null"), keys, latest)
    fields = [c for c in ["url", *COMPUTED] if c in known.columns]
    known = known.select(*keys, *[F.col(c).alias(f"m_{c}") for c in fields])
    if once:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*(order or ["url"])))
        docs = docs.withColumn("rn", rank).filter("rn = 1").drop("rn")
    joined = docs.join(known, keys)
    lines = F.split("raw_content", "\n")
    ids = let(lines, lambda x: F.filter(decode_line_ids(F.col("m_line_ids")), lambda i: i < F.size(x)))
    body = let(lines, lambda x: F.array_join(F.transform(ids, lambda i: F.element_at(x, i + 1)), "\n"))
    out = joined.withColumns(
        {
            "original_nlines": F.size(lines),
            "original_length": F.length("raw_content"),
            "kept": F.coalesce(F.size(ids), F.lit(0)),
            "body": F.when(F.size(ids) > 0, body).otherwise(""),
        }
    )
    for c in fields:
        if c != "line_ids":
            out = out.withColumn(c, F.coalesce(f"m_{c}", c) if c in docs.columns else F.col(f"m_{c}"))
    out = out.withColumn("raw_content", F.col("body")).withColumn("nlines", F.col("kept")).withColumn("length", F.length("body"))
    return out.drop("body", "kept", *[f"m_{c}" for c in fields])


def paragraphs(docs: DataFrame, meta: DataFrame) -> DataFrame:
    """``cc_segment, digest, language, text, lm_score``: paragraphs that metadata with arrays ``line_ids, languages, lm_scores`` names.

    Ids beyond the document are skipped.
    """
    pieces = meta.select("cc_segment", "digest", F.explode(F.arrays_zip("line_ids", "languages", "lm_scores")).alias("p"))
    joined = docs.select("cc_segment", "digest", F.split("raw_content", "\n").alias("lines")).join(pieces, ["cc_segment", "digest"])
    inside = joined.filter((F.col("p.line_ids") >= 0) & (F.col("p.line_ids") < F.size("lines")))
    return inside.select("cc_segment", "digest", F.col("p.languages").alias("language"), F.get("lines", F.col("p.line_ids")).alias("text"), F.col("p.lm_scores").alias("lm_score"))


#: Languages with more text than the rest, taken from the latest snapshot only (fixed value).
BIG_LANGUAGES = (
    "es_XX",
    "fr_XX",
    "de_DE",
    "ja_XX",
    "ru_RU",
    "zh_CN",
    "en_XX",
    "it_IT",
    "ar_AR",
    "nl_XX",
    "pl_PL",
    "pt_XX",
    "tr_TR",
    "zh_TW",
)


def snapshot_filter(df: DataFrame, snapshot: str, latest: str, big: tuple[str, ...] = BIG_LANGUAGES, compat: bool = False) -> DataFrame:
    """Big languages only from the ``latest`` snapshot; with ``compat`` from none, as the original does by a slip."""
    if snapshot == latest and not compat:
        return df
    return df.filter(~F.coalesce(F.col("language").isin(*big), F.lit(False)))
