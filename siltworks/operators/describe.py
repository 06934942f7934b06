"""Statistics of fields: presence, mean length, labels, histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def presence(df: DataFrame, columns: list[str]) -> DataFrame:
    """``field, total, present, avg_length``: in one pass over the table. Null is absent; lengths are those of the text."""
    aggs = [F.count("*").alias("total")]
    for c in columns:
        aggs += [F.count(df[c]).alias(f"n_{c}"), F.avg(F.length(df[c].cast("string"))).alias(f"l_{c}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("present"), F.col(f"l_{c}").alias("avg_length")) for c in columns])
    return one.select("total", F.explode(rows).alias("x")).select("x.field", "total", "x.present", "x.avg_length")


def label_counts(df: DataFrame, field: str, top: int = 100, least: int = 5, longest: int = 100) -> DataFrame:
    """``label, n``: the ``top`` most frequent values of at most ``longest`` characters that occur ``least`` times or more."""
    short = df.select(df[field].alias("label")).filter(F.length("label") <= longest)
    counts = short.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return counts.orderBy(F.desc("n"), "label").limit(top)


def bin_of(value: Column, low: float | Column, high: float | Column, bins: int) -> Column:
    """0-based equal-width bin; the last one is closed. Null outside the range."""
    at = F.floor((value - low) / (high - low) * bins).cast("int")
    return F.when(value == high, bins - 1).when((value >= low) & (value < high), F.least(at, F.lit(bins - 1)))


def histogram(df: DataFrame, field: str, bins: int, weight: str | None = None, low: float | None = None, high: float | None = None) -> DataFrame:
    """``bin, low, high, n``: equal-width bins between the least and greatest value, or given edges; empty bins too.

    Edges never depend on the weights.
    """
    x = df[field].cast("double")
    values = df.select(x.alias("x"), (df[weight].cast("double") if weight else F.lit(1.0)).alias("w")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    if low is None or high is None:
        # one row; the cross join below attaches two numbers
        edges = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    else:
        edges = df.sparkSession.range(1).select(F.lit(float(low)).alias("lo"), F.lit(float(high)).alias("hi"))
    placed = values.join(F.broadcast(edges)).select(bin_of(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"), "w")
    counts = placed.filter("bin is not null").groupBy("bin").agg(F.sum("w").alias("n"))
    frame = edges.filter("lo is not null").select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("low"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0.0)).alias("n"),
    )


def automatic_bins(df: DataFrame, value: Column) -> int:
    """Number of bins by the narrower of Sturges' and Freedman and Diaconis' widths, from one row of quantiles; at least 1."""
    x = df.select(value.cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    q = F.percentile_approx("x", F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000))
    r = x.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), q.alias("q")).first()
    if not r["n"] or r["hi"] == r["lo"]:
        return 1
    width = (r["hi"] - r["lo"]) / (math.log2(r["n"]) + 1)
    spread = 2 * (r["q"][1] - r["q"][0]) / r["n"] ** (1 / 3)
    return math.ceil((r["hi"] - r["lo"]) / (min(width, spread) if spread else width))


def describe(df: DataFrame, columns: list[str] | None = None, weights: str | None = None, bins: int | list[float] | str = "auto", running: bool = False) -> DataFrame:
    """Statistics of fields as rows ``field, kind, label, low, high, n``.

    ``present``: documents that have the field. ``length``: mean length of texts. ``label``: of fields with mean length under 100 the most frequent
    values that occur more than once; of maps their keys. ``bin``: a histogram of numbers, lists of numbers flattened, weighted by another field,
    with edges between least and greatest value or those given; with ``running`` counts add up.
    """
    parts = []
    one = "field string, kind string, label string, low double, high double, n double"

    def rows(found: DataFrame, field: str, kind: str, label=None, low=None, high=None, n="n") -> DataFrame:
        return found.select(F.lit(field).alias("field"), F.lit(kind).alias("kind"), (F.col(label).cast("string") if label else F.lit(None).cast("string")).alias("label"),
                            *[(F.col(x) if x else F.lit(None)).cast("double").alias(c) for c, x in (("low", low), ("high", high), ("n", n))])

    for c in columns or df.columns:
        kind = df.schema[c].dataType
        parts.append(rows(df.agg(F.count(df[c]).alias("n")), c, "present"))
        if isinstance(kind, T.StringType):
            parts.append(rows(df.agg(F.avg(F.length(c)).alias("n")), c, "length"))
            short = df.agg(F.coalesce(F.avg(F.length(c)), F.lit(0.0)) < 100).first()[0]
            if short:
                parts.append(rows(label_counts(df, c, least=2), c, "label", label="label"))
        elif isinstance(kind, (T.MapType, T.StructType)):
            names = F.map_keys(c) if isinstance(kind, T.MapType) else F.json_object_keys(F.to_json(c))
            parts.append(rows(label_counts(df.select(F.explode(names).alias("label")), "label", least=1), c, "label", label="label"))
        else:
            lists = isinstance(kind, T.ArrayType)
            if not isinstance(kind.elementType if lists else kind, T.NumericType):
                continue
            weight = [df[weights].alias("w")] if weights else []
            x = df.select((F.explode(c) if lists else df[c]).alias("x"), *weight)
            edges = bins if isinstance(bins, list) else None
            count = len(edges) - 1 if edges else bins if isinstance(bins, int) else automatic_bins(x, F.col("x"))
            hist = histogram_edges(x, "x", edges, "w" if weights else None) if edges else histogram(x, "x", count, "w" if weights else None)
            hist = cumulative(hist) if running else hist
            parts.append(rows(hist, c, "bin", low="low", high="high", n="upto" if running else "n"))
    empty = df.sparkSession.createDataFrame([], one)
    for p in parts:
        empty = empty.union(p)
    return empty


def histogram_edges(df: DataFrame, field: str, edges: list[float], weight: str | None = None) -> DataFrame:
    """``bin, low, high, n`` between given edges in rising order; the last bin is closed, values outside do not count."""
    x, w = df[field].cast("double"), df[weight].cast("double") if weight else F.lit(1.0)
    inside = df.select(x.alias("x"), w.alias("w")).filter(F.col("x").between(edges[0], edges[-1]))
    at = F.least(F.size(F.filter(F.array(*map(F.lit, map(float, edges[1:]))), lambda e: e <= F.col("x"))), F.lit(len(edges) - 2))
    counts = inside.groupBy(at.alias("bin")).agg(F.sum("w").alias("n"))
    frame = df.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))], "bin int, low double, high double")
    return frame.join(F.broadcast(counts), "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0.0)).alias("n"))


def cumulative(hist: DataFrame) -> DataFrame:
    """A histogram with running totals ``upto``; as many rows as it has bins."""
    return hist.withColumn("upto", F.sum("n").over(W.orderBy("bin")))


def parse_bins(text: str) -> int | list[float] | str:
    """``"5"`` is a number of bins, ``"1,2"`` edges, anything else the name of a rule."""
    if text.isdigit():
        return int(text)
    return [float(x) for x in text.split(",")] if "," in text else text


def bar_chart(counts: list[float], width: int = 80) -> str:
    """Bars of a small histogram as text, the highest ``width`` wide."""
    most = max(counts, default=0) or 1
    return "\n".join("█" * round(width * n / most) for n in counts)
