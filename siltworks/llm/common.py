"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def language_key(col: Column) -> Column:
    """Language in one spelling: lower case, no blanks, without a region; ``und`` for null or blank."""
    found = F.regexp_extract(F.lower(F.trim(col)), r"^([^-_]+)", 1)
    return F.when(found != "", found).otherwise("und")


def bucket_key(col: Column) -> Column:
    """Bucket in one spelling; ``other`` for null or unknown ones."""
    found = F.lower(F.trim(col))
    return F.when(found.isin("head", "middle", "tail", "all"), found).otherwise("other")


def tree_merge(parts: DataFrame, key: str, merge, last=None) -> DataFrame:
    """``key, part``: all binary ``part`` of a key made one by ``merge(list of bytes) -> bytes``, in two levels.

    The first level takes about the square root of the tasks' parts together, the second the rest, so that no worker holds all.
    """
    spark = parts.sparkSession
    tasks = max(1, parts.rdd.getNumPartitions())
    ways = math.isqrt(tasks - 1) + 1
    kind = dict(parts.dtypes)[key]

    def level(function):
        def run(group: pa.Table) -> pa.Table:
            return pa.table({key: group.column(key).slice(0, 1), "part": pa.array([function(group.column("part").to_pylist())], pa.binary())})

        return run

    once = parts.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(ways)))
    if tasks > 4 * spark.sparkContext.defaultParallelism:
        once = once.groupBy(key, "way").applyInArrow(level(merge), f"{key} {kind}, part binary")
    return once.groupBy(key).applyInArrow(level(last or merge), f"{key} {kind}, part binary")


def summed(df: DataFrame, columns: list[str], of) -> dict[str | None, np.ndarray]:
    """Sums over all rows of ``df``, by key: ``of`` makes ``{key: array}`` from an Arrow batch of ``columns``.

    Each task adds up its own arrays, which are merged on the executors; one array a key reaches the driver.
    """

    def local(batches):
        total: dict[str | None, np.ndarray] = {}
        for b in batches:
            for key, x in of(b).items():
                total[key] = total[key] + x if key in total else np.asarray(x, np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["key", "part"])

    def merge(parts):
        return np.sum([np.frombuffer(x, np.float64) for x in parts], axis=0).tobytes()

    rows = tree_merge(df.select(*columns).mapInArrow(local, "key string, part binary"), "key", merge).toArrow().to_pylist()
    return {r["key"]: np.frombuffer(r["part"], np.float64) for r in rows}


def bucketed_table(spark: SparkSession, path: str, columns: str, by: str, buckets: int) -> str:
    """The name of a Parquet table in ``path``, bucketed and sorted by ``by``; made, or found again where another session left it."""
    name = f"siltworks_{zlib.crc32(path.encode()):08x}"
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return name


#: Counts are kept as levels of one byte each, the powers of a base; the highest level is beyond 2 ** 63.
BASE = 2 ** (63 / 254)


def to_levels(counts: np.ndarray) -> np.ndarray:
    """The least level at which ``level_counts`` is no smaller than the count."""
    level = np.ceil(np.log(np.maximum(counts, 1)) / math.log(BASE) - 1e-9) + 1
    return np.where(counts > 0, level, 0).astype(np.uint8)


def level_counts(levels: np.ndarray) -> np.ndarray:
    steps = np.concatenate([[0.0], BASE ** np.arange(255, dtype=np.float64)])
    return steps[levels]


#: Counters in one part of a table of counts.
PART = 1 << 17


def count_parts(counts: np.ndarray) -> list[tuple[int, bytes]]:
    """A task's own table of counts as compressed parts, those without any count left out."""
    parts = ((i, counts[i : i + PART]) for i in range(0, len(counts), PART))
    return [(i, zlib.compress(x.astype(np.uint32).tobytes(), 1)) for i, x in parts if x.any()]


def merged_levels(parts: DataFrame, size: int) -> np.ndarray:
    """The levels of ``size`` counters from ``at, part`` rows of all tasks; a byte a counter, compressed, reaches the driver."""

    def numbers(data):
        return np.frombuffer(zlib.decompress(data), np.uint32)

    def merge(found):
        return zlib.compress(sum((numbers(x).astype(np.uint64) for x in found[1:]), numbers(found[0]).astype(np.uint64)).astype(np.uint32).tobytes(), 1)

    def last(found):
        total = sum((numbers(x).astype(np.uint64) for x in found[1:]), numbers(found[0]).astype(np.uint64))
        return zlib.compress(to_levels(total).tobytes(), 6)

    out = np.zeros(size, np.uint8)
    for row in tree_merge(parts, "at", merge, last).toArrow().to_pylist():
        x = np.frombuffer(zlib.decompress(row["part"]), np.uint8)
        out[row["at"] : row["at"] + len(x)] = x
    return out


#: Width and number of the bins of -ln p over which false discovery is controlled.
BIN, BINS = 0.01, 100_000


def with_bin(tests: DataFrame, g: str = "g") -> DataFrame:
    """Adds ``bin`` of -ln p, where p = exp(-g / 2) bounds the tail of a log-likelihood ratio ``g``."""
    return tests.withColumn("bin", F.least(F.floor(F.col(g) / 2 / BIN), F.lit(BINS)).cast("int"))


def discovery_limit(tests: DataFrame, fdr: float) -> int:
    """The least ``bin`` that is significant after Benjamini and Hochberg; beyond all bins if none is.

    Only the histogram over bins, of fixed size, reaches the driver.
    """
    counts = sorted(((r["bin"], r["n"]) for r in tests.groupBy("bin").agg(F.count("*").alias("n")).collect()), reverse=True)
    m, seen, limit = sum(n for _, n in counts), 0, BINS + 1
    for b, count in counts:
        seen += count
        if math.exp(-b * BIN) <= fdr * seen / m:
            limit = b
    return limit
