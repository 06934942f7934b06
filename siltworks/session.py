"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def build_session(app: str = "siltworks", master: str | None = None, shared: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution, skew joins and UTC; ``conf`` keys use ``__`` for dots.

    ``shared`` is the folder, reachable from all executors, for steps that are written out (``spark.checkpoint.dir``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    if shared:
        settings["spark.checkpoint.dir"] = shared
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Where neither is set, a local master (tests) gets a fresh local folder; on a cluster that is an error, as every executor
    would see another disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="siltworks-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below the shared folder and read it back.

    A lost executor then costs a re-read, not a recomputation. The folder is removed when the
    driver's Python ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``df``, once nothing reads it any more."""
    _delete(df.sparkSession, df.written_to)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with stars."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(f.getPath().toString() for f in found or [])


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch() -> None:
    """Delete every folder ``materialize`` wrote."""
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the context may be gone already
            local = path.removeprefix("file://")
            if os.path.isdir(local):
                import shutil

                shutil.rmtree(local, ignore_errors=True)


atexit.register(drop_scratch)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as there are cores where it comes in half as many or fewer, as one small file does."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df
