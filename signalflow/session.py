"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# AQE sizes shuffle partitions at run time from this initial number; a cluster
# sets it to a few times its core count, a laptop keeps it near the core count.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # capturing the call site of every expression costs a good part of building a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "signalflow", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, falls back to a temporary folder.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if base:
        return base
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="signalflow-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def written(df, label: str):
    """Write ``df`` once below the shared folder and read it back.

    Cuts the lineage of a frame that several later jobs read; unlike a cache it
    survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def spread(df):
    """Give a scan at least one task per core, for CPU-heavy work on few or unsplittable files.

    A scan that already has as many partitions as the cluster has cores, as any large
    one does, is returned unchanged and is not shuffled. Call it on plain scans only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def literal_rows(spark: SparkSession, names, rows):
    """Small configuration table from literals: stays in the JVM, where ``createDataFrame`` starts Python workers."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
