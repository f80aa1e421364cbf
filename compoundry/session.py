"""Session settings, and the durable place where long lineages are cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set only where the session leaves the Spark default. Skew splitting may add a shuffle: a hot key in one
# task costs more than that.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}
#: Of texts it leaves less than half of what Spark's default does.
SCRATCH_CODEC = "zstd"


def build_session(app: str = "compoundry", master: str | None = None, **conf: str) -> SparkSession:
    """A session; on a cluster, ``master`` and sizes come from the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; where that is unset, one inside the warehouse folder,
    which a cluster shares too. Only a local session, whose one process is driver and executor, takes a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return os.path.join(tempfile.gettempdir(), f"compoundry-{spark.sparkContext.applicationId}")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/compoundry-scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; nothing is ever reused or overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs read to the shared folder and read it back.

    Unlike a cache, the written table survives lost executors, keeps the driver out of the data, and
    lets each reader prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", SCRATCH_CODEC).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def settled(df: DataFrame, label: str) -> DataFrame:
    """``durable``, and what ``df`` was made from and only it reads (its ``_made_from``) is removed."""
    out = durable(df, label)
    discard(*getattr(df, "_made_from", []))
    return out


def discard(*frames: DataFrame) -> None:
    """Remove what ``durable`` wrote, and have Spark drop shuffles nobody refers to.

    Only frames that ``durable`` returned itself can be given, and none that is read later, also by a result that isn't
    computed yet.
    """
    for frame in frames:
        jvm = frame.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(frame._scratch)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if frames:
        release(frames[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of plans that nobody refers to; they go when the plans are collected. For use
    after a table of texts or lines is written."""
    spark._jvm.System.gc()
