"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "taxaweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes.

    Adaptive execution sizes shuffle partitions, splits skewed join partitions
    and switches to a broadcast join only on the measured size of a side.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder under /tmp in local mode only."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="taxaweave-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Iterative jobs then survive lost executors, their plans stay short, and
    the planner knows the true size of every step's result, which a plan grown
    over many rounds of joins would only guess.
    """
    path = f"{shared_folder(df.sparkSession)}/taxaweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the table behind what :func:`cut_lineage` returned, once its successor is written; nothing may read it any more."""
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    spark = df.sparkSession
    for folder in folders:
        if folder.rsplit("/", 1)[-1].startswith("taxaweave-"):
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
