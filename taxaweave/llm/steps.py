"""Tables written between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.session import shared_folder

_written: list[tuple[SparkSession, str]] = []


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    What follows no longer depends on the executors that made it. The tables
    are deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/taxaweave-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_clear)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that :func:`written` returned; nothing may read it any more."""
    names = {name.rsplit("/", 2)[-2] for name in df.inputFiles()}
    for spark, path in [w for w in _written if w[1].rsplit("/", 1)[-1] in names]:
        _delete(spark, path)
        _written.remove((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _clear() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session has ended before: the cluster clears its folder
            return


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with null as empty, whatever other columns there are."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
