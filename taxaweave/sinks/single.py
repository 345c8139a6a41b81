"""One document from ordered part files.

Part files are written by many tasks; joining them streams their bytes through the driver, a buffer at a time, into a file
beside the target, which then takes the target's name. A job that breaks off leaves the old document as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def join_parts(spark: SparkSession, folder: str, target: str) -> None:
    """Join the part files of ``folder``, in the order of their names, to the single file ``target``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    source, goal, fresh = path(folder), path(target), path(f"{target}.{uuid.uuid4().hex}")
    files = source.getFileSystem(conf)
    if not files.exists(path(source, "_SUCCESS")):
        raise ValueError(f"{folder} was not written to its end")
    names = sorted(x.getPath().getName() for x in files.listStatus(source) if x.getPath().getName().startswith("part-"))
    there = goal.getFileSystem(conf)
    out = there.create(fresh, True)
    try:
        for name in names:
            part = files.open(path(source, name))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            part.close()
    finally:
        out.close()
    if there.exists(goal):
        there.delete(goal, False)
    if not there.rename(fresh, goal):
        raise OSError(f"could not name {target}")
