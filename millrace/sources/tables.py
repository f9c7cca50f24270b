"""Written tables that cut a plan's lineage, in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path under spark.checkpoint.dir. Where the session has none, local mode sets one beside the warehouse; on a
    cluster that is an error, as executors would write to their own disks."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = known.get() if known.isDefined() else None
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Paths written inside each open scratch().
_open: list[list[str]] = []


def table(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it again: short lineage that outlives its executors. The folder goes when the
    driver ends, or earlier with the scratch() around it unless it is to be kept."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    if _open and not keep:
        _open[-1].append(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables written inside when the block ends; what it computes must be written by then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            _delete(spark, path)
