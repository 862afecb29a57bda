"""Plan barriers.

Stacked windows make Spark's planner compare orderings over and over, at a cost that doubles with each
level, and nested caches make it print their plans over and over. A table written in between is a plain
leaf to the planner, is computed once for all that read it, and outlives lost executors.

Tables lie in a folder of the application in ``spark.checkpoint.dir``. Where that is unset, a session in one
process gets a temporary folder, which goes at exit, and a cluster the warehouse, as its machines share no
temporary folder. ``drop_tables`` deletes what was written since a mark.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="quillstack-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return "file://" + _own[0]


def table_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    path = f"{shared_dir(spark)}/quillstack/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def held(df: DataFrame, name: str = "plan", codec: str = "snappy", release: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, survives executors.

    ``release`` makes the driver's JVM collect what is done with, upon which Spark deletes its shuffle files. The last job is let
    go only after a first collection.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    if release:
        spark._jvm.System.gc()
        time.sleep(0.3)
        spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    return len(_written)


def last_table() -> tuple[str, ...]:
    return tuple(_written[-1:])


def drop_tables(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete the tables written since a mark but for some paths: their readers have to be done."""
    for path in [p for p in _written[since:] if p not in keep]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _written.remove(path)
