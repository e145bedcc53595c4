"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set (tests, one machine)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="queryset-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/queryset-{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, without lineage.

    Task commits make it safe against lost or repeated tasks; a later loss of an
    executor re-reads the files. ``compact`` writes sorted integers as differences.
    """
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.options(**{"parquet.writer.version": "v2"} if compact else {}).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def checkpointed(frame: DataFrame) -> DataFrame:
    """checkpoint() into the shared folder, for small frames of iterative jobs."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


#: A key of more than one in so many rows is hot; so there are fewer hot keys than that.
HOT_SHARE = 1000


def by_key(rows: DataFrame, found: DataFrame, key: str, count: str) -> DataFrame:
    """Rows inner-joined with ``found``, which has each key once and in ``count`` how many rows have it.

    Rows of hot keys meet a broadcast of fewer than HOT_SHARE rows, whatever the size of
    the tables, so no key makes one large task. Both sides should be written tables.
    """
    limit = (found.agg(F.sum(count).alias("n")).first()["n"] or 0) // HOT_SHARE
    hot, others = found.where(F.col(count) > limit), found.where(F.col(count) <= limit)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(cold.join(others, key))


def row_hash(frame: DataFrame):
    """A hash of all columns that Spark can hash (those that hold maps are left out)."""
    names = [f.name for f in frame.schema.fields if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    return F.xxhash64(*(F.col(f"`{n}`") for n in sorted(names)))


def free(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
