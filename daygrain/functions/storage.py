"""Shared storage named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def checkpoint_base(spark: SparkSession) -> str:
    """The folder that the session names; where it names none, a folder in its warehouse.

    Executors share both. The session's settings are read and never changed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    return base.rstrip("/") if base else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the checkpoint folder."""
    _written.append(f"{checkpoint_base(spark)}/{purpose}-{uuid.uuid4().hex}")
    return _written[-1]


def reliable(df: DataFrame) -> DataFrame:
    """The table written to shared storage and read back.

    Later plans restart from files that outlive the executors, and since the files are
    columnar they read only the columns they use and know the table's size.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_stored(spark: SparkSession) -> int:
    """At the end of a run: delete what this process stored; tables that read it are of no use then."""
    paths, _written[:] = list(_written), []
    for path in paths:
        remove(spark, path)
    return len(paths)
