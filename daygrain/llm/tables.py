"""Intermediate tables in the shared folder, and tables dealt out by range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions.storage import remove, shared_dir

#: A side of a join is broadcast up to this many rows of a few numbers each; beyond, Spark joins by key.
BROADCAST_ROWS = 500_000


class Stored:
    """Writes tables to the folder of ``spark.checkpoint.dir``, reads them back and can drop them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame) -> DataFrame:
        path = shared_dir(self.spark, "llm")
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later plan reads."""
        found = next(x for x in self.paths if x[0] is df)
        self.paths.remove(found)
        remove(self.spark, found[1])

    def swap(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Store ``new``, then delete ``old``, from which it was made."""
        out = self.put(new)
        self.drop(old)
        return out


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its row count (counted unless given) is within the limit."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= limit else df


def row_keys(df: DataFrame) -> dict[str, Column]:
    """Two hashes of a whole row, map columns aside, by which rows that were reduced to a few columns are found again."""
    kinds = dict(df.dtypes)
    columns = [F.col(f"`{c}`") for c in df.columns if "map<" not in kinds[c]]
    return {"k1": F.xxhash64(*columns), "k2": F.xxhash64(F.lit(2), *columns)}


def parts_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Number of partitions so that each holds about ``rows_each`` rows, a few per shuffle partition at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def ranged(df: DataFrame, keys: Sequence[str | Column], stored: Stored, parts: int) -> DataFrame:
    """The rows dealt to ``parts`` sorted ranges and stored, with ``_part`` (range) and ``_at`` (place in it).

    Both are fixed by the stored files, so a lost executor cannot renumber them. Give enough keys
    to tell the rows of a hot key apart, or its rows stay in one range.
    """
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    return stored.put(
        dealt.withColumns({"_part": F.shiftright(place, 33), "_at": place.bitwiseAND(F.lit((1 << 33) - 1))})
    )


def numbered(df: DataFrame, keys: Sequence[str | Column], stored: Stored, rows_each: int = 500_000) -> DataFrame:
    """The rows, stored, with ``_n``: their place from 0 in the order of ``keys``, without one task for all.

    Places are counted within sorted ranges; the ranges' first places, one row a range, are broadcast.
    """
    rows = stored.put(df)
    sorted_ = ranged(rows, keys, stored, parts_for(df.sparkSession, rows.count(), rows_each))
    stored.drop(rows)
    first, at = [], 0
    for part, size in sorted(sorted_.groupBy("_part").count().collect()):
        first.append((part, at))
        at += size
    starts = F.broadcast(df.sparkSession.createDataFrame(first, "_part long, _first long"))
    out = sorted_.join(starts, "_part").withColumn("_n", F.col("_first") + F.col("_at"))
    return out.drop("_part", "_at", "_first")
