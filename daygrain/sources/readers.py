"""Reading sources with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from daygrain.operators.clean import nan_to_null
from daygrain.operators.lineage import add_lineage, record_hash
from daygrain.sources.schemas import ROAD_SOURCES, Source


def read_source(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "csv") -> DataFrame:
    """A headered CSV (or any built-in format) with a declared schema; NaN becomes null.

    CSV timestamps are read leniently: unreadable values become null. Whole numbers may be
    written with a fraction (``3.0``), as a column with gaps is by many writers; the fraction goes.
    """
    if fmt != "csv":
        return nan_to_null(spark.read.schema(schema).format(fmt).load(path))
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    whole = {f.name: f.dataType for f in declared if isinstance(f.dataType, IntegralType)}
    as_text = StructType([StructField(f.name, StringType()) if f.name in whole else f for f in declared])
    reader = spark.read.schema(as_text).options(header=True, mode="PERMISSIVE", enforceSchema=False)
    read = reader.csv(path).withColumns({c: _whole_number(F.col(f"`{c}`"), kind.simpleString()) for c, kind in whole.items()})
    return nan_to_null(read)


def _whole_number(text: Column, kind: str) -> Column:
    exact = F.trim(text).try_cast("bigint")
    return F.coalesce(exact, F.trim(text).try_cast("double").try_cast("bigint")).try_cast(kind)


def load_sources(
    spark: SparkSession,
    raw_dir: str,
    batch: str,
    extracted_at: str,
    sources: Mapping[str, Source] = ROAD_SOURCES,
    fmt: str = "csv",
    suffix: str = ".csv",
) -> dict[str, DataFrame]:
    """All sources as lazy tables with lineage columns and row hash."""
    return {
        name: record_hash(
            add_lineage(
                read_source(spark, f"{raw_dir}/{source.file}{suffix}", source.schema, fmt),
                source.system,
                batch,
                extracted_at,
            )
        )
        for name, source in sources.items()
    }
