"""Profiling tables: data dictionary, sample values, sensitivity."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import fields

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from daygrain.functions.scalars import ColumnOrName, as_column
from daygrain.names import GENERIC, LINEAGE, SOURCE_ROLES, Names
from daygrain.operators.aggregates import DERIVED
from daygrain.operators.ranking import union_all

#: Types whose values Arrow orders as Spark does.
ORDERED = (BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType)
DEFAULT_DESCRIPTION = "Field without a description"
# Name patterns of columns that are not public.
INTERNAL_PATTERNS = (
    "incident_id",
    "violation_id",
    "sensor_id",
    "record_hash",
    "ingest_batch_id",
    "extracted_at_utc",
    "driver_age_band",
    "source_system",
)


def column_descriptions(names: Names = GENERIC) -> dict[str, str]:
    """What each column is, told from its role in the sources or from its definition."""
    grain = ", ".join(names.grain)
    out = {}
    for table, roles in SOURCE_ROLES.items():
        for role in roles:
            column = getattr(names, role)
            out[column] = f"{out[column]}, {table}" if column in out else f"{role.replace('_', ' ')} of {table}"
    out |= {c: f"{c.replace('_', ' ')} of registry" for c in names.measures}
    out |= {c: f"lineage: {c.replace('_', ' ')}" for c in (*LINEAGE, "extracted_at_utc")}
    roles = {f.name: getattr(names, f.name) for f in fields(names)}
    out |= {c: f"{text.format(**roles)} by {grain}" for c, text in DERIVED.items()}
    out[names.day] = f"day of {names.ts}"
    return out


def _null_rates(df: DataFrame) -> DataFrame:
    aggs = [F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    return df.agg(F.count("*").alias("_rows"), *aggs)


def data_dictionary(
    tables: Mapping[str, DataFrame], descriptions: Mapping[str, str] | None = None, names: Names = GENERIC
) -> DataFrame:
    """One row per table and column: type, null rate, description, table size. One pass per table."""
    texts = column_descriptions(names) if descriptions is None else descriptions
    parts = []
    for name, df in tables.items():
        rows = [
            F.struct(
                F.lit(name).alias("dataset"),
                F.lit(i).alias("position"),
                F.lit(column).alias("column"),
                F.lit(dtype).alias("dtype"),
                F.col(f"n{i}").alias("null_rate"),
                F.lit(texts.get(column, DEFAULT_DESCRIPTION)).alias("description"),
                F.col("_rows").alias("rows"),
                F.lit(len(df.columns)).alias("columns"),
            )
            for i, (column, dtype) in enumerate(df.dtypes)
        ]
        parts.append(_null_rates(df).select(F.inline(F.array(*rows))))
    return union_all(parts)


class _Least:
    """The smallest distinct values of a column within a task, and its null count."""

    def __init__(self, n: int) -> None:
        self.n, self.nulls = n, 0
        self.values: pa.Array | None = None

    def add(self, column: pa.Array) -> None:
        self.nulls += column.null_count
        fresh = column.drop_null()
        if self.values is not None and len(self.values) == self.n:
            last = self.values[self.n - 1]
            if pa.types.is_floating(fresh.type) and math.isnan(last.as_py()):  # NaN is above all numbers
                fresh = fresh.filter(pc.invert(pc.is_nan(fresh)))
            else:
                fresh = fresh.filter(pc.less(fresh, last))
        if len(fresh):
            both = pc.unique(fresh if self.values is None else pa.concat_arrays([self.values, fresh]))
            self.values = both.take(pc.array_sort_indices(both)[: self.n])


def _one_zero(column: Column, kind: DataType) -> Column:
    """The column as ``kind``; -0.0 becomes 0.0, as Spark groups them and Arrow does not."""
    column = column.cast(kind)
    if isinstance(kind, (DoubleType, FloatType)):
        column = F.when(column == 0, F.lit(0.0).cast(kind)).otherwise(column)
    return column


def column_samples(df: DataFrame, n: int = 3) -> DataFrame:
    """Per column: null share in percent and its ``n`` smallest distinct values as text.

    The table is read once. A task keeps ``n`` values a column and passes them on beside its counts, so
    ``(n + 1) * columns`` small rows a task are shuffled, and merged by value before a column's first ``n`` are picked.
    Arrays, structs, maps and other types without an order in Arrow are sampled as text. NaN is above all numbers.
    An empty table has null shares and no samples; a name may come twice.
    """
    names, types = df.columns, [field.dataType for field in df.schema.fields]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "position int, column string, dtype string, null_pct double, samples string"
        )
    ordered = [t if isinstance(t, ORDERED) else StringType() for t in types]
    shown = [t.simpleString() for t in types]
    kinds = list(dict.fromkeys(t.simpleString() for t in ordered))
    slots = [kinds.index(t.simpleString()) for t in ordered]
    plain = df.toDF(*[f"c{j}" for j in range(len(names))])
    plain = plain.select(*[_one_zero(F.col(f"c{j}"), t).alias(f"c{j}") for j, t in enumerate(ordered)])
    value_names = [f"v{k}" for k in range(len(kinds))]

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, rows = [_Least(n) for _ in slots], 0
        arrow = {}
        for batch in batches:
            rows += batch.num_rows
            for column, slot, values in zip(columns, slots, batch.columns, strict=True):
                column.add(values)
                arrow[slot] = values.type
        if not rows:
            return
        for position, (column, slot) in enumerate(zip(columns, slots, strict=True)):
            values = pa.nulls(0, arrow[slot]) if column.values is None else column.values
            size = len(values) + 1  # the first row is that of the counts
            counts = [pa.array([x] + [0] * (size - 1), pa.int64()) for x in (rows, column.nulls)]
            parts = [
                pa.concat_arrays([pa.nulls(1, kind), values]) if k == slot else pa.nulls(size, kind)
                for k, kind in sorted(arrow.items())
            ]
            arrays = [pa.array([position] * size, pa.int32()), *counts, *parts]
            yield pa.RecordBatch.from_arrays(arrays, names=["position", "n_rows", "n_nulls", *value_names])

    typed = [f"{v} {kind}" for v, kind in zip(value_names, kinds, strict=True)]
    schema = ", ".join(["position int, n_rows long, n_nulls long", *typed])
    found = plain.mapInArrow(least, schema).groupBy("position", *value_names)
    found = found.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"))
    order = [F.col(v).asc_nulls_first() for v in value_names]
    place = F.row_number().over(W.partitionBy("position").orderBy(*order))
    first = found.withColumn("_place", place).where(F.col("_place") <= n + 1)
    text = F.coalesce(*[F.col(v).cast("string") for v in value_names])
    merged = first.groupBy("position").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct("_place", text.alias("text"))))).alias("found"),
    )
    described = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype")) for c, t in zip(names, shown, strict=True)]
    every = F.posexplode(F.array(*described))
    listed = df.sparkSession.range(1).select(every.alias("position", "c")).select("position", "c.*")
    null_pct = F.round(F.col("n_nulls") / F.col("n_rows") * 100, 1)
    samples = F.coalesce(F.array_join("found.text", ", "), F.lit(""))
    return listed.join(merged, "position", "left").select(
        "position", "column", "dtype", null_pct.alias("null_pct"), samples.alias("samples")
    )


def table_samples(tables: Mapping[str, DataFrame], n: int = 3) -> DataFrame:
    """``column_samples`` of every table, with its name as ``dataset``; one read of each."""
    return union_all([column_samples(df, n).select(F.lit(name).alias("dataset"), "*") for name, df in tables.items()])


def sensitivity_class(name: ColumnOrName) -> Column:
    """INTERNAL if the lower-case name holds one of the patterns, else PUBLIC."""
    lowered = F.lower(as_column(name))
    internal = F.lit(False)
    for pattern in INTERNAL_PATTERNS:
        internal = internal | lowered.contains(pattern)
    return F.when(internal, "INTERNAL").otherwise("PUBLIC")
