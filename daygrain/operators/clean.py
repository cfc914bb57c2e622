"""Cleaning, projection and filter operators, and the standard cleaning of the five sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.functions.order_stats import exact_percentile_of_table
from daygrain.functions.scalars import clip, event_day, fill_clip_int, null_if_nan, parse_ts_lenient
from daygrain.names import GENERIC, UNKNOWN, Names

ALL = "All"
# Accepted ranges of the cleaned measures.
LIMITS = {
    "injuries": (0, 0, 20),
    "fatalities": (0, 0, 10),
    "vehicles": (1, 1, 30),
    "amount": (0, 0, 10_000),
    "volume": (0, 0, 500),
}
SPEED_RANGE = (0.0, 220.0)


def dedupe_keys(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column] = ()) -> DataFrame:
    """First row per key in the given order (all other columns when none is given).

    Spark keeps one row per key and task before the shuffle, so a repeated key sends
    at most one row from each task.
    """
    order = list(order_cols) or [c for c in df.columns if c not in keys] or list(keys)
    window = W.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    )
    return df.withColumn("_first", F.row_number().over(window)).where("_first = 1").drop("_first")


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null, the only missing value used elsewhere."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: null_if_nan(c) for c in floats}) if floats else df


def fill_median_clip(
    df: DataFrame, col: str, lo: float, hi: float, exact: bool = True, accuracy: int = 10_000, **limits: int
) -> DataFrame:
    """Null becomes the table-wide median of the values before limiting; then limit to ``[lo, hi]``.

    The median is a scalar subquery. ``exact=False`` takes it from a quantile sketch.
    """
    if exact:
        median = exact_percentile_of_table(df, col, {"_median": 0.5}, **limits)
    else:
        median = df.agg(F.percentile_approx(col, 0.5, accuracy).alias("_median"))
    filled = df.withColumn(col, F.coalesce(F.col(col), median.scalar()))
    return filled.withColumn(col, clip(col, lo, hi))


def default_fill(df: DataFrame, str_cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Named text columns get ``Unknown``, every other column but the keys gets 0."""
    values = {c: UNKNOWN for c in str_cols if c in df.columns}
    values.update({c: 0 for c in df.columns if c not in keys and c not in str_cols})
    return df.fillna(values)


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Those of the columns that exist, in the order asked for."""
    return df.select(*[c for c in cols if c in df.columns])


def min_support(df: DataFrame, col: str, n: int) -> DataFrame:
    """Groups whose count reaches ``n``."""
    return df.where(F.col(col) >= n)


def slice_filter(
    df: DataFrame,
    region: str = ALL,
    kind: str = ALL,
    start: date | str | None = None,
    end: date | str | None = None,
    names: Names = GENERIC,
) -> DataFrame:
    """Rows of one region, kind and inclusive day range; ``All`` and ``None`` mean no limit.

    A condition on a column the table lacks is left out.
    """
    if region != ALL and names.region in df.columns:
        df = df.where(F.col(names.region) == region)
    if kind != ALL and names.kind in df.columns:
        df = df.where(F.col(names.kind) == kind)
    if names.day in df.columns:
        if start is not None:
            df = df.where(F.col(names.day) >= F.lit(start).cast("date"))
        if end is not None:
            df = df.where(F.col(names.day) <= F.lit(end).cast("date"))
    return df


def slice_domain(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    """(field, value) rows: distinct regions and kinds, first and last day."""
    pairs = df.groupBy(names.region, names.kind).agg(
        F.min(names.day).alias("_min"), F.max(names.day).alias("_max")
    )
    fields = F.array(
        F.struct(F.lit("region").alias("field"), F.col(names.region).alias("value")),
        F.struct(F.lit("kind").alias("field"), F.col(names.kind).alias("value")),
    )
    choices = pairs.select(F.inline(fields)).where("value is not null").distinct()
    days = pairs.agg(F.min("_min").alias("_min"), F.max("_max").alias("_max")).select(
        F.inline(
            F.array(
                F.struct(F.lit("min_date").alias("field"), F.col("_min").cast("string").alias("value")),
                F.struct(F.lit("max_date").alias("field"), F.col("_max").cast("string").alias("value")),
            )
        )
    )
    return choices.unionByName(days).orderBy("field", "value")


def clean_incident(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    df = df.withColumn(names.ts, parse_ts_lenient(names.ts))
    df = require_not_null(df, [names.incident, names.entity, names.ts])
    return df.withColumns(
        {
            names.injuries: fill_clip_int(names.injuries, *LIMITS["injuries"]),
            names.fatalities: fill_clip_int(names.fatalities, *LIMITS["fatalities"]),
            names.vehicles: fill_clip_int(names.vehicles, *LIMITS["vehicles"]),
            names.day: event_day(names.ts),
        }
    )


def clean_typed(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    df = df.withColumn(names.ts, parse_ts_lenient(names.ts))
    df = require_not_null(df, [names.typed_id, names.entity, names.ts, names.event_type])
    return df.withColumns(
        {names.amount: fill_clip_int(names.amount, *LIMITS["amount"]), names.day: event_day(names.ts)}
    )


def clean_measure_rows(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    """The part of measure cleaning that needs one row at a time (also valid on a stream)."""
    df = df.withColumn(names.ts, parse_ts_lenient(names.ts))
    df = require_not_null(df, [names.entity, names.ts])
    return df.withColumns(
        {names.volume: fill_clip_int(names.volume, *LIMITS["volume"]), names.day: event_day(names.ts)}
    )


def clean_measure(df: DataFrame, names: Names = GENERIC, **limits: int) -> DataFrame:
    return fill_median_clip(clean_measure_rows(df, names), names.speed, *SPEED_RANGE, **limits)


def clean_context(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    return df.withColumn(names.ts, parse_ts_lenient(names.ts))


def clean_registry(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    return dedupe_keys(df, [names.entity], names.registry_order)


CLEANERS = {
    "registry": clean_registry,
    "measure": clean_measure,
    "typed": clean_typed,
    "incident": clean_incident,
    "context": clean_context,
}


def clean_sources(sources: Mapping[str, DataFrame], names: Names = GENERIC) -> dict[str, DataFrame]:
    """Clean the five sources: registry, measure, typed, incident and context."""
    return {name: clean(sources[name], names) for name, clean in CLEANERS.items()}
