"""Joins: lookups, the entity-day chain, the calendar spine, key checks and the star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.scalars import floor_hour
from daygrain.functions.skew import HOT_ROWS, MAX_HOT, KeySketch, crowd_lookup, salted_lookup
from daygrain.names import GENERIC, Names
from daygrain.operators.clean import dedupe_keys


def lookup_missing(
    base: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order_cols: Sequence[str] = (),
    **limits: int,
) -> DataFrame:
    """Left join that brings only those ``cols`` the base lacks; first lookup row per key."""
    missing = [c for c in cols if c not in base.columns and c in lookup.columns]
    if not missing:
        return base
    order = [c for c in order_cols if c in lookup.columns]
    needed = list(dict.fromkeys([*keys, *missing, *order]))
    single = dedupe_keys(lookup.select(*needed), keys, order).select(*keys, *missing)
    return salted_lookup(base, single, keys, **limits)


def context_lookup(
    incident: DataFrame, context: DataFrame, names: Names = GENERIC, **limits: int
) -> DataFrame:
    """Attach the hourly context of the incident's region and city."""
    if names.region not in incident.columns or names.city not in incident.columns:
        return incident
    keys = ["hour", names.region, names.city]
    hourly = context.withColumn("hour", floor_hour(names.ts))
    stamped = incident.withColumn("hour", floor_hour(names.ts))
    return lookup_missing(
        stamped, hourly, keys, names.context_attrs, names.context_order, **limits
    ).drop("hour")


def integrate_entity_day(
    exposure: DataFrame,
    typed: DataFrame,
    incident: DataFrame,
    registry: DataFrame,
    context: DataFrame,
    names: Names = GENERIC,
    most: int = HOT_ROWS,
) -> DataFrame:
    """exposure ⟕ typed counts ⟕ incident day ⟕ registry ⟕ daily context.

    The first three are aggregated on the same (entity, day) grain and share its
    partitioning. An entity has one row per day here, so the registry join cannot be
    skewed; a city can hold many entities, so one with more than ``most`` in the registry
    is cut into pieces for the context join.
    """
    joined = exposure.join(typed, names.grain, "left").join(incident, names.grain, "left")
    joined = joined.join(registry.select(names.entity, *names.attrs), names.entity, "left")
    crowd = [names.region, names.city]
    return crowd_lookup(joined, context, [*crowd, names.day], names.entity, registry, crowd, most)


def dense_spine(
    entities: DataFrame,
    first_day,
    last_day,
    context: DataFrame,
    defaults: Mapping[str, object],
    names: Names = GENERIC,
    most: int = HOT_ROWS,
) -> DataFrame:
    """Every entity on every day of the range, with daily context and defaults in the gaps.

    Days are generated row by row from the two bounds (dates or scalar columns). A city with more
    than ``most`` entities is cut into pieces for the context join.
    """
    days = F.explode(F.sequence(first_day, last_day, F.expr("interval 1 day")))
    spine = entities.withColumn(names.day, days)
    crowd = [names.region, names.city]
    spine = crowd_lookup(spine, context, [*crowd, names.day], names.entity, entities, crowd, most)
    return spine.fillna(dict(defaults))


def fk_violation_rate(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """One row ``fk_violation_rate``: share of fact rows whose key is null or not in the dimension.

    Facts are counted per key before the join, so a frequent key is one row.
    """
    known = dim.select(F.col(dim_key or key).alias(key)).distinct().withColumn("_known", F.lit(1))
    per_key = fact.groupBy(key).agg(F.count("*").alias("_n"))
    joined = per_key.join(known, key, "left")
    bad = F.sum(F.when(F.col("_known").isNull(), F.col("_n")).otherwise(0))
    return joined.agg(
        F.try_divide(bad.cast("double"), F.sum("_n").cast("double")).alias("fk_violation_rate")
    )


def fk_violations(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, **limits: int
) -> DataFrame:
    """The fact rows behind ``fk_violation_rate``."""
    known = dim.select(F.col(dim_key or key).alias(key)).distinct().withColumn("_known", F.lit(1))
    return salted_lookup(fact, known, [key], **limits).where(F.col("_known").isNull()).drop("_known")


def scalar_broadcast(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table to every row as a scalar subquery."""
    packed = one_row.agg(
        F.max(F.struct(*[F.col(c) for c in one_row.columns])).alias("_scalar")
    ).scalar()
    return df.withColumn("_scalar", packed).select(
        *df.columns, *[F.col(f"_scalar.{c}").alias(c) for c in one_row.columns]
    )


def star_join(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, Sequence[str]]],
    hot_rows: int = HOT_ROWS,
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """Many-to-one left joins of a fact to its dimensions (one row per key each).

    One sketch of the fact's keys serves all dimensions. Keys that an earlier dimension brings are counted when their turn comes.
    """
    sketch = KeySketch(fact, [keys for _, keys in dims], hot_rows, max_hot)
    for dim, keys in dims:
        fresh = [c for c in dim.columns if c not in fact.columns or c in keys]
        fact = salted_lookup(fact, dim.select(*fresh), keys, hot_rows, max_hot, sketch)
    return fact
