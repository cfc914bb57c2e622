"""Star schema tables and the measures over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.scalars import in_set
from daygrain.names import GENERIC, LINEAGE, SEVERE, Names
from daygrain.operators.clean import dedupe_keys, select_existing
from daygrain.operators.lineage import normalize_lineage
from daygrain.operators.ranking import distinct_days


def dim_entity(registry: DataFrame, names: Names = GENERIC) -> DataFrame:
    return dedupe_keys(registry, [names.entity], names.registry_order).select(names.entity, *names.attrs)


def dim_date(facts: Sequence[DataFrame], names: Names = GENERIC) -> DataFrame:
    """Calendar attributes of every day that occurs in a fact."""
    return calendar_attributes(distinct_days(facts, names.ts))


def calendar_attributes(days: DataFrame, day: str = "date") -> DataFrame:
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("dow"),
        F.weekofyear(day).alias("week"),
    )


def _fact(df: DataFrame, cols: Sequence[str], names: Names) -> DataFrame:
    return normalize_lineage(df).select(*cols, *LINEAGE, F.to_date(names.ts).alias("date"))


def fact_incident(incident: DataFrame, names: Names = GENERIC) -> DataFrame:
    # The columns of the fact, in order.
    cols = [
        names.incident,
        names.ts,
        names.entity,
        names.severity,
        names.vehicles,
        names.injuries,
        names.fatalities,
        *names.context_attrs,
    ]
    return _fact(incident, cols, names)


def fact_typed_event(typed: DataFrame, names: Names = GENERIC, extra: Sequence[str] = ()) -> DataFrame:
    """``extra`` columns come along, and those that ``names`` lists for the source, where present."""
    listed = [c for c in names.typed_extra if c in typed.columns and c not in extra]
    # The columns of the fact, in order.
    cols = [names.typed_id, names.ts, names.entity, names.event_type, names.amount, *listed, *extra]
    return _fact(typed, cols, names)


def fact_measure(measure: DataFrame, names: Names = GENERIC) -> DataFrame:
    return _fact(measure, [names.sensor, names.ts, names.entity, names.volume, names.speed], names)


def fact_entity_day(entity_day: DataFrame, names: Names = GENERIC) -> DataFrame:
    return select_existing(
        entity_day,
        [
            *names.grain,
            *names.attrs,
            "weather_mode",
            "daily_volume",
            "mean_speed",
            "p95_speed",
            "sensor_events",
            "total_violations",
            "violations_per_1000_volume",
            "accidents",
            "injuries",
            "fatalities",
            "severe",
            "severe_rate",
            "has_fatality",
            "low_visibility_hours",
            "rain_hours",
            "fog_hours",
            "max_precip_mm",
            "avg_temp_c",
        ],
    )


def star_tables(tables: Mapping[str, DataFrame], names: Names = GENERIC, extra: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The six star tables; ``fact_entity_day`` only when the entity-day table is given."""
    star = {
        "dim_entity": dim_entity(tables["registry"], names),
        "dim_date": dim_date([tables[t] for t in ("incident", "typed", "measure")], names),
        "fact_incident": fact_incident(tables["incident"], names),
        "fact_typed_event": fact_typed_event(tables["typed"], names, extra),
        "fact_measure": fact_measure(tables["measure"], names),
    }
    if "entity_day" in tables:
        star["fact_entity_day"] = fact_entity_day(tables["entity_day"], names)
    return star


def measure(fact: DataFrame, dims: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Named aggregates of a fact by any list of dimension columns."""
    aggs = [column.alias(name) for name, column in measures.items()]
    return fact.groupBy(*dims).agg(*aggs) if dims else fact.agg(*aggs)


def by_dims(parts: Sequence[DataFrame], dims: Sequence[str]) -> DataFrame:
    """Measures of several facts side by side, matched on the dimensions (null matches null)."""
    if not dims:
        one = parts[0]
        for part in parts[1:]:
            packed = part.agg(F.max(F.struct(*part.columns)).alias("_s")).scalar()
            one = one.withColumn("_s", packed).select(
                *one.columns, *[F.col(f"_s.{c}").alias(c) for c in part.columns]
            )
        return one
    wide = parts[0]
    names = [c for part in parts for c in part.columns if c not in dims]
    for part in parts[1:]:
        wide = wide.unionByName(part, allowMissingColumns=True)
    return wide.groupBy(*dims).agg(*[F.max(c).alias(c) for c in names])


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def measures_core(star: Mapping[str, DataFrame], dims: Sequence[str] = (), names: Names = GENERIC) -> DataFrame:
    severe = F.count_if(in_set(names.severity, SEVERE))
    return measure(
        star["fact_incident"],
        dims,
        {
            "accidents": F.count("*"),
            "fatalities": F.sum(names.fatalities).cast("long"),
            "injuries": F.sum(names.injuries).cast("long"),
            "severe_accidents": severe,
            "severe_rate": _share(severe, F.count("*")),
        },
    )


def measures_exposure(star: Mapping[str, DataFrame], dims: Sequence[str] = (), names: Names = GENERIC) -> DataFrame:
    parts = [
        measure(
            star["fact_typed_event"],
            dims,
            {"violations": F.count("*"), "total_fines": F.sum(names.amount).cast("long")},
        ),
        measure(star["fact_measure"], dims, {"avg_sensor_speed": F.avg(names.speed)}),
        measure(
            star["fact_entity_day"],
            dims,
            {
                "fatality_flag_rate": F.avg("has_fatality"),
                "entity_day_severe_rate": F.avg("severe_rate"),
            },
        ),
    ]
    return by_dims(parts, dims)


def measures_extended(
    star: Mapping[str, DataFrame],
    dims: Sequence[str] = (),
    names: Names = GENERIC,
    counted_types: Sequence[str] = ("Speeding", "PhoneUse"),
) -> DataFrame:
    typed = {
        f"{t}_events": F.count_if(F.coalesce(F.col(names.event_type) == t, F.lit(False)))
        for t in counted_types
    }
    fatal = F.coalesce(_share(F.sum(names.fatalities), F.count("*")), F.lit(0.0))
    parts = [
        measure(star["fact_incident"], dims, {"fatal_rate": fatal}),
        measure(star["fact_typed_event"], dims, typed),
        measure(star["fact_measure"], dims, {"total_volume": F.sum(names.volume).cast("long")}),
        measure(
            star["fact_entity_day"],
            dims,
            {
                "avg_violations_per_1000": F.avg("violations_per_1000_volume"),
                "high_risk_entity_days": F.count_if(F.col("severe") >= 1),
            },
        ),
    ]
    return by_dims(parts, dims)
