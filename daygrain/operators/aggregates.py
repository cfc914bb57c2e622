"""Daily aggregates, the entity-day table, KPIs, trends, hotspots and correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.order_stats import exact_percentiles
from daygrain.functions.scalars import flag_any, in_set, safe_ratio, week_label
from daygrain.names import GENERIC, LOW_VISIBILITY, SEVERE, Names
from daygrain.operators.clean import default_fill, min_support
from daygrain.operators.joins import context_lookup, integrate_entity_day, lookup_missing
from daygrain.operators.ranking import top_k

# Candidate signals of the diagnostic list (8, top 6) and the report list (8, top 5).
DIAGNOSTIC_SIGNALS = (
    "daily_volume",
    "p95_speed",
    "total_violations",
    "violations_per_1000_volume",
    "low_visibility_hours",
    "rain_hours",
    "fog_hours",
    "severe_rate",
)
REPORT_SIGNALS = (
    "mean_speed",
    "p95_speed",
    "daily_volume",
    "total_violations",
    "violations_per_1000_volume",
    "low_visibility_hours",
    "rain_hours",
    "fog_hours",
)

#: Definitions of the entity-day columns, over the columns that fill these roles.
DERIVED = {
    "daily_volume": "sum({volume})",
    "mean_speed": "avg({speed})",
    "p95_speed": "percentile({speed}, 0.95)",
    "sensor_events": "count({sensor})",
    "total_violations": "count({typed_id})",
    "accidents": "count({incident})",
    "severe": f"count({{severity}} in {', '.join(SEVERE)})",
    "weather_mode": "most frequent {mode}",
    "low_visibility_hours": f"count({{visibility}} < {LOW_VISIBILITY})",
    "rain_hours": "count({mode} = Rain)",
    "fog_hours": "count({mode} = Fog)",
    "max_precip_mm": "max({precip})",
    "avg_temp_c": "avg({temp})",
    "has_fatality": "sum({fatalities}) > 0",
    "severe_rate": "severe / accidents",
    "violations_per_1000_volume": "1000 * total_violations / daily_volume",
}


def severe_count(severity: str, severe: Sequence[str] = SEVERE) -> Column:
    return F.count_if(in_set(severity, severe))


def total(col: str) -> Column:
    """Sum that is 0 on no rows."""
    return F.coalesce(F.sum(col), F.lit(0)).cast("long")


def daily_exposure(
    measure: DataFrame,
    keys: Sequence[str] = ("entity_id", "date"),
    volume: str = "volume",
    speed: str = "speed",
    sensor: str = "sensor_id",
    **limits: int,
) -> DataFrame:
    """Per entity and day: volume, mean and exact 95th percentile speed, number of readings."""
    return exact_percentiles(
        measure,
        list(keys),
        speed,
        {"p95_speed": 0.95},
        [
            F.sum(volume).alias("daily_volume"),
            F.avg(speed).alias("mean_speed"),
            F.count(sensor).alias("sensor_events"),
        ],
        **limits,
    )


def event_types(typed: DataFrame, type_col: str) -> list[str]:
    """Sorted distinct types. Each becomes a column, so their number is bounded by what a table can have."""
    return [row[0] for row in typed.select(type_col).dropna().distinct().orderBy(type_col).collect()]


def typed_counts(typed: DataFrame, keys: Sequence[str], type_col: str, id_col: str, col: str = "counts") -> DataFrame:
    """Count of events per type as one map per group, for any number of types: only types that occur are in it.

    Counts are combined by (group, type) before the shuffle. Events without type are in no map; a group of such
    events has an empty one. ``wide_counts`` makes columns of the types one asks for.
    """
    per_type = typed.groupBy(*keys, type_col).agg(F.count(id_col).alias("_n"))
    entry = F.when(F.col(type_col).isNotNull(), F.struct(F.col(type_col), F.col("_n")))  # collect_list leaves nulls out
    return per_type.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias(col))


def wide_counts(counts: DataFrame, types: Sequence[str], col: str = "counts", total: str | None = None) -> DataFrame:
    """One column per listed type, 0 where it does not occur, in place of the map; ``total`` names the sum over all types of the map."""
    out = counts.withColumns({t: F.coalesce(F.try_element_at(col, F.lit(t)), F.lit(0)) for t in types})
    if total:
        out = out.withColumn(total, F.aggregate(F.map_values(col), F.lit(0).cast("long"), lambda n, x: n + x))
    return out.drop(col)


def typed_pivot(
    typed: DataFrame,
    keys: Sequence[str],
    type_col: str,
    id_col: str,
    values: Sequence[str] | None = None,
    all_types: str | None = None,
) -> DataFrame:
    """Count of events per type, one column per type, 0 where there is none.

    Conditional counts in one aggregate: one shuffle of partial counts. ``values``
    avoids the job that looks the types up. ``all_types`` names a column with the count
    over every type that occurs, listed in ``values`` or not.
    """
    types = sorted(values if values is not None else event_types(typed, type_col))
    counts = [F.count(F.when(F.col(type_col) == t, F.col(id_col))).alias(t) for t in types]
    if all_types:
        counts.append(F.count(F.when(F.col(type_col).isNotNull(), F.col(id_col))).alias(all_types))
    return typed.groupBy(*keys).agg(*counts) if counts else typed.select(*keys).distinct()


def row_total(df: DataFrame, cols: Sequence[str], name: str = "total_violations") -> DataFrame:
    """Sum across columns of a row, 0 when there are none."""
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in cols]
    return df.withColumn(name, reduce(add, parts, F.lit(0)).cast("long"))


def daily_incident(
    incident: DataFrame, keys: Sequence[str] = ("entity_id", "date"), names: Names = GENERIC
) -> DataFrame:
    return incident.groupBy(*keys).agg(
        F.count(names.incident).alias("accidents"),
        F.sum(names.injuries).alias("injuries"),
        F.sum(names.fatalities).alias("fatalities"),
        severe_count(names.severity).alias("severe"),
    )


def daily_context(context: DataFrame, keys: Sequence[str], names: Names = GENERIC) -> DataFrame:
    """Per region, city and day: commonest mode, hours by condition, precipitation, temperature.

    Two steps: per mode value first, so the mode is picked from one row per value.
    Ties go to the lowest value.
    """
    mode = F.col(names.mode)
    per_mode = context.groupBy(*keys, names.mode).agg(
        F.count("*").alias("_n"),
        F.count_if(F.col(names.visibility) < LOW_VISIBILITY).alias("_low"),
        F.max(names.precip).alias("_precip"),
        F.sum(F.col(names.temp).cast("double")).alias("_temp"),
        F.count(names.temp).alias("_temps"),
    )
    commonest = F.min(F.when(mode.isNotNull(), F.struct((-F.col("_n")).alias("rank"), mode.alias("mode"))))
    return (
        per_mode.groupBy(*keys)
        .agg(
            commonest.alias("_mode"),
            F.sum("_low").alias("low_visibility_hours"),
            F.sum(F.when(mode == "Rain", F.col("_n")).otherwise(0)).alias("rain_hours"),
            F.sum(F.when(mode == "Fog", F.col("_n")).otherwise(0)).alias("fog_hours"),
            F.max("_precip").alias("max_precip_mm"),
            F.try_divide(F.sum("_temp"), F.sum("_temps")).alias("avg_temp_c"),
        )
        .withColumn("weather_mode", F.col("_mode.mode"))
        .select(
            *keys,
            "weather_mode",
            "low_visibility_hours",
            "rain_hours",
            "fog_hours",
            "max_precip_mm",
            "avg_temp_c",
        )
    )


def add_ratios(df: DataFrame) -> DataFrame:
    """The derived columns of the entity-day table."""
    events = F.col("total_violations") if "total_violations" in df.columns else F.lit(0)
    return df.withColumns(
        {
            "has_fatality": flag_any("fatalities"),
            "severe_rate": safe_ratio("severe", "accidents"),
            "violations_per_1000_volume": safe_ratio(events, "daily_volume", 1000.0),
        }
    )


def build_entity_day(tables: Mapping[str, DataFrame], names: Names = GENERIC, **limits: int) -> DataFrame:
    """The reusable feature table, one row per entity and day that has a measure.

    ``tables``: cleaned registry, measure, typed, incident and context. Each is reduced
    to its daily grain before the joins, and the incident days of entities without a
    measure row drop out with the left joins.
    """
    context = tables["context"].withColumn(names.day, F.to_date(names.ts))
    typed = tables["typed"]
    types = sorted(names.types if names.types is not None else event_types(typed, names.event_type))
    # the total covers types outside the list as well
    counts = typed_pivot(typed, names.grain, names.event_type, names.typed_id, types, "total_violations")
    joined = integrate_entity_day(
        daily_exposure(tables["measure"], names.grain, names.volume, names.speed, names.sensor, **limits),
        counts,
        daily_incident(tables["incident"], names.grain, names),
        tables["registry"],
        daily_context(context, [names.region, names.city, names.day], names),
        names,
    )
    text = [names.region, names.city, names.kind, "weather_mode"]
    # The columns of the entity-day table, in order.
    ordered = [
        *names.grain,
        "daily_volume",
        "mean_speed",
        "p95_speed",
        "sensor_events",
        *types,
        "total_violations",
        "accidents",
        "injuries",
        "fatalities",
        "severe",
        *names.attrs,
        "weather_mode",
        "low_visibility_hours",
        "rain_hours",
        "fog_hours",
        "max_precip_mm",
        "avg_temp_c",
    ]
    return add_ratios(default_fill(joined.select(*ordered), text, names.grain))


def enrich_incident(tables: Mapping[str, DataFrame], names: Names = GENERIC, **limits: int) -> DataFrame:
    """Incidents with registry attributes and the context of their hour."""
    incident = lookup_missing(
        tables["incident"], tables["registry"], [names.entity], names.attrs, names.registry_order, **limits
    )
    return context_lookup(incident, tables["context"], names, **limits)


def kpi_summary(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    """Headline figures over all incidents, zeros on an empty table."""
    sums = df.agg(
        F.count("*").alias("accidents"),
        total(names.fatalities).alias("fatalities"),
        total(names.injuries).alias("injuries"),
        severe_count(names.severity).alias("severe"),
    )
    return sums.withColumns(
        {
            "severe_rate": safe_ratio("severe", "accidents"),
            "fatality_rate": safe_ratio("fatalities", "accidents"),
        }
    )


def category_mix(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first."""
    kept = df if keep_null else df.where(F.col(col).isNotNull())
    return kept.groupBy(col).agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.asc_nulls_last(col))


def _incident_sums(names: Names) -> list[Column]:
    return [
        F.count(names.incident).alias("accidents"),
        severe_count(names.severity).alias("severe"),
        F.sum(names.fatalities).cast("long").alias("fatalities"),
    ]


def severity_profile(
    df: DataFrame, dims: Sequence[str], names: Names = GENERIC, by_fatalities: Sequence[str] | None = None
) -> DataFrame:
    """(dimension, value) rows with incident counts and severe rate for several dimensions at once.

    One pass counts per combination of the dimensions; the profiles are folded from those. Values of the
    dimensions in ``by_fatalities`` (the region unless given) go by fatalities, those of others by severe incidents.
    """
    fatal_first = (names.region,) if by_fatalities is None else by_fatalities
    combos = df.groupBy(*dims).agg(*_incident_sums(names))
    fields = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims]
    )
    long = combos.select("accidents", "severe", "fatalities", F.inline(fields)).where("value is not null")
    profile = long.groupBy("dimension", "value").agg(
        *[F.sum(c).alias(c) for c in ("accidents", "severe", "fatalities")]
    )
    return profile.withColumn("severe_rate", safe_ratio("severe", "accidents")).orderBy(
        "dimension",
        F.when(in_set("dimension", fatal_first), F.col("fatalities")).otherwise(F.col("severe")).desc(),
        F.desc("accidents"),
        "value",
    )


def weekly_trend(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    """Incidents, severe incidents and fatalities per Monday-to-Sunday week."""
    weeks = df.where(F.col(names.ts).isNotNull()).withColumn("week", week_label(names.ts))
    return weeks.groupBy("week").agg(*_incident_sums(names)).orderBy("week")


def trend_tail(trend: DataFrame, n: int = 8, by: str = "week") -> DataFrame:
    """The last ``n`` periods, oldest first."""
    return trend.orderBy(F.desc(by)).limit(n).orderBy(by)


def hotspot_groups(df: DataFrame, names: Names = GENERIC) -> DataFrame:
    dims = [names.entity, names.region, names.city, names.kind]
    grouped = df.dropna(subset=dims).groupBy(*dims).agg(*_incident_sums(names))
    return grouped.withColumn("severe_rate", safe_ratio("severe", "accidents"))


def hotspots_by_rate(df: DataFrame, min_n: int = 20, k: int = 10, names: Names = GENERIC) -> DataFrame:
    """Entities with enough incidents, by severe rate."""
    supported = min_support(hotspot_groups(df, names), "accidents", min_n)
    return top_k(supported, ["severe_rate", "fatalities"], k, [names.entity, names.region, names.city, names.kind])


def hotspots_by_count(df: DataFrame, k: int = 10, names: Names = GENERIC) -> DataFrame:
    """Entities by fatalities, then incidents."""
    return top_k(
        hotspot_groups(df, names),
        ["fatalities", "accidents"],
        k,
        [names.entity, names.region, names.city, names.kind],
    )


def leading_group(
    df: DataFrame, dim: str, by: Sequence[str] = ("fatalities", "accidents"), names: Names = GENERIC
) -> DataFrame:
    """One row: the group ranked first by the given counts, ``n/a`` when there is none."""
    groups = df.where(F.col(dim).isNotNull()).groupBy(dim).agg(*_incident_sums(names))
    rank = F.struct(*[(-F.col(c)).alias(f"r{i}") for i, c in enumerate(by)], F.col(dim).alias("name"))
    return groups.agg(F.min(rank).alias("_best")).select(
        F.coalesce(F.col("_best.name").cast("string"), F.lit("n/a")).alias("leading")
    )


def region_day_profile(entity_day: DataFrame, names: Names = GENERIC) -> DataFrame:
    return (
        entity_day.where(F.col(names.region).isNotNull())
        .groupBy(names.region)
        .agg(
            F.count(names.entity).alias("road_days"),
            F.avg("severe_rate").alias("avg_severe_rate"),
            F.avg("violations_per_1000_volume").alias("avg_violations_per_1000_volume"),
            F.avg("daily_volume").alias("avg_daily_volume"),
        )
        .orderBy(F.desc("avg_severe_rate"), names.region)
    )


def entity_day_means(entity_day: DataFrame) -> DataFrame:
    """Positive rate and mean intensity; 0.0 for a column that is absent."""

    def mean(col: str) -> Column:
        return F.avg(col) if col in entity_day.columns else F.lit(0.0)

    return entity_day.agg(
        mean("has_fatality").alias("model_positive_rate"),
        mean("violations_per_1000_volume").alias("avg_violation_intensity"),
    )


def source_coverage(tables: Mapping[str, DataFrame], names: Names = GENERIC, exact: bool = True) -> DataFrame:
    """Distinct registry entities and incidents, and entity-day rows."""

    def distinct(col: str) -> Column:
        return F.count_distinct(col) if exact else F.approx_count_distinct(col)

    parts = [
        ("registry", tables["registry"], distinct(names.entity)),
        ("incident", tables["incident"], distinct(names.incident)),
        ("entity_day", tables["entity_day"], F.count("*")),
    ]
    rows = [df.agg(F.lit(name).alias("domain"), n.alias("row_count")) for name, df, n in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def band_distribution(scored: DataFrame, band: str = "risk_band") -> DataFrame:
    return scored.groupBy(band).agg(F.count("*").alias("road_days")).orderBy(F.desc("road_days"), band)


def correlation(x: str, y: str) -> Column:
    """Pearson r over rows where both are present; null when a side does not vary."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def signal_correlation(
    df: DataFrame, cols: Sequence[str] = DIAGNOSTIC_SIGNALS, flag: str = "has_fatality", k: int = 6
) -> DataFrame:
    """Candidate columns ranked by the size of their correlation with the flag, in one pass."""
    present = [c for c in cols if c in df.columns]
    one_row = df.agg(*[correlation(c, flag).alias(c) for c in present])
    long = one_row.unpivot([], present, "signal", "corr").where("corr is not null")
    return long.orderBy(F.desc(F.abs("corr")), "signal").limit(k)


def quantile_bounds(
    df: DataFrame,
    cols: Sequence[str],
    lo: float = 0.05,
    hi: float = 0.95,
    exact: bool = True,
    accuracy: int = 10_000,
    **limits: int,
) -> DataFrame:
    """(feature, lower, upper) rows: two quantiles per column, null and unreadable counted as 0."""
    present = [c for c in cols if c in df.columns]
    fields = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias("value"))
            for c in present
        ]
    )
    long = df.select(F.inline(fields))
    if exact:
        return exact_percentiles(long, ["feature"], "value", {"lower": lo, "upper": hi}, **limits)
    both = F.percentile_approx("value", [lo, hi], accuracy)
    return long.groupBy("feature").agg(both[0].alias("lower"), both[1].alias("upper"))


def fold_metrics(df: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Wide to long: one (metric, value) row per column."""
    return df.unpivot(list(ids), list(cols), "metric", "value")
