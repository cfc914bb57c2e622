"""Every operator as a query over the sample tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions import scalars as fn
from daygrain.functions.storage import reliable, remove, shared_dir
from daygrain.names import GENERIC
from daygrain.operators import aggregates as agg
from daygrain.operators import clean, joins, lineage, model, profile, quality, ranking, scenario, star
from daygrain.plans.risk import run_risk_model, run_scenarios
from daygrain.sources import layers, readers
from daygrain.sources.readers import read_source as read_table
from daygrain.sources.schemas import Source
from daygrain.sources.sample_tables import BATCH, EVENTS_SCHEMA, EXTRACTED, SampleTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-02-05 00:00:00"
KINDS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
TYPES = list(GENERIC.types)
SCORE_BANDS = ((-0.01, 0.20, 0.50, 0.75, 1.0), ("Low", "Medium", "High", "Critical"))


def query(build: Callable[[SampleTables], DataFrame]) -> Callable[[SampleTables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(SampleTables(spark, sf_dir)))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, so that summation order does not show."""
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


def with_score(entity_day: DataFrame) -> DataFrame:
    """A risk score that any engine computes alike, for checking the model metrics."""
    mixed = F.col("entity_id") * 7 + F.dayofmonth("date") * 13 + F.col("daily_volume")
    return entity_day.withColumn("score", (mixed % 101).cast("double") / 100.0)


def fixed_scorer(df: DataFrame) -> DataFrame:
    """A logistic model with set coefficients, as a scorer for the scenarios."""
    z = (
        F.lit(-2.0)
        + F.col("p95_speed") * 0.008
        + F.col("mean_speed") * 0.004
        + F.col("total_violations") * 0.05
        + F.col("violations_per_1000_volume") * 0.0005
        + F.col("low_visibility_hours") * 0.1
    )
    return df.withColumn("model_risk", 1.0 / (1.0 + F.exp(-z)))


# sources, layers -----------------------------------------------------------------------------


@query
def read_source(t):
    return read_table(t.spark, f"{t.sf_dir}/events.parquet", EVENTS_SCHEMA, "parquet")


@query
def read_source_csv_numbers(t):
    """Whole numbers that a CSV has as ``3.0``, as of a column with gaps, keep their value."""
    counts = ("vehicles", "injuries", "fatalities")
    folder = shared_dir(t.spark, "csv")
    written = t.raw["incident"].select("incident_id", *[F.col(c).cast("double").cast("string").alias(c) for c in counts])
    written.write.option("header", True).csv(folder)
    return read_table(t.spark, folder, "incident_id bigint, vehicles int, injuries int, fatalities int")


def raw_csv(t: SampleTables) -> tuple[str, dict[str, Source]]:
    """The raw tables as headered CSV in one folder, and the sources that declare them."""
    folder, sources = shared_dir(t.spark, "raw"), {}
    for name, df in t.raw.items():
        df.write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{folder}/{name}")
        sources[name] = Source(name, f"{name}_feed", ", ".join(f"{c} {kind}" for c, kind in df.dtypes))
    return folder, sources


@query
def load_sources(t):
    folder, sources = raw_csv(t)
    loaded = readers.load_sources(t.spark, folder, BATCH, EXTRACTED, sources, suffix="")
    counts = [
        df.groupBy("source_system", "ingest_batch_id", "extracted_at_utc").agg(F.count("record_hash").alias("rows"))
        for df in loaded.values()
    ]
    return ranking.union_all(counts)


@query
def load_sources_content(t):
    """What the CSV files give back, value by value."""
    folder, sources = raw_csv(t)
    loaded = readers.load_sources(t.spark, folder, BATCH, EXTRACTED, sources, suffix="")
    return ranking.union_all([lineage.content_digest(df.select(*t.raw[name].columns), name) for name, df in loaded.items()])


@query
def write_layer(t):
    path = shared_dir(t.spark, "layer")
    layers.write_layer({"typed": t.clean["typed"]}, path, partition_by={"typed": ["date"]})
    back = layers.read_layer(t.spark, path, ["typed"])["typed"]
    return back.groupBy("date", "event_type").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))


@query
def run_layers(t):
    folder, sources = raw_csv(t)
    tables = layers.run_layers(t.spark, folder, shared_dir(t.spark, "layers"), BATCH, EXTRACTED, GENERIC, sources=sources, suffix="")
    return tables["entity_day"]


@query
def write_results(t):
    path = shared_dir(t.spark, "results")
    scores = reliable(scenario.scenario_scores(t.stored_day, fixed_scorer))
    results = {
        "scenario_summary": scenario.scenario_summary(scores),
        "scenario_region_impact": scenario.scenario_region_impact(scores),
        "hotspots": agg.hotspots_by_count(t.incident),
    }
    layers.write_results(results, path, "csv")
    back = {name: t.spark.read.schema(df.schema).csv(f"{path}/{name}", header=True) for name, df in results.items()}
    return ranking.union_all([lineage.content_digest(df, name) for name, df in back.items()])


@query
def save_model(t):
    train, test, _ = model.split_train_test(t.stored_day)
    path = shared_dir(t.spark, "model")
    fitted = model.train_risk_model(train)
    layers.save_model(fitted, path)
    again = model.score_risk(layers.load_model(path), test).withColumnRenamed(model.RISK, "again")
    scored = model.score_risk(fitted, again)
    return scored.select(*GENERIC.grain, F.abs(F.col(model.RISK) - F.col("again")).alias("off"))


@query
def load_or_fit(t):
    """Whether a model was fitted: without a stored one, with one, with one of other columns, with a damaged one."""
    train, _, _ = model.split_train_test(t.stored_day)
    path = shared_dir(t.spark, "fitted")
    fewer = train.drop("city", "weather_mode")
    cases = [("absent", train), ("stored", train), ("other columns", fewer), ("stored again", fewer), ("damaged", fewer)]
    told = []
    for name, rows in cases:
        if name == "damaged":
            remove(t.spark, f"{path}/model/stages")
        told.append((name, layers.load_or_fit(rows, path, names=GENERIC, max_iter=3)[1]))
    counted = train.agg(F.count("*").alias("rows"))
    return t.spark.createDataFrame(told, "case string, fitted boolean").withColumn("rows", counted.scalar())


# lineage -------------------------------------------------------------------------------------


@query
def add_lineage(t):
    return lineage.add_lineage(t.registry_raw, "registry_feed", BATCH, EXTRACTED)


@query
def record_hash(t):
    return lineage.record_hash(lineage.add_lineage(t.registry_raw, "registry_feed", BATCH, EXTRACTED))


@query
def record_hash_business(t):
    keyed = lineage.add_lineage(t.typed_raw, "typed_feed", BATCH, EXTRACTED)
    return lineage.record_hash(keyed, include_lineage=False).select("typed_id", "record_hash")


@query
def normalize_lineage(t):
    joined = t.clean["incident"].withColumnsRenamed(
        {"source_system": "source_system_x", "record_hash": "record_hash_source"}
    )
    return lineage.normalize_lineage(joined).select("incident_id", *lineage.LINEAGE)


@query
def lineage_summary(t):
    return lineage.lineage_summary(t.governed)


@query
def manifest_counts(t):
    results = quality.run_quality(t.governed, quality.standard_contracts(GENERIC, KINDS), AS_OF)
    return lineage.manifest_counts(t.governed, quality.quality_gate(results))


# cleaning ------------------------------------------------------------------------------------


@query
def parse_ts_lenient(t):
    text = F.when(F.col("k") % 13 == 0, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    parsed = fn.parse_ts_lenient(text).cast("timestamp_ntz")
    return t.events.select("event_id", parsed.alias("parsed"))


@query
def dedupe_keys(t):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    kept = clean.dedupe_keys(t.read("lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query
def require_not_null(t):
    return clean.require_not_null(t.measure_raw, ["entity_id", "speed"]).select("sensor_id", "speed")


@query
def fill_clip_int(t):
    injuries = fn.fill_clip_int("injuries", 0, 0, 2)
    volume_like = fn.fill_clip_int("fatalities", 1, 1, 30)
    return t.incident_raw.select("incident_id", injuries.alias("injuries"), volume_like.alias("deaths_floor_1"))


@query
def fill_clip_int_fraction(t):
    return t.typed_raw.select("typed_id", fn.fill_clip_int("amount", 0, 0, 100).alias("amount"))


@query
def fill_median_clip(t):
    return clean.fill_median_clip(t.measure_raw, "speed", 0.0, 220.0).select("sensor_id", "speed")


@query
def event_day(t):
    return t.events.select("event_id", fn.event_day("ts").alias("date"))


@query
def floor_hour(t):
    return t.events.select("event_id", fn.floor_hour("ts").cast("timestamp_ntz").alias("hour"))


@query
def default_fill(t):
    joined = agg.daily_incident(t.clean["incident"])
    sparse = t.clean["registry"].select("entity_id", "kind").join(joined, "entity_id", "left")
    return clean.default_fill(sparse, ["kind"], ["entity_id", "date"])


@query
def flag_any(t):
    return t.incident_raw.select("incident_id", fn.flag_any("injuries").alias("has_injury"))


@query
def safe_ratio(t):
    days = agg.daily_incident(t.clean["incident"])
    return days.select(
        "entity_id", "date", fn.safe_ratio("fatalities", "injuries", 1000.0).alias("deaths_per_1000_injuries")
    )


@query
def bin_column(t):
    return t.events.select(
        "event_id", fn.bin_column(F.col("k") / 100.0 - 0.05, *SCORE_BANDS).alias("band")
    )


@query
def select_existing(t):
    return clean.select_existing(t.clean["typed"], ["typed_id", "entity_id", "no_such_column", "event_type"])


@query
def clean_measure(t):
    return t.clean["measure"].select("sensor_id", "entity_id", "ts", "date", "volume", "speed")


# filters -------------------------------------------------------------------------------------


@query
def slice_filter(t):
    kept = clean.slice_filter(t.entity_day, "ASIA", "HOUSEHOLD", "2024-01-05", "2024-01-20")
    return kept.select("entity_id", "date", "region", "kind", "daily_volume", "accidents")


@query
def slice_domain(t):
    return clean.slice_domain(t.entity_day)


@query
def min_support(t):
    return clean.min_support(agg.hotspot_groups(t.incident), "accidents", 15)


@query
def in_set(t):
    return t.incident_raw.select("incident_id", fn.in_set("severity", ("Severe", "Fatal")).alias("is_severe"))


# joins ---------------------------------------------------------------------------------------


@query
def lookup_missing(t):
    base = t.clean["incident"].withColumn("kind", F.lit("known"))
    found = joins.lookup_missing(base, t.clean["registry"], ["entity_id"], GENERIC.attrs)
    return found.select("incident_id", "entity_id", "region", "city", "kind", "capacity")


@query
def context_lookup(t):
    return t.incident.select("incident_id", "region", "city", "mode", "visibility", "precip", "temp")


@query
def integrate_entity_day(t):
    context = t.clean["context"].withColumn("date", F.to_date("ts"))
    counts = agg.typed_pivot(t.clean["typed"], GENERIC.grain, "event_type", "typed_id", TYPES)
    joined = joins.integrate_entity_day(
        agg.daily_exposure(t.clean["measure"]),
        counts,
        agg.daily_incident(t.clean["incident"]),
        t.clean["registry"],
        agg.daily_context(context, ["region", "city", "date"]),
    )
    return joined.select("entity_id", "date", "sensor_events", "click", "accidents", "city", "weather_mode", "rain_hours")


@query
def dense_spine(t):
    context = t.clean["context"].withColumn("date", F.to_date("ts"))
    daily = agg.daily_context(context, ["region", "city", "date"])
    first = context.agg(F.min("date")).scalar()
    last = context.agg(F.max("date")).scalar()
    defaults = {
        "weather_mode": "Clear",
        "low_visibility_hours": 0,
        "rain_hours": 0,
        "fog_hours": 0,
        "max_precip_mm": 0.0,
        "avg_temp_c": 28.0,
    }
    entities = t.clean["registry"].select("entity_id", "region", "city")
    return joins.dense_spine(entities, first, last, daily, defaults)


@query
def fk_violation_rate(t):
    return joins.fk_violation_rate(t.read("events"), t.read("supplier"), "user_id", "s_suppkey")


@query
def fk_violations(t):
    return joins.fk_violations(t.read("events"), t.read("supplier"), "user_id", "s_suppkey").drop("props")


@query
def scalar_broadcast(t):
    bounds = t.typed_raw.agg(F.min("amount").alias("lowest"), F.max("amount").alias("highest"))
    return joins.scalar_broadcast(t.typed_raw.select("typed_id", "amount"), bounds)


@query
def star_join(t):
    tables = star.star_tables({k: v for k, v in t.governed.items() if k != "entity_day"})
    joined = joins.star_join(
        tables["fact_typed_event"].select("typed_id", "entity_id", "date", "event_type", "amount"),
        [(tables["dim_entity"], ["entity_id"]), (tables["dim_date"], ["date"])],
    )
    return joined.select("typed_id", "region", "kind", "dow", "week", "amount")


# aggregates ----------------------------------------------------------------------------------


@query
def daily_exposure(t):
    return agg.daily_exposure(t.clean["measure"])


@query
def daily_exposure_lineitem(t):
    month = F.to_date(F.date_trunc("month", "l_shipdate"))
    lines = t.read("lineitem").withColumn("month", month)
    return agg.daily_exposure(lines, ["l_suppkey", "month"], "l_quantity", "l_extendedprice", "l_orderkey")


@query
def typed_pivot(t):
    return agg.typed_pivot(t.clean["typed"], GENERIC.grain, "event_type", "typed_id", TYPES)


@query
def typed_counts(t):
    """The map form: per entity and day the types that occur."""
    counts = agg.typed_counts(t.clean["typed"], GENERIC.grain, "event_type", "typed_id")
    shown = F.transform(F.array_sort(F.map_entries("counts")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    return counts.select("entity_id", "date", F.array_join(shown, ",").alias("counts"))


@query
def wide_counts(t):
    counts = agg.typed_counts(t.clean["typed"], GENERIC.grain, "event_type", "typed_id")
    return agg.wide_counts(counts, TYPES)


@query
def typed_pivot_lineitem(t):
    month = F.to_date(F.date_trunc("month", "l_shipdate"))
    lines = t.read("lineitem").withColumn("month", month)
    return agg.typed_pivot(lines, ["l_suppkey", "month"], "l_returnflag", "l_orderkey")


@query
def row_total(t):
    counts = agg.typed_pivot(t.clean["typed"], GENERIC.grain, "event_type", "typed_id", TYPES)
    return agg.row_total(counts, TYPES).select("entity_id", "date", "total_violations")


@query
def row_total_unlisted_type(t):
    """One type is renamed to a value outside the list; the total keeps its events."""
    kind = F.when(F.col("event_type") == "view", "unheard of").otherwise(F.col("event_type"))
    typed = t.clean["typed"].withColumn("event_type", kind)
    counts = agg.typed_pivot(typed, GENERIC.grain, "event_type", "typed_id", TYPES, "total_violations")
    return counts.select("entity_id", "date", "total_violations")


@query
def daily_incident(t):
    return agg.daily_incident(t.clean["incident"])


@query
def daily_context(t):
    context = t.clean["context"].withColumn("date", F.to_date("ts"))
    return agg.daily_context(context, ["region", "city", "date"])


@query
def build_entity_day(t):
    return t.entity_day


@query
def kpi_summary(t):
    return agg.kpi_summary(t.clean["incident"])


@query
def category_mix(t):
    return agg.category_mix(t.clean["incident"], "severity")


@query
def category_mix_keep_null(t):
    return agg.category_mix(t.incident, "mode", keep_null=True)


@query
def severity_profile(t):
    return agg.severity_profile(t.incident, ["region", "kind", "lighting", "mode"])


@query
def weekly_trend(t):
    return agg.weekly_trend(t.clean["incident"])


@query
def trend_tail(t):
    return agg.trend_tail(agg.weekly_trend(t.clean["incident"]), 3)


@query
def hotspots_by_rate(t):
    return agg.hotspots_by_rate(t.incident, 12)


@query
def hotspots_by_count(t):
    return agg.hotspots_by_count(t.incident)


@query
def leading_group(t):
    region = agg.leading_group(t.incident, "region").select(F.lit("region").alias("dim"), "leading")
    by_count = agg.leading_group(t.incident, "region", ["accidents"])
    busiest = by_count.select(F.lit("busiest region").alias("dim"), "leading")
    none = agg.leading_group(t.incident.where("severity = 'no such'"), "region")
    return region.unionByName(busiest).unionByName(none.select(F.lit("none").alias("dim"), "leading"))


@query
def region_day_profile(t):
    return agg.region_day_profile(t.entity_day)


@query
def entity_day_means(t):
    return agg.entity_day_means(t.entity_day)


@query
def source_coverage(t):
    return agg.source_coverage(t.governed)


@query
def band_distribution(t):
    scored = with_score(t.entity_day).withColumn("risk_band", fn.bin_column("score", *SCORE_BANDS))
    return agg.band_distribution(scored)


@query
def signal_correlation(t):
    return agg.signal_correlation(t.entity_day)


@query
def signal_correlation_report(t):
    return agg.signal_correlation(t.entity_day, agg.REPORT_SIGNALS, k=5)


@query
def quantile_bounds(t):
    return agg.quantile_bounds(t.stored_day, list(scenario.PRESSURE_WEIGHTS))


@query
def fold_metrics(t):
    return agg.fold_metrics(agg.weekly_trend(t.clean["incident"]), ["week"], ["accidents", "severe", "fatalities"])


# sort, top-k, sets ---------------------------------------------------------------------------


@query
def top_k(t):
    ranked = ranking.top_k(t.read("orders"), ["o_totalprice"], 25, ["o_orderkey"])
    return ranked.select("o_orderkey", "o_totalprice", "o_orderpriority")


@query
def priority_entity_days(t):
    return ranking.priority_entity_days(t.entity_day)


@query
def top_k_per_group(t):
    ranked = ranking.top_k_per_group(t.read("orders"), ["o_orderpriority"], ["o_totalprice"], 20, ["o_orderkey"])
    return ranked.select("o_orderpriority", "o_orderkey", "o_totalprice")


@query
def best_scenario(t):
    scores = reliable(scenario.scenario_scores(t.stored_day, fixed_scorer))
    best = ranking.best_scenario(scenario.scenario_summary(scores))
    return best.select("scenario", "avg_risk_reduction", "high_risk_road_days_reduced")


@query
def union_all(t):
    parts = {"incident": "incident_id", "typed": "typed_id", "measure": "sensor_id"}
    return ranking.union_all(
        [t.clean[n].select(F.lit(n).alias("source"), F.col(i).alias("id"), "ts") for n, i in parts.items()]
    )


@query
def distinct_days(t):
    return ranking.distinct_days([t.clean[n] for n in ("incident", "typed", "measure")])


# quality -------------------------------------------------------------------------------------


def _one_metric(df, metric, name):
    return df.agg(metric.alias(name))


@query
def required_columns(t):
    incident = t.clean["incident"]
    rules = [
        quality.required_columns(incident, ["incident_id", "ts", "severity"], "present"),
        quality.required_columns(incident, ["incident_id", "weight"], "absent"),
    ]
    table = quality.evaluate_rules(incident, rules).select("name", "status", "notes")
    return table.withColumn("rows", incident.agg(F.count("*")).scalar())


@query
def lineage_columns(t):
    incident = t.clean["incident"]
    rules = [
        quality.lineage_columns(incident, "present"),
        quality.lineage_columns(incident.drop("record_hash"), "absent"),
    ]
    table = quality.evaluate_rules(incident, rules).select("name", "status", "notes")
    return table.withColumn("hashed_rows", incident.agg(F.count("record_hash")).scalar())


@query
def duplicate_key_rate(t):
    return quality.duplicate_key_rate(t.read("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def invalid_value_rate(t):
    return _one_metric(t.incident, quality.invalid_value_rate("kind", KINDS), "invalid_value_rate")


@query
def negative_rate(t):
    return _one_metric(t.read("customer"), quality.negative_rate("c_acctbal"), "negative_rate")


@query
def parse_fail_rate(t):
    text = F.when(F.col("k") % 13 == 0, "no time").otherwise(F.col("ts").cast("string"))
    return _one_metric(t.events.withColumn("text", text), quality.parse_fail_rate("text"), "parse_fail_rate")


@query
def null_rate(t):
    return _one_metric(t.measure_raw, quality.null_rate("speed"), "null_rate")


@query
def future_rate(t):
    rate = quality.future_rate("ts", "2024-01-20 12:00:00")
    return _one_metric(t.clean["incident"], rate, "future_rate")


@query
def recency_days(t):
    return _one_metric(t.clean["incident"], quality.recency_days("ts", AS_OF), "recency_days")


@query
def out_of_range_rate(t):
    return _one_metric(t.entity_day, quality.out_of_range_rate("p95_speed", 5, 150), "out_of_range_rate")


@query
def unknown_context_rate(t):
    return _one_metric(t.entity_day, quality.unknown_context_rate("weather_mode"), "unknown_context_rate")


@query
def prevalence_gap(t):
    return _one_metric(t.entity_day, quality.prevalence_gap("has_fatality"), "prevalence_gap")


@query
def classify_rule(t):
    per_city = t.incident.groupBy("city").agg(quality.null_rate("mode").alias("metric"))
    status = quality.classify_rule("metric", F.lit(0.9), F.lit(0.95), F.lit(False))
    return per_city.select("city", "metric", status.alias("status"))


@query
def run_contract(t):
    return quality.run_contract(t.governed, quality.standard_contracts(GENERIC, KINDS))


@query
def run_quality(t):
    contracts = quality.standard_contracts(GENERIC, KINDS)
    return quality.run_quality(t.governed, contracts, AS_OF)


@query
def quality_gate(t):
    contracts = quality.standard_contracts(GENERIC, KINDS)
    return quality.quality_gate(quality.run_quality(t.governed, contracts, AS_OF))


# model ---------------------------------------------------------------------------------------


def _parts(train, test, *by):
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", *by)


@query
def temporal_split(t):
    train, test = model.temporal_split(t.stored_day)
    return _parts(train, test).agg(
        F.count("*").alias("rows"),
        F.sum("has_fatality").alias("positives"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
    )


@query
def stratified_split(t):
    train, test = model.stratified_split(t.stored_day)
    return _parts(train, test, "has_fatality").agg(F.count("*").alias("rows"))


@query
def rare_class_split(t):
    days = t.stored_day
    newest = days.agg(F.max(F.struct("date", "entity_id"))).scalar()
    rare = days.withColumn("rare", (F.struct("date", "entity_id") == newest).cast("int"))
    train, test = model.rare_class_split(rare, "rare")
    return _parts(train, test, "rare").agg(F.count("*").alias("rows"))


@query
def encode_features(t):
    fitted = model.encode_features(t.stored_day).fit(t.stored_day)
    values = vector_to_array("_features")
    types = dict(t.stored_day.dtypes)
    numeric = sum(types[c] != "string" for c in model.feature_columns(t.stored_day))
    return fitted.transform(t.stored_day).select(
        "entity_id",
        "date",
        values[2].alias("p95_scaled"),
        F.size(values).cast("long").alias("width"),
        F.aggregate(F.slice(values, F.lit(numeric + 1), F.size(values)), F.lit(0.0), lambda a, x: a + x).alias("ones"),
    )


@query
def class_weights(t):
    return model.class_weights(t.stored_day)


@query
def train_risk_model(t):
    """The gradient of the loss at the fitted coefficients, which is zero at the optimum and nowhere else."""
    train, _, _ = model.split_train_test(t.stored_day)
    coefficients = model.model_coefficients(model.train_risk_model(train), t.stored_day, intercept=True)
    gradient = model.loss_gradient(coefficients, train)
    return gradient.select("feature", F.abs(F.round("gradient", 6)).alias("gradient"))


@query
def model_coefficients(t):
    train, _, _ = model.split_train_test(t.stored_day)
    return model.model_coefficients(model.train_risk_model(train), t.stored_day)


@query
def score_risk(t):
    """How far scores are from the logistic function of the coefficients over plainly encoded features."""
    train, test, _ = model.split_train_test(t.stored_day)
    fitted = model.train_risk_model(train)
    coefficients = model.model_coefficients(fitted, t.stored_day, intercept=True)
    scored = model.score_risk(fitted, test)
    encoded = scored.withColumn("values", model.encoded_values(test, model.feature_scales(train)))
    both = model.with_logistic_risk(encoded, coefficients, "values", "plain")
    return both.select(*GENERIC.grain, F.abs(F.col(model.RISK) - F.col("plain")).alias("off"))


@query
def risk_scores(t):
    train, test, _ = model.split_train_test(t.stored_day)
    return model.score_risk(model.train_risk_model(train), test).select(*GENERIC.grain, model.RISK)


@query
def top_features(t):
    """The place of each top feature among all coefficients by size, and whether it has that coefficient."""
    train, _, _ = model.split_train_test(t.stored_day)
    fitted = model.train_risk_model(train)
    top = model.top_features(fitted, t.stored_day)
    table = model.model_coefficients(fitted, t.stored_day).alias("x")
    larger = F.count_if((F.abs("x.coef") > F.abs("top.coef")) | ((F.abs("x.coef") == F.abs("top.coef")) & (F.col("x.feature") < F.col("top.feature"))))
    same = F.bool_or((F.col("x.feature") == F.col("top.feature")) & (F.col("x.coef") == F.col("top.coef")))
    # two tables of a row per feature
    return top.alias("top").join(F.broadcast(table)).groupBy("top.feature").agg((larger + 1).alias("place"), same.alias("same")).drop("feature")


@query
def risk_report(t):
    return run_risk_model(t.stored_day).metrics


@query
def choose_threshold(t):
    return model.choose_threshold(with_score(t.entity_day), score="score")


@query
def classification_metrics(t):
    return model.classification_metrics(with_score(t.entity_day), 0.4, score="score")


@query
def auc(t):
    return model.auc(with_score(t.entity_day), score="score")


@query
def auc_by_region(t):
    return model.auc(with_score(t.entity_day), ["region"], score="score")


@query
def group_metrics(t):
    scored = with_score(t.stored_day).withColumn("predicted_label", (F.col("score") >= 0.4).cast("int"))
    return model.group_metrics(scored, ["region", "kind"], score="score")


@query
def holdout_scores(t):
    _, test = model.temporal_split(t.stored_day)
    return model.holdout_scores(with_score(test), 0.4, score="score")


# scenarios -----------------------------------------------------------------------------------


@query
def scenario_packages(t):
    changed = scenario.apply_scenarios(t.entity_day)
    return changed.select(
        "entity_id", "date", "scenario", "mean_speed", "p95_speed", "total_violations", "rain_hours"
    )


@query
def normalize_bounds(t):
    bounds = t.stored_day.agg(F.avg("p95_speed").alias("mid"), F.max("p95_speed").alias("top"))
    attached = joins.scalar_broadcast(t.stored_day.select("entity_id", "date", "p95_speed"), bounds)
    return attached.select("entity_id", "date", fn.normalize_bounds("p95_speed", "mid", "top").alias("scaled"))


@query
def pressure_score(t):
    bounds = agg.quantile_bounds(t.stored_day, list(scenario.PRESSURE_WEIGHTS))
    return scenario.pressure_score(t.stored_day, bounds).select("entity_id", "date", "pressure")


@query
def blended_risk(t):
    bounds = agg.quantile_bounds(t.stored_day, list(scenario.PRESSURE_WEIGHTS))
    scored = scenario.blended(t.stored_day, fixed_scorer, scenario.bound_values(bounds), "risk")
    return scored.select("entity_id", "date", "risk")


@query
def high_risk_threshold(t):
    return scenario.high_risk_threshold(with_score(t.stored_day), "score")


@query
def scenario_scores(t):
    return scenario.scenario_scores(t.stored_day, fixed_scorer)


@query
def scenario_summary(t):
    return scenario.scenario_summary(reliable(scenario.scenario_scores(t.stored_day, fixed_scorer)))


@query
def scenario_opportunities(t):
    scores = rounded(scenario.scenario_scores(t.stored_day, fixed_scorer), 9)
    return scenario.scenario_opportunities(scores)


@query
def scenario_region_impact(t):
    return scenario.scenario_region_impact(reliable(scenario.scenario_scores(t.stored_day, fixed_scorer)))


@query
def scenario_summary_trained(t):
    train, _, _ = model.split_train_test(t.stored_day)
    fitted = model.train_risk_model(train)
    return run_scenarios(t.stored_day, scenario.model_scorer(fitted)).summary


# star schema, measures -----------------------------------------------------------------------


@query
def dim_entity(t):
    return star.dim_entity(t.clean["registry"])


@query
def dim_date(t):
    return star.dim_date([t.clean[n] for n in ("incident", "typed", "measure")])


@query
def fact_incident(t):
    return star.fact_incident(t.incident)


@query
def fact_typed_event(t):
    return star.fact_typed_event(t.clean["typed"])


@query
def fact_measure(t):
    return star.fact_measure(t.clean["measure"])


@query
def fact_entity_day(t):
    return star.fact_entity_day(t.entity_day)


@query
def export_star(t):
    path = shared_dir(t.spark, "star")
    tables = star.star_tables(t.governed)
    layers.export_star(tables, path)
    back = layers.read_layer(t.spark, path, list(tables))
    return ranking.union_all([lineage.content_digest(df, name) for name, df in back.items()])


@query
def measures_core(t):
    facts = star.star_tables(t.governed)
    regional = joins.star_join(facts["fact_incident"], [(facts["dim_entity"], ["entity_id"])])
    return star.measures_core({"fact_incident": regional}, ["region"])


@query
def measures_exposure(t):
    return star.measures_exposure(star.star_tables(t.governed), ["date"])


@query
def measures_exposure_total(t):
    return star.measures_exposure(star.star_tables(t.governed))


@query
def measures_extended(t):
    return star.measures_extended(star.star_tables(t.governed), ["date"], counted_types=("click", "view"))


# profiling -----------------------------------------------------------------------------------


@query
def data_dictionary(t):
    return profile.data_dictionary(t.governed)


@query
def column_samples(t):
    """Every column of the five tables, lineage included; doubles to three digits, which both engines print alike."""
    listed = profile.table_samples({name: _three_digits(df) for name, df in t.governed.items()})
    return listed.withColumn("null_pct", F.round("null_pct", 6))


def _three_digits(df):
    return df.select(*[F.round(c, 3).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query
def sensitivity_class(t):
    listed = profile.data_dictionary(t.governed)
    return listed.select("dataset", "column", "null_rate", profile.sensitivity_class("column").alias("sensitivity"))
