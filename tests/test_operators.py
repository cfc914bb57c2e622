"""Small hand-computed cases, mostly about nulls, ties, zero denominators and empty tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daygrain.names import GENERIC
from daygrain.operators import aggregates as agg
from daygrain.operators import clean, joins, profile, quality, ranking, star

DAY = date(2024, 1, 1)


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_dedupe_keys_takes_the_first_in_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (None, "c", 3), (None, "d", 0)], "k int, v string, o int")
    assert rows(clean.dedupe_keys(df, ["k"], ["o"]), "k", "v") == [(1, "a"), (None, "d")]
    assert rows(clean.dedupe_keys(df, ["k"]), "k", "v") == [(1, "a"), (None, "c")]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "v double, i int")
    assert rows(clean.nan_to_null(df), "v") == [(2.0,), (None,)]


@pytest.mark.parametrize("exact", [True, False])
def test_fill_median_clip_uses_the_median_before_limiting(spark, exact):
    df = spark.createDataFrame([(10.0,), (300.0,), (400.0,), (None,)], "v double")
    got = rows(clean.fill_median_clip(df, "v", 0.0, 220.0, exact), "v")
    assert got == [(10.0,), (220.0,), (220.0,), (220.0,)]


def test_default_fill(spark):
    df = spark.createDataFrame([(1, None, None, None)], "k int, kind string, n bigint, x double")
    assert rows(clean.default_fill(df, ["kind", "absent"], ["k"]), "kind", "n", "x") == [("Unknown", 0, 0.0)]


def test_slice_filter(spark):
    df = spark.createDataFrame(
        [("N", "A", date(2024, 1, d)) for d in range(1, 6)] + [("S", "A", DAY), (None, "A", DAY)],
        "region string, kind string, date date",
    )
    assert clean.slice_filter(df).count() == 7
    assert clean.slice_filter(df, "N", start="2024-01-02", end=date(2024, 1, 4)).count() == 3
    assert clean.slice_filter(df.drop("kind"), kind="B").count() == 7
    domain = rows(clean.slice_domain(df), "field", "value")
    assert domain == [("kind", "A"), ("max_date", "2024-01-05"), ("min_date", "2024-01-01"), ("region", "N"), ("region", "S")]


def test_lookup_missing_brings_only_absent_columns(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, a string")
    lookup = spark.createDataFrame([(1, "no", 9), (1, "no", 5), (3, "no", 7)], "k int, a string, b int")
    got = joins.lookup_missing(base, lookup, ["k"], ["a", "b", "c"], ["b"])
    assert rows(got, "k", "a", "b") == [(1, "x", 5), (2, "y", None), (None, "z", None)]
    assert joins.lookup_missing(base, lookup, ["k"], ["a"]) is base


def test_fk_violation_rate_counts_nulls(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (1,), (5,)], "k int")
    assert joins.fk_violation_rate(fact, dim, "k").first()[0] == 0.5
    assert joins.fk_violations(fact, dim, "k").count() == 2
    assert joins.fk_violation_rate(fact.limit(0), dim, "k").first()[0] is None


def test_scalar_broadcast(spark):
    got = joins.scalar_broadcast(spark.range(2), spark.createDataFrame([(7, "t")], "a int, b string"))
    assert rows(got, "id", "a", "b") == [(0, 7, "t"), (1, 7, "t")]


def test_daily_context_mode_ties_and_nulls(spark):
    context = spark.createDataFrame(
        [("r", "c", DAY, m, v, p, t) for m, v, p, t in (
            ("Rain", 3.0, 1.0, 10.0), ("Fog", 5.0, None, 20.0), (None, None, 4.0, None), (None, 1.0, 0.0, 30.0))],
        "region string, city string, date date, mode string, visibility double, precip double, temp double",
    )
    row = agg.daily_context(context, ["region", "city", "date"]).first()
    assert row["weather_mode"] == "Fog"
    assert (row["low_visibility_hours"], row["rain_hours"], row["fog_hours"]) == (2, 1, 1)
    assert (row["max_precip_mm"], row["avg_temp_c"]) == (4.0, 20.0)


def test_typed_pivot_and_total(spark):
    typed = spark.createDataFrame([(1, DAY, "b", 1), (1, DAY, "b", 2), (2, DAY, "a", 3)], "e int, d date, t string, i int")
    got = agg.typed_pivot(typed, ["e", "d"], "t", "i")
    assert got.columns == ["e", "d", "a", "b"]
    total = agg.row_total(got, ["a", "b"])
    assert rows(total, "e", "a", "b", "total_violations") == [(1, 0, 2, 2), (2, 1, 0, 1)]
    assert rows(agg.row_total(got, []), "total_violations") == [(0,), (0,)]


def sources(spark):
    ts = datetime(2024, 1, 1, 5, 30)
    return {
        "registry": spark.createDataFrame(
            [(1, "N", "C", "A", 1.0), (1, "Z", "C", "A", 1.0)],
            "entity_id int, region string, city string, kind string, capacity double",
        ),
        "measure": spark.createDataFrame(
            [(1, ts, 1, 600, 50.0), (2, ts, 1, -5, None), (3, ts, 9, 0, 300.0), (4, None, 1, 1, 1.0), (5, ts, None, 1, 2.0)],
            "sensor_id int, ts timestamp, entity_id int, volume int, speed double",
        ),
        "typed": spark.createDataFrame(
            [(1, ts, 1, "view", 5.0), (2, ts, 1, None, 5.0), (3, ts, 1, "click", 99999.0)],
            "typed_id int, ts timestamp, entity_id int, event_type string, amount double",
        ),
        "incident": spark.createDataFrame(
            [(1, ts, 1, None, 99, None, "Day", "Fatal"), (2, ts, 1, 2, None, 2, "Day", None), (3, ts, 7, 1, 1, 1, "Day", "Fatal")],
            "incident_id int, ts timestamp, entity_id int, vehicles int, injuries int, fatalities int, lighting string, severity string",
        ),
        "context": spark.createDataFrame(
            [(2, ts, "N", "C", "Rain", 2.0, 1.0, 20.0), (1, ts, "N", "C", "Fog", 9.0, 0.0, 10.0)],
            "context_id int, ts timestamp, region string, city string, mode string, visibility double, precip double, temp double",
        ),
    }


def test_entity_day_edge_cases(spark):
    tables = clean.clean_sources(sources(spark))
    got = {r["entity_id"]: r for r in agg.build_entity_day(tables).collect()}
    assert set(got) == {1, 9}  # entity 7 has an incident but no measure
    first = got[1]
    assert (first["daily_volume"], first["sensor_events"], first["mean_speed"]) == (500, 2, 112.5)  # the missing speed is the median 175
    assert (first["accidents"], first["injuries"], first["fatalities"], first["severe"]) == (2, 20, 2, 1)
    assert (first["click"], first["view"], first["purchase"], first["total_violations"]) == (1, 1, 0, 2)
    assert (first["region"], first["weather_mode"], first["rain_hours"]) == ("N", "Fog", 1)
    assert (first["has_fatality"], first["severe_rate"], first["violations_per_1000_volume"]) == (1, 0.5, 4.0)
    other = got[9]
    assert (other["region"], other["weather_mode"], other["capacity"]) == ("Unknown", "Unknown", 0.0)
    assert (other["mean_speed"], other["violations_per_1000_volume"], other["severe_rate"]) == (220.0, 0.0, 0.0)
    assert not any(v is None for r in got.values() for v in r)


def test_enriched_incident_takes_the_first_context_row(spark):
    tables = clean.clean_sources(sources(spark))
    got = {r["incident_id"]: r for r in agg.enrich_incident(tables).collect()}
    assert (got[1]["mode"], got[1]["vehicles"], got[1]["injuries"]) == ("Fog", 1, 20)
    assert got[3]["mode"] is None


def incidents(spark):
    return spark.createDataFrame(
        [
            (1, datetime(2024, 1, 7), 1, "N", "C", "A", "Fatal", 2, 1),
            (2, datetime(2024, 1, 8), 1, "N", "C", "A", None, 0, 0),
            (3, datetime(2024, 1, 8), 2, "S", "D", "B", "Severe", 2, 0),
            (4, None, 3, None, None, None, "Minor", 0, 3),
        ],
        "incident_id int, ts timestamp, entity_id int, region string, city string, kind string, severity string, fatalities int, injuries int",
    )


def test_kpis(spark):
    row = agg.kpi_summary(incidents(spark)).first()
    assert (row["accidents"], row["fatalities"], row["injuries"], row["severe"]) == (4, 4, 4, 2)
    assert (row["severe_rate"], row["fatality_rate"]) == (0.5, 1.0)
    empty = agg.kpi_summary(incidents(spark).limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0.0, 0.0)


def test_category_mix(spark):
    assert agg.category_mix(incidents(spark), "severity").count() == 3
    assert agg.category_mix(incidents(spark), "severity", keep_null=True).count() == 4


def test_severity_profile_drops_null_groups(spark):
    got = rows(agg.severity_profile(incidents(spark), ["region", "kind"]), "dimension", "value", "accidents", "severe")
    assert got == [("kind", "A", 2, 1), ("kind", "B", 1, 1), ("region", "N", 2, 1), ("region", "S", 1, 1)]


def test_weekly_trend(spark):
    trend = agg.weekly_trend(incidents(spark))
    assert [tuple(r) for r in trend.collect()] == [
        ("2024-01-01/2024-01-07", 1, 1, 2),
        ("2024-01-08/2024-01-14", 2, 1, 2),
    ]
    assert [r["week"] for r in agg.trend_tail(trend, 1).collect()] == ["2024-01-08/2024-01-14"]
    assert agg.fold_metrics(trend, ["week"], ["accidents", "severe"]).count() == 4


def test_hotspots(spark):
    by_rate = agg.hotspots_by_rate(incidents(spark), 1).collect()
    assert [r["entity_id"] for r in by_rate] == [2, 1]
    assert [r["entity_id"] for r in agg.hotspots_by_count(incidents(spark)).collect()] == [1, 2]
    assert agg.hotspots_by_rate(incidents(spark)).count() == 0


def test_leading_group(spark):
    assert agg.leading_group(incidents(spark), "region").first()[0] == "N"
    assert agg.leading_group(incidents(spark).limit(0), "region").first()[0] == "n/a"


def test_correlation_of_flat_and_missing_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None, 0), (2.0, 5.0, 1.0, 0), (4.0, 5.0, 3.0, 1), (5.0, 5.0, None, 1)],
        "a double, flat double, gaps double, has_fatality int",
    )
    got = {r["signal"]: r["corr"] for r in agg.signal_correlation(df, ["a", "flat", "gaps", "absent"]).collect()}
    assert set(got) == {"a", "gaps"}
    assert got["a"] == pytest.approx(0.9486832980505138)
    assert got["gaps"] == pytest.approx(1.0)


def test_quantile_bounds(spark):
    df = spark.createDataFrame([(float(v),) for v in range(21)] + [(None,)], "a double")
    exact = agg.quantile_bounds(df, ["a", "absent"]).first()
    assert (exact["feature"], exact["lower"], exact["upper"]) == ("a", pytest.approx(0.05), pytest.approx(18.95))
    near = agg.quantile_bounds(df, ["a"], exact=False).first()
    assert abs(near["upper"] - exact["upper"]) <= 1


def test_top_k_places_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 9)], "id int, v int")
    assert [r["id"] for r in ranking.top_k(df, ["v"], 4, ["id"]).collect()] == [4, 2, 3, 1]
    both = df.withColumn("g", F.col("id") % 2)
    assert rows(ranking.top_k_per_group(both, ["g"], ["v"], 1, ["id"]), "g", "id") == [(0, 4), (1, 3)]


def test_top_k_per_group_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    plan = ranking.top_k_per_group(df, ["g"], ["id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_duplicate_and_row_rates(spark):
    df = spark.createDataFrame([(1, "a", -1.0), (1, "a", None), (None, "b", 5.0), (None, None, 2.0)], "k int, c string, v double")
    assert quality.duplicate_key_rate(df, ["k"]).first()[0] == 0.5
    row = df.agg(
        quality.invalid_value_rate("c", ["a"]).alias("bad"),
        quality.negative_rate("v").alias("neg"),
        quality.null_rate("k").alias("null"),
        quality.unknown_context_rate("c").alias("unknown"),
        quality.out_of_range_rate("v", 0, 3).alias("range"),
    ).first()
    assert tuple(row) == (0.5, 0.25, 0.5, 0.25, 0.5)


def test_time_rules(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-03 12:00:00",), ("never",), (None,)], "ts string")
    row = df.agg(
        quality.parse_fail_rate("ts").alias("parse"),
        quality.future_rate("ts", "2024-01-02 00:00:00").alias("future"),
        quality.recency_days("ts", "2024-01-05 00:00:00").alias("age"),
    ).first()
    assert tuple(row) == (0.5, 0.25, 1.5)


def test_classify_rule(spark):
    cases = [(None, None, None, False, "PASS"), (None, 0.0, 1.0, False, "FAIL"), (0.0, 0.0, 0.5, False, "PASS"),
             (0.5, 0.0, 0.5, False, "WARN"), (0.6, 0.0, 0.5, False, "FAIL"), (0.0, 0.0, 0.5, True, "FAIL"),
             (float("nan"), 0.0, 0.5, False, "FAIL"), (0.6, 0.0, None, False, "FAIL")]
    df = spark.createDataFrame(cases, "m double, p double, w double, f boolean, want string")
    got = df.select(quality.classify_rule("m", "p", "w", "f").alias("s"), "want").collect()
    assert [r["s"] for r in got] == [r["want"] for r in got]


def quality_tables(spark):
    tables = clean.clean_sources(sources(spark))
    lineage = {"source_system": F.lit("s"), "ingest_batch_id": F.lit("b"), "record_hash": F.lit("h")}
    incident = agg.enrich_incident(tables).withColumns(lineage)
    return {"registry": tables["registry"], "incident": incident, "entity_day": agg.build_entity_day(tables)}


def test_run_quality_has_37_rules(spark):
    contracts = quality.standard_contracts(GENERIC, ("A",))
    tables = quality_tables(spark)
    # the registry has one measure column here; the two-column road registry has one rule more
    results = quality.run_quality(tables, contracts, "2024-01-02 00:00:00").collect()
    assert len(results) == 36
    assert [r["position"] for r in results] == list(range(36))
    by_name = {r["name"]: r for r in results}
    assert by_name["incident.fk_violation_rate"]["metric"] == pytest.approx(1 / 3)
    assert by_name["incident.recency_days"]["status"] == "PASS"
    assert by_name["incident.contract_invalid_severity_rate"]["status"] == "FAIL"
    gate = quality.quality_gate(quality.run_quality(tables, contracts, "2024-01-02 00:00:00")).first()
    assert gate["total"] == 36 and gate["gate_status"] == "FAIL"
    assert gate["pass"] + gate["warn"] + gate["fail"] == 36


def test_contract_skips_the_key_rule_when_columns_are_missing(spark):
    tables = {"registry": spark.createDataFrame([(1,)], "entity_id int")}
    contracts = {"registry": quality.standard_contracts(GENERIC)["registry"]}
    results = quality.run_contract(tables, contracts).collect()
    assert [(r["name"], r["status"]) for r in results] == [("registry.contract_required_columns", "FAIL")]
    assert "region" in results[0]["notes"]


def test_empty_tables_fail_the_gate(spark):
    tables = {k: v.limit(0) for k, v in quality_tables(spark).items()}
    results = quality.run_quality(tables, quality.standard_contracts(), "2024-01-02 00:00:00")
    by_name = {r["name"]: r["status"] for r in results.collect()}
    assert by_name["incident.recency_days"] == "FAIL"
    assert by_name["incident.null_entity_rate"] == "FAIL"


def test_star_dates(spark):
    df = spark.createDataFrame([(datetime(2023, 1, 1, 5),), (datetime(2023, 1, 1, 9),), (None,)], "ts timestamp")
    row = star.dim_date([df, df]).collect()
    assert [tuple(r) for r in row] == [(date(2023, 1, 1), 2023, 1, "January", 1, "Sunday", 52)]


def test_measures_by_dims_keep_unmatched_and_null_groups(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "d string, m int")
    b = spark.createDataFrame([(None, 5), ("y", 6)], "d string, n int")
    assert rows(star.by_dims([a, b], ["d"]), "d", "m", "n") == [("x", 1, None), ("y", None, 6), (None, 2, 5)]
    one = star.by_dims([a.agg(F.sum("m").alias("m")), b.agg(F.sum("n").alias("n"))], [])
    assert rows(one, "m", "n") == [(3, 11)]


def test_column_samples_and_dictionary(spark):
    df = spark.createDataFrame([(3, "b"), (1, None), (2, "b"), (9, "a"), (1, None)], "i int, s string")
    got = {r["column"]: r for r in profile.column_samples(df).collect()}
    assert (got["i"]["samples"], got["i"]["null_pct"]) == ("1, 2, 3", 0.0)
    assert (got["s"]["samples"], got["s"]["null_pct"]) == ("a, b", 40.0)
    listed = profile.data_dictionary({"t": df}, {"i": "An id"}).collect()
    assert [(r["column"], r["dtype"], r["description"], r["rows"]) for r in listed] == [
        ("i", "int", "An id", 5),
        ("s", "string", profile.DEFAULT_DESCRIPTION, 5),
    ]


def test_column_samples_read_once_and_agree_with_distinct_values(spark):
    df = spark.range(20_000, numPartitions=9).selectExpr(
        "id", "id % 2 = 0 as flag", "if(id % 5 = 0, null, cast(id % 3 as string)) as few", "cast(null as date) as none",
        "if(id % 7 = 0, double('NaN'), double(id)) as d", "cast('NaN' as double) as nan", "array(9 - id % 4) as a",
        "map('k', id % 2) as m", "cast(-id as decimal(12, 2)) as money", "timestamp_seconds(id) as ts", "concat('é', id) as s",
    )
    df = df.toDF(*df.columns[:-1], "id")  # a name that comes twice
    result = profile.column_samples(df)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 20000") == 1
    got = [(r["null_pct"], r["samples"]) for r in result.orderBy("position").collect()]
    want = [
        (0.0, "0, 1, 2"), (0.0, "false, true"), (20.0, "0, 1, 2"), (100.0, ""), (0.0, "1.0, 2.0, 3.0"), (0.0, "NaN"),
        (0.0, "[6], [7], [8]"), (0.0, "{k -> 0}, {k -> 1}"), (0.0, "-19999.00, -19998.00, -19997.00"),
        (0.0, "1970-01-01 00:00:00, 1970-01-01 00:00:01, 1970-01-01 00:00:02"), (0.0, "é0, é1, é10"),
    ]
    assert got == want
    empty = profile.column_samples(df.where("d < 0")).orderBy("position").collect()
    assert [(r["null_pct"], r["samples"]) for r in empty] == [(None, "")] * len(want)


def test_column_samples_count_both_zeros_as_one_value(spark):
    df = spark.createDataFrame([(-0.0,), (0.0,), (1.0,), (2.0,), (3.0,)], "d double").coalesce(1)
    assert profile.column_samples(df).first()["samples"] == "0.0, 1.0, 2.0"


def test_sensitivity(spark):
    df = spark.createDataFrame([("Record_Hash",), ("my_sensor_id_2",), ("city",)], "c string")
    got = [r[0] for r in df.select(profile.sensitivity_class("c")).collect()]
    assert got == ["INTERNAL", "INTERNAL", "PUBLIC"]


def test_sparse_counts_of_many_types(spark):
    typed = spark.range(120_000).select((F.col("id") % 7).alias("e"), F.concat(F.lit("t"), F.col("id") % 50_000).alias("t"), F.col("id").alias("i"))
    counts = agg.typed_counts(typed, ["e"], "t", "i")
    rows = counts.select("e", F.size("counts").alias("kinds"), F.aggregate(F.map_values("counts"), F.lit(0).cast("long"), lambda n, x: n + x).alias("n"))
    assert sum(r["n"] for r in rows.collect()) == 120_000
    want = {r["e"]: r["kinds"] for r in typed.groupBy("e").agg(F.countDistinct("t").alias("kinds")).collect()}
    assert {r["e"]: r["kinds"] for r in rows.collect()} == want
    few = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 3), (2, None, 4), (None, "b", 5), (1, "b", None)], "e int, t string, i int")
    wide = agg.wide_counts(agg.typed_counts(few, ["e"], "t", "i"), ["a", "c"], total="all").collect()
    assert sorted((r["e"] or 0, r["a"], r["c"], r["all"]) for r in wide) == [(0, 0, 0, 1), (1, 2, 0, 2), (2, 0, 0, 0)]
    assert agg.typed_counts(few.where("false"), ["e"], "t", "i").count() == 0

