"""CSV sources through the layers, the gate, the model, the star and a stream."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daygrain.names import ROADS
from daygrain.operators import aggregates as agg
from daygrain.operators import model as M
from daygrain.operators import quality, star
from daygrain.sources import layers
from daygrain.sources.readers import load_sources, read_source
from daygrain.sources.schemas import ROAD_SOURCES
from daygrain.streaming.rowwise import clean_stream

BATCH, AT = "B20240131T000000Z", "2024-01-31T00:00:00+00:00"


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    """Five small CSV files over 20 days and 12 roads."""
    rng = np.random.default_rng(7)
    folder = tmp_path_factory.mktemp("raw")
    roads = [f"R{i:04d}" for i in range(12)]
    places = [("North", "Alpha"), ("North", "Beta"), ("South", "Gamma")]
    place = {r: places[i % 3] for i, r in enumerate(roads)}

    def times(n):
        start = pd.Timestamp("2024-01-10", tz="UTC")
        return [str(start + pd.Timedelta(seconds=int(s))) for s in rng.integers(0, 20 * 86400, n)]

    def pick(values, n):
        return rng.choice(values, n)

    pd.DataFrame(
        {
            "road_id": roads,
            "region": [place[r][0] for r in roads],
            "city": [place[r][1] for r in roads],
            "road_type": pick(["Highway", "Urban", "Rural"], 12),
            "speed_limit": pick([60, 80, 120], 12),
            "lanes": pick([1, 2, 3], 12),
        }
    ).to_csv(folder / "road_segments.csv", index=False)
    hours = pd.date_range("2024-01-10", periods=480, freq="h", tz="UTC")
    weather = pd.DataFrame([(str(h), *p) for h in hours for p in places], columns=["date_time", "region", "city"])
    weather["weather"] = pick(["Clear", "Dust", "Rain", "Fog"], len(weather))
    weather["visibility_km"] = rng.uniform(0.5, 12, len(weather)).round(1)
    weather["precip_mm"] = rng.uniform(0, 25, len(weather)).round(1)
    weather["temp_c"] = rng.uniform(5, 48, len(weather)).round(1)
    weather.to_csv(folder / "weather_hourly.csv", index=False)
    n = 3000
    speed = rng.uniform(10, 250, n).round(1)
    speed[:50] = np.nan
    pd.DataFrame(
        {"sensor_id": rng.integers(1, 349, n), "date_time": times(n), "road_id": pick(roads, n),
         "volume": rng.integers(0, 600, n), "avg_speed": speed}
    ).to_csv(folder / "speed_sensors.csv", index=False)
    n = 800
    pd.DataFrame(
        {"violation_id": [f"V{i:07d}" for i in range(n)], "date_time": times(n), "road_id": pick(roads, n),
         "violation_type": pick(list(ROADS.types), n), "fine_amount": rng.integers(100, 2200, n),
         "driver_age_band": pick(["18-25", "26-40"], n)}
    ).to_csv(folder / "violations.csv", index=False)
    n = 400
    fatal = (rng.random(n) < 0.1).astype(int)
    pd.DataFrame(
        {"incident_id": [f"A{i:06d}" for i in range(n)], "date_time": times(n), "road_id": pick(roads, n),
         "vehicles_involved": rng.integers(1, 5, n), "injuries": rng.integers(0, 4, n), "fatalities": fatal,
         "lighting": pick(["Day", "Night"], n),
         "severity": np.where(fatal == 1, "Fatal", pick(["Minor", "Moderate", "Severe"], n))}
    ).to_csv(folder / "accidents.csv", index=False)
    return str(folder)


@pytest.fixture(scope="module")
def curated(spark, raw_dir, tmp_path_factory):
    return layers.run_layers(spark, raw_dir, str(tmp_path_factory.mktemp("out")), BATCH, AT)


def test_entity_day_against_pandas(curated, raw_dir):
    got = curated["entity_day"].toPandas()
    assert not got.duplicated(["road_id", "date"]).any()
    sensors = pd.read_csv(f"{raw_dir}/speed_sensors.csv", parse_dates=["date_time"])
    sensors["speed"] = sensors.avg_speed.fillna(sensors.avg_speed.median()).clip(0, 220)
    sensors["volume"] = sensors.volume.clip(0, 500)
    sensors["date"] = sensors.date_time.dt.date
    want = sensors.groupby(["road_id", "date"]).agg(
        volume=("volume", "sum"), mean=("speed", "mean"), p95=("speed", lambda s: np.percentile(s, 95))
    ).reset_index()
    both = got.merge(want, on=["road_id", "date"])
    assert len(both) == len(want) == len(got)
    assert (both.daily_volume == both.volume).all()
    assert np.allclose(both.mean_speed, both["mean"]) and np.allclose(both.p95_speed, both.p95)
    assert {"speed_limit", "lanes", "PhoneUse", "weather_mode"} <= set(got.columns)
    assert len(got.columns) == 30


def test_row_hash_prints_timestamps_and_doubles_like_python(spark, raw_dir):
    import hashlib

    staged = load_sources(spark, raw_dir, BATCH, AT)["measure"]
    row = staged.where("avg_speed is not null").orderBy("date_time", "sensor_id").first()
    values = {
        "sensor_id": row["sensor_id"],
        "date_time": row["date_time"].strftime("%Y-%m-%d %H:%M:%S+00:00"),
        "road_id": row["road_id"],
        "volume": row["volume"],
        "avg_speed": row["avg_speed"],
        "source_system": "speed_sensors",
        "ingest_batch_id": BATCH,
        "extracted_at_utc": AT,
    }
    payload = "|".join(f"{k}={values[k]}" for k in sorted(values))
    assert row["record_hash"] == hashlib.sha256(payload.encode()).hexdigest()[:16]


def test_quality_of_the_layers(curated):
    contracts = quality.standard_contracts(ROADS, ("Highway", "Urban", "Rural"))
    results = quality.run_quality(curated, contracts, "2024-01-31 00:00:00", ROADS)
    rows = results.collect()
    assert len(rows) == 37
    failed = [r["name"] for r in rows if r["status"] == "FAIL"]
    assert failed == []
    assert quality.quality_gate(results).first()["total"] == 37


def test_model_on_the_layers(spark, curated, tmp_path):
    train, test, split = M.split_train_test(curated["entity_day"], names=ROADS)
    assert split == M.TEMPORAL
    fitted = M.train_risk_model(train, names=ROADS)
    layers.save_model(fitted, str(tmp_path / "model"))
    loaded = layers.load_model(str(tmp_path / "model"))
    first = M.score_risk(fitted, test).orderBy(*ROADS.grain).select("predicted_risk").collect()
    second = M.score_risk(loaded, test).orderBy(*ROADS.grain).select("predicted_risk").collect()
    assert first == second
    layers.write_results({"holdout": M.holdout_scores(M.score_risk(fitted, test), 0.5, names=ROADS)}, str(tmp_path / "r"), "csv")
    assert spark.read.csv(str(tmp_path / "r/holdout"), header=True).count() == test.count()


def test_star_export(spark, curated, tmp_path):
    tables = star.star_tables(curated, ROADS, ["driver_age_band"])
    layers.export_star(tables, str(tmp_path))
    back = layers.read_layer(spark, str(tmp_path), list(tables))
    assert back["fact_incident"].count() == 400
    assert back["dim_entity"].count() == 12
    assert len(back["fact_entity_day"].columns) == 25
    pruned = back["fact_measure"].where("date = date'2024-01-12'")
    assert "PartitionFilters: [isnotnull(date" in pruned._jdf.queryExecution().executedPlan().toString()
    row = star.measures_extended(tables, names=ROADS).first()
    assert row["Speeding_events"] + row["PhoneUse_events"] > 0


def test_unreadable_csv_values_become_null(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("sensor_id,date_time,road_id,volume,avg_speed\n1,soon,R1,5,NaN\n2,2024-01-01 00:00:00+00:00,R1,,1.5\n")
    rows = read_source(spark, str(path), ROAD_SOURCES["measure"].schema).orderBy("sensor_id").collect()
    assert rows[0]["date_time"] is None and rows[0]["avg_speed"] is None
    assert rows[1]["volume"] is None and rows[1]["avg_speed"] == 1.5


def test_stream_cleaning_equals_batch(spark, raw_dir, curated, tmp_path):
    source = ROAD_SOURCES["incident"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "accidents.csv").write_text(open(f"{raw_dir}/accidents.csv").read())
    stream = spark.readStream.schema(source.schema).option("header", True).csv(str(folder))
    cleaned = clean_stream(stream, "incident", source.system, BATCH, AT, ROADS)
    running = (
        cleaned.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = curated["incident"].select(*got.columns)
    assert got.count() == 400 and got.exceptAll(want).count() == 0


def test_rejoining_the_registry_changes_nothing(curated):
    again = agg.enrich_incident(curated, ROADS)
    assert again.count() == curated["incident"].count()
    assert again.where(F.col("region").isNull()).count() == 0


def test_whole_numbers_written_with_a_fraction(spark, tmp_path):
    from daygrain.operators.clean import clean_incident
    from daygrain.sources.readers import read_source
    from daygrain.sources.schemas import INCIDENT

    path = tmp_path / "i.csv"
    path.write_text(
        "incident_id,date_time,road_id,vehicles_involved,injuries,fatalities,lighting,severity\n"
        "a,2024-01-01 00:00:00,r,2.0,3.0,1.0,Day,Fatal\nb,2024-01-01 00:00:00,r,,x, 4 ,Day,Minor\n"
    )
    read = read_source(spark, str(path), INCIDENT)
    got = {r.incident_id: (r.vehicles_involved, r.injuries, r.fatalities) for r in read.collect()}
    assert got == {"a": (2, 3, 1), "b": (None, None, 4)}
    assert clean_incident(read, ROADS).where("incident_id = 'a'").first().fatalities == 1


def test_load_or_fit(spark, tmp_path):
    from daygrain.names import GENERIC
    from daygrain.operators import model as M

    rows = [(i, f"2024-01-{1 + i % 20:02d}", "NS"[i % 2], float(i % 13), int(i % 5 == 0)) for i in range(200)]
    days = spark.createDataFrame(rows, "entity_id long, date string, region string, speed double, has_fatality int")
    path = str(tmp_path / "model")
    first, fitted = layers.load_or_fit(days, path, names=GENERIC)
    assert fitted
    again, fitted = layers.load_or_fit(days, path, names=GENERIC)
    assert not fitted
    scores = lambda m: [r[M.RISK] for r in M.score_risk(m, days).orderBy("entity_id").collect()]
    assert scores(first) == scores(again)
    renamed = days.withColumnRenamed("speed", "pace")
    assert layers.load_or_fit(renamed, path, names=GENERIC)[1] and not layers.load_or_fit(renamed, path, names=GENERIC)[1]
    assert layers.load_or_fit(days.withColumn("speed", F.col("speed").cast("string")), path, names=GENERIC)[1]
    folder = tmp_path / "model" / "model" / "metadata"
    for part in [*folder.glob("part-*"), *folder.glob(".part-*.crc")]:
        part.unlink() if part.suffix == ".crc" else part.write_text("no json")
    assert layers.load_or_fit(days.withColumn("speed", F.col("speed").cast("string")), path, names=GENERIC)[1]

