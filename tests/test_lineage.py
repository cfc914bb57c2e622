from datetime import datetime

from daygrain.operators import lineage

# Rows whose hash is known.
GOLDEN = [
    ("R0000", "Eastern", "Dammam", "Urban", 80, 2, "83aebf41226026b1"),
    ("R0001", "Riyadh", "Riyadh", "Urban", 80, 2, "279df14a5c0aead4"),
    ("R0002", "Qassim", "Buraidah", "Highway", 60, 5, "42fddcf7f3b72ffa"),
    ("R0003", "Madinah", "Madinah", "Highway", 60, 5, "c1e076fb4ede54d7"),
]
SCHEMA = "road_id string, region string, city string, road_type string, speed_limit int, lanes int, want string"


def test_record_hash_golden(spark):
    df = spark.createDataFrame(GOLDEN, SCHEMA)
    staged = lineage.add_lineage(
        df.drop("want"), "roads_registry", "B20260305T000843Z", "2026-03-05T00:08:43+00:00"
    )
    got = {r["road_id"]: r["record_hash"] for r in lineage.record_hash(staged).collect()}
    assert got == {row[0]: row[-1] for row in GOLDEN}


def test_business_hash_ignores_the_batch(spark):
    df = spark.createDataFrame(GOLDEN, SCHEMA).drop("want")
    one = lineage.record_hash(lineage.add_lineage(df, "a", "B1", "t1"), include_lineage=False)
    two = lineage.record_hash(lineage.add_lineage(df, "b", "B2", "t2"), include_lineage=False)
    assert {r["record_hash"] for r in one.collect()} == {r["record_hash"] for r in two.collect()}


def test_batch_id():
    assert lineage.batch_id(datetime(2026, 3, 5, 0, 8, 43)) == "B20260305T000843Z"


def test_normalize_lineage(spark):
    df = spark.createDataFrame([(1, "s", "b", "h")], "id int, source_system_x string, ingest_batch_id string, record_hash_accident string")
    assert lineage.normalize_lineage(df).columns == ["id", "source_system", "ingest_batch_id", "record_hash"]
    kept = df.withColumnRenamed("id", "source_system")
    assert "source_system_x" in lineage.normalize_lineage(kept).columns


def test_lineage_summary(spark):
    df = spark.createDataFrame(
        [("b", "B2", "h"), ("a", "B1", None), ("a", "B1", "h"), (None, "B1", "h")],
        "source_system string, ingest_batch_id string, record_hash string",
    )
    bare = spark.range(3)
    got = {r["dataset"]: r for r in lineage.lineage_summary({"x": df, "bare": bare, "none": df.limit(0)}).collect()}
    assert got["x"]["source_systems"] == "a, b"
    assert got["x"]["batch_ids"] == "B1, B2"
    assert got["x"]["record_hash_coverage"] == 0.75
    assert (got["bare"]["rows"], got["bare"]["source_systems"], got["bare"]["record_hash_coverage"]) == (3, "", 0.0)
    assert got["none"]["rows"] == 0


def test_content_digest(spark):
    from pyspark.sql import functions as F

    from daygrain.operators.lineage import content_digest

    rows = [(1, "a", 0.1, None), (2, None, 2.5, True), (1, "a", 0.1, None)]
    df = spark.createDataFrame(rows, "i int, s string, d double, b boolean")
    one = content_digest(df, "x").first()
    assert (one["name"], one["rows"]) == ("x", 3)
    assert content_digest(df.select("d", "b", "s", "i").repartition(3), "x").first() == one
    for other in (df.where("i = 2"), df.distinct(), df.withColumn("d", F.col("d") + 1e-5), df.withColumnRenamed("s", "t"), df.fillna("~~")):
        assert content_digest(other, "x").first()["digest"] != one["digest"]
    assert content_digest(df.where("false"), "x").first()["digest"] == "0"



def test_content_digest_is_the_sum_of_48_bits_a_row(spark):
    import hashlib

    from daygrain.operators.lineage import content_digest

    df = spark.range(300).selectExpr("id as i", "cast(id * 3 as string) as s")
    want = sum(int(hashlib.md5(f"i={i}|s={i * 3}".encode()).hexdigest()[:12], 16) for i in range(300))
    got = content_digest(df, "x")
    assert got.first()["digest"] == str(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "as decimal" not in plan.split("Project")[-1]  # no decimal a row, only in the one row of sums
