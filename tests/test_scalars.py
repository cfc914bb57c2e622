import math
from datetime import date, datetime

from pyspark.sql import functions as F

from daygrain.functions import scalars as fn


def one(spark, column, **values):
    df = spark.range(1)
    for name, (value, dtype) in values.items():
        df = df.withColumn(name, F.lit(value).cast(dtype))
    return df.select(column.alias("x")).first()["x"]


def test_parse_ts_lenient(spark):
    rows = spark.createDataFrame(
        [("2026-01-01 10:20:30+00:00",), ("2026-01-01T10:20:30Z",), ("soon",), (None,)], "t string"
    )
    got = [r[0] for r in rows.select(fn.parse_ts_lenient("t").cast("timestamp_ntz")).collect()]
    assert got == [datetime(2026, 1, 1, 10, 20, 30)] * 2 + [None, None]


def test_day_hour_week(spark):
    ts = {"t": ("2024-01-07 23:59:59", "timestamp")}
    assert one(spark, fn.event_day("t"), **ts) == date(2024, 1, 7)
    assert one(spark, fn.floor_hour("t").cast("timestamp_ntz"), **ts) == datetime(2024, 1, 7, 23)
    assert one(spark, fn.week_label("t"), **ts) == "2024-01-01/2024-01-07"


def test_fill_clip_int(spark):
    for value, want in ((None, 1), (-4.0, 1), (7.9, 7), (99.0, 30)):
        assert one(spark, fn.fill_clip_int("v", 1, 1, 30), v=(value, "double")) == want


def test_clip_keeps_null(spark):
    assert one(spark, fn.clip("v", 0, 5), v=(None, "double")) is None


def test_in_set_and_flag(spark):
    assert one(spark, fn.in_set("v", ["a"]), v=(None, "string")) is False
    assert one(spark, fn.in_set("v", ["a"]), v=("a", "string")) is True
    assert one(spark, fn.flag_any("v"), v=(None, "int")) == 0
    assert one(spark, fn.flag_any("v"), v=(3, "int")) == 1


def test_safe_ratio(spark):
    assert one(spark, fn.safe_ratio("a", "b"), a=(1, "int"), b=(0, "int")) == 0.0
    assert one(spark, fn.safe_ratio("a", "b", 1000.0), a=(1, "int"), b=(8, "int")) == 125.0
    assert one(spark, fn.safe_ratio("a", "b"), a=(None, "int"), b=(8, "int")) == 0.0


def test_bin_column_is_right_closed(spark):
    edges, labels = (-0.01, 0.2, 0.5, 0.75, 1.0), ("Low", "Medium", "High", "Critical")
    cases = {-0.01: "nan", 0.0: "Low", 0.2: "Low", 0.21: "Medium", 0.75: "High", 1.0: "Critical", 1.1: "nan"}
    for value, want in cases.items():
        assert one(spark, fn.bin_column("v", edges, labels), v=(value, "double")) == want
    assert one(spark, fn.bin_column("v", edges, labels), v=(None, "double")) == "nan"


def test_normalize_bounds(spark):
    for value, lo, hi, want in ((5.0, 0.0, 10.0, 0.5), (None, 0.0, 10.0, 0.0), (50.0, 0.0, 10.0, 1.0), (5.0, 3.0, 3.0, 0.0)):
        got = one(spark, fn.normalize_bounds("v", "a", "b"), v=(value, "double"), a=(lo, "double"), b=(hi, "double"))
        assert got == want


def test_python_text_matches_str(spark):
    values = [0.0, -0.0, 1.0, 0.1, 1e-3, 1.5e-4, 1e-4, 9.9e-5, 1e-5, 1.25e-7, 1e-12, 123.456, 9999999.0, 1e7, 12345678.9,
              123456789012.25, 1e15, 1e16, 1.5e22, -2.5e-6, -12345678.5, float("inf"), 3.0e100]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fn.python_text("v", "double")).collect()]
    assert got == [str(v) for v in values]


def test_python_text_of_missing_values(spark):
    assert one(spark, fn.python_text("v", "double"), v=(None, "double")) == "nan"
    assert one(spark, fn.python_text("v", "double"), v=(math.nan, "double")) == "nan"
    assert one(spark, fn.python_text("v", "string"), v=(None, "string")) == "nan"
    assert one(spark, fn.python_text("v", "timestamp"), v=(None, "timestamp")) == "NaT"


def test_python_text_of_timestamps(spark):
    full = {"v": ("2026-01-02 03:04:05.5", "timestamp")}
    assert one(spark, fn.python_text("v", "timestamp"), **full) == "2026-01-02 03:04:05.500000+00:00"
    assert one(spark, fn.python_text("v", "timestamp"), v=("2026-01-02", "timestamp")) == "2026-01-02 00:00:00+00:00"
