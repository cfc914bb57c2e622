from collections import Counter

import pytest
from pyspark.sql import functions as F

from daygrain.functions.skew import KeySketch, crowd_lookup, salted_lookup
from daygrain.operators.joins import star_join


def test_hot_key_with_a_map_column(spark):
    base = spark.range(300).selectExpr("if(id < 250, 1, id) as k", "map('a', id) as m", "id")
    lookup = spark.range(300).selectExpr("id as k", "id * 2 as twice")
    want = sorted((r.id, r.twice) for r in salted_lookup(base, lookup, ["k"]).collect())
    assert sorted((r.id, r.twice) for r in salted_lookup(base, lookup, ["k"], hot_rows=20, max_hot=10).collect()) == want


def _facts(spark):
    """Keys of several kinds: a hot one with two thirds of the rows, nulls, and values that no dimension has."""
    return spark.range(3000).selectExpr(
        "id", "if(id % 3 > 0, 7, id % 11) as a", "if(id % 5 = 0, null, concat('s', id % 4)) as b", "cast(id % 6 as int) as c"
    )


def _dims(spark):
    a = spark.range(9).selectExpr("id as a", "id * 10 as a_value", "id % 3 as far")
    b = spark.createDataFrame([("s0", "zero"), ("s2", "two"), (None, "none")], "b string, b_value string")
    c = spark.range(4).selectExpr("id as c", "-id as c_value")  # long, where the fact has int
    far = spark.range(2).selectExpr("id as far", "id + 100 as far_value")  # a key that the first dimension brings
    return [(a, ["a"]), (b, ["b"]), (c, ["c"]), (far, ["far"])]


@pytest.mark.parametrize(("hot_rows", "max_hot"), [(10**6, 10_000), (50, 10**6), (1, 10**6)])
def test_star_join_equals_left_joins(spark, hot_rows, max_hot):
    want = _facts(spark)
    for dim, keys in _dims(spark):
        want = want.join(dim, keys, "left")
    got = star_join(_facts(spark), _dims(spark), hot_rows, max_hot)
    assert Counter(map(tuple, want.select(*got.columns).collect())) == Counter(map(tuple, got.collect()))


def test_one_sketch_serves_all_dimensions(spark):
    """Jobs that star_join runs while it is put together: as many for five dimensions as for two."""

    def jobs(count):
        spark.sparkContext.setJobGroup(f"star-{count}", "")
        dims = [(spark.range(5).selectExpr(f"id as k{i}", f"id as v{i}"), [f"k{i}"]) for i in range(count)]
        star_join(spark.range(500).selectExpr(*[f"id % {i + 2} as k{i}" for i in range(count)]), dims)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"star-{count}"))

    try:
        assert jobs(2) == jobs(5) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_pieces_come_from_the_counts(spark):
    sketch = KeySketch(_facts(spark), [["a"], ["c"]], hot_rows=600, max_hot=10**6)
    hot = {r["_code"]: r["_pieces"] for r in sketch.pieces(["a"]).collect()}
    sizes = _facts(spark).groupBy("a").count().collect()
    assert sorted(hot.values()) == [-(-r["count"] // 600) for r in sizes if r["count"] > 600]
    assert sketch.pieces(["c"]) is None
    assert not sketch.covers(_facts(spark), spark.range(3).selectExpr("id as c"), ["c"])
    empty = KeySketch(_facts(spark).limit(0), [["a"], ["b"]])
    assert empty.pieces(["a"]) is None and KeySketch(_facts(spark), [["absent"]]).kinds == {}


@pytest.mark.parametrize("most", [10**6, 20, 1])
def test_crowd_lookup_equals_left_join(spark, most):
    members = spark.range(200).selectExpr("id as m", "if(id % 10 = 0, null, if(id % 4 = 0, 'small', 'large')) as city")
    base = members.withColumn("day", F.explode(F.array(*[F.lit(d) for d in range(4)])))
    lookup = spark.createDataFrame([("small", 0, 1.0), ("large", 0, 2.0), ("large", 2, 3.0), (None, 1, 4.0)], "city string, day int, x double")
    got = crowd_lookup(base, lookup, ["city", "day"], "m", members, ["city"], most, max_hot=10**6)
    assert got.columns == ["m", "city", "day", "x"]
    want = base.join(lookup, ["city", "day"], "left").select(*got.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
