import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daygrain.functions.order_stats import exact_percentile_of_table, exact_percentiles, find_hot, locate, ranked_values
from daygrain.functions.skew import salted_lookup
from daygrain.operators.model import auc


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds about a third of the rows, one key is null, values repeat."""
    rng = np.random.default_rng(5)
    n = 6000
    key = np.where(rng.random(n) < 0.35, 1, rng.integers(2, 40, n)).astype(object)
    key[rng.random(n) < 0.2] = None
    value = np.round(rng.lognormal(1, 2, n), 1)
    value[rng.random(n) < 0.1] = 7.0
    frame = pd.DataFrame({"k": key, "v": value, "w": 1})
    frame.loc[rng.random(n) < 0.05, "v"] = None
    rows = [tuple(None if pd.isna(x) else x for x in row) for row in frame.itertuples(index=False)]
    rows = [(None if k is None else int(k), v, int(w)) for k, v, w in rows]
    return frame, spark.createDataFrame(rows, "k long, v double, w int").repartition(6)


@pytest.mark.parametrize("hot_rows", [10**6, 500, 1])
def test_grouped_percentiles_equal_numpy(skewed, hot_rows):
    frame, df = skewed
    got = exact_percentiles(
        df, ["k"], "v", {"p95": 0.95, "p50": 0.5, "p0": 0.0, "p1": 1.0}, [F.sum("w").alias("w")],
        hot_rows=hot_rows, cuts=16,
    ).collect()
    groups = frame.groupby("k", dropna=False)
    assert len(got) == groups.ngroups
    for row in got:
        part = frame[frame.k.isna()] if row["k"] is None else frame[frame.k == row["k"]]
        values = part.v.dropna()
        assert row["w"] == len(part)
        for name, q in (("p95", 95), ("p50", 50), ("p0", 0), ("p1", 100)):
            assert row[name] == pytest.approx(np.percentile(values, q), abs=1e-9)


@pytest.mark.parametrize("hot_rows", [10**6, 10])
def test_table_percentile(skewed, hot_rows):
    frame, df = skewed
    row = exact_percentile_of_table(df, "v", {"a": 0.85, "b": 0.05}, hot_rows=hot_rows, cuts=32).first()
    assert row["a"] == pytest.approx(np.percentile(frame.v.dropna(), 85), abs=1e-9)
    assert row["b"] == pytest.approx(np.percentile(frame.v.dropna(), 5), abs=1e-9)


def test_table_percentile_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_percentile_of_table(empty, "v", {"a": 0.5}).collect()[0]["a"] is None


def test_all_values_equal(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit(3.5).alias("v"))
    row = exact_percentiles(df, ["k"], "v", {"m": 0.5}, hot_rows=10, cuts=8).first()
    assert row["m"] == 3.5


def test_hot_groups_are_those_above_the_limit(skewed):
    frame, df = skewed
    assert find_hot(df, ["k"], 10**6) is None
    sizes = {k if k == k else None: n for k, n in frame.groupby("k", dropna=False).size().items()}
    assert {r["k"]: r["_size"] for r in find_hot(df, ["k"], 80).collect()} == {k: n for k, n in sizes.items() if n > 80}


def test_ranked_values_by_group(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1000).alias("v"))
    got = {r["g"]: r["x"] for r in ranked_values(df, ["g"], "v", {"x": F.lit(10)}, cell_rows=5, cuts=8).collect()}
    pdf = df.toPandas()
    assert got == {g: sorted(part.v)[10] for g, part in pdf.groupby("g")}


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_equals_pair_counting(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(800) < 0.3).astype(int)
    s = np.round(rng.random(800) * 0.7 + y * 0.2, 2)
    g = rng.integers(0, 3, 800)
    y[g == 2] = 0
    df = spark.createDataFrame(list(zip(g.tolist(), y.tolist(), s.tolist())), "g int, y int, s double")
    total = auc(df, (), "y", "s", slices=8).first()["auc"]
    assert total == pytest.approx(brute_auc(y, s), abs=1e-12)
    by_group = {r["g"]: r["auc"] for r in auc(df, ["g"], "y", "s", slices=8).collect()}
    assert by_group[2] is None
    for group in (0, 1):
        assert by_group[group] == pytest.approx(brute_auc(y[g == group], s[g == group]), abs=1e-12)


@pytest.mark.parametrize("hot_rows", [10**6, 300, 1])
def test_salted_lookup_equals_left_join(spark, skewed, hot_rows):
    frame, df = skewed
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(1, 30)], "k long, name string")
    got = salted_lookup(df, lookup, ["k"], hot_rows=hot_rows, max_hot=10**6)
    assert got.columns == ["k", "v", "w", "name"]
    counts = {(r["k"], r["name"]): r["n"] for r in got.groupBy("k", "name").agg(F.count("*").alias("n")).collect()}
    want = df.join(lookup, "k", "left").groupBy("k", "name").agg(F.count("*").alias("n")).collect()
    assert counts == {(r["k"], r["name"]): r["n"] for r in want}
    assert got.count() == len(frame)


def test_salted_lookup_splits_the_hot_key(spark, skewed):
    _, df = skewed
    lookup = spark.createDataFrame([(1, "one")], "k long, name string")
    got = salted_lookup(df.hint("merge"), lookup, ["k"], hot_rows=300, max_hot=10**6)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_sliced_and_buffered_percentiles_agree_to_the_last_bit(spark):
    from daygrain.functions.order_stats import exact_percentiles

    df = spark.range(5000).selectExpr("id % 7 as g", "rand(3) * 1000 / 3 as v")
    df = df.withColumn("v", F.round("v", 9)).cache()
    probs = {"a": 0.95, "b": 0.5, "c": 0.123}
    plain = {r["g"]: tuple(r[p] for p in probs) for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    sliced = {r["g"]: tuple(r[p] for p in probs) for r in exact_percentiles(df, ["g"], "v", probs, hot_rows=1).collect()}
    assert plain == sliced and len(plain) == 7


@pytest.mark.parametrize("max_hot", [10**6, 0])
def test_slices_above_the_limit_are_cut_again(spark, max_hot):
    rng = np.random.default_rng(8)
    # half of the rows of group 1 in a narrow band, a value that repeats over the limit, and groups of other scales
    band = np.concatenate([1 + rng.random(6000) * 1e-6, rng.lognormal(0, 9, 3000), np.full(3000, 7.0)])
    other = [-(10.0 ** rng.integers(0, 12)) * x for x in rng.random(3000)]
    rows = [(1, float(x)) for x in band] + [(None, float(x)) for x in other] + [(3, 5.0)] * 900 + [(4, float(x)) for x in range(90)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(7)
    wanted = (0.0, 0.1, 0.25, 0.5, 0.6, 0.75, 0.9, 1.0)
    ranks = {f"r{i}": F.floor((F.col("_n") - 1) * p) for i, p in enumerate(wanted)}
    cells, rounds = locate(df, ["k"], "v", ranks, 100, 8, max_hot)
    assert rounds >= 2
    assert cells.where("_value is null").agg(F.max("_size")).first()[0] <= 100
    got = {r["k"]: r for r in ranked_values(df, ["k"], "v", ranks, cell_rows=100, cuts=8, max_hot=max_hot).collect()}
    for k in (1, None, 3, 4):
        values = sorted(v for x, v in rows if x == k)
        assert got[k]["_n"] == len(values)
        assert [got[k][f"r{i}"] for i in range(len(wanted))] == [values[int((len(values) - 1) * p)] for p in wanted]


def test_long_values_beyond_doubles(spark):
    rows = [(2**60 + i % 50,) for i in range(2000)] + [(-(2**61) - i,) for i in range(300)]
    df = spark.createDataFrame(rows, "v long").withColumn("g", F.lit("a"))
    ranks = {"x": F.lit(1000), "y": F.lit(5), "none": F.lit(-1), "over": F.lit(10**6)}
    row = ranked_values(df, ["g"], "v", ranks, cell_rows=20, cuts=8).first()
    values = sorted(v for (v,) in rows)
    assert (row["x"], row["y"], row["none"], row["over"]) == (values[1000], values[5], None, None)


def test_the_plan_behind_the_values_runs_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    df = spark.range(4000).selectExpr("id % 3 AS g", "cast((id * 7919) % 4001 AS double) AS v").mapInPandas(counted, "g long, v double")
    found = ranked_values(df, ["g"], "v", {"x": F.lit(700)}, cell_rows=20, cuts=8).collect()
    values = [sorted((i * 7919) % 4001 for i in range(4000) if i % 3 == g)[700] for g in range(3)]
    assert {r["g"]: r["x"] for r in found} == dict(enumerate(map(float, values)))
    assert read.value == 4000


def test_the_percentile_of_a_table_is_not_searched_again(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    df = spark.range(1000).selectExpr("cast(id AS double) AS v").mapInPandas(counted, "v double")
    median = exact_percentile_of_table(df, "v", {"m": 0.5}, hot_rows=50, cuts=8)
    assert [median.first()["m"] for _ in range(3)] == [499.5] * 3
    assert read.value == 1000


def test_rounds_leave_only_the_rows_in_question(spark):
    from daygrain.functions.order_stats import _narrow

    df = spark.range(6000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 6000).cast("double").alias("v"))
    ranks = {"x": F.lit(10), "y": F.floor((F.col("_n") - 1) * 0.9)}
    cells, rounds, left = _narrow(df, ["k"], "v", ranks, 100, 8, 10**6)
    assert rounds >= 2 and left.count() == cells.select("k", "_id", "_size").distinct().agg(F.sum("_size")).first()[0] <= 400


def test_no_pass_for_ordinary_groups_where_all_are_hot(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    hot = exact_percentiles(df, ["k"], "v", {"m": 0.5}, [F.count("*").alias("n")], hot_rows=100, cuts=8)
    assert "percentile" not in hot._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["k"], r["n"], r["m"]) for r in hot.collect()) == [(0, 1000, 1498.5), (1, 1000, 1499.5), (2, 1000, 1500.5)]
    bare = exact_percentiles(df.withColumn("v", F.when(F.col("k") > 0, F.col("v"))), ["k"], "v", {"m": 0.5}, hot_rows=100, cuts=8)
    assert sorted((r["k"], r["m"]) for r in bare.collect()) == [(0, None), (1, 1499.5), (2, 1500.5)]
