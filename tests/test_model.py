import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from daygrain.operators import model as M
from daygrain.operators import scenario as S
from daygrain.plans.risk import run_risk_model, run_scenarios

COLUMNS = (
    "entity_id long, date string, region string, city string, kind string, mean_speed double, p95_speed double, "
    "total_violations double, low_visibility_hours double, accidents long, has_fatality int"
)


@pytest.fixture(scope="module")
def days(spark):
    rng = np.random.default_rng(11)
    rows = []
    for day in range(1, 21):
        for entity in range(40):
            speed = float(np.round(rng.normal(80, 15), 2))
            low = float(rng.integers(0, 6))
            risk = 1 / (1 + np.exp(-(-6 + 0.05 * speed + 0.4 * low)))
            rows.append(
                (entity, f"2024-01-{day:02d}", "NSEW"[entity % 4], f"c{entity % 7}", "AB"[entity % 2], speed, speed * 1.1,
                 float(rng.integers(0, 9)), low, 3, int(rng.random() < risk))
            )
    return spark.createDataFrame(rows, COLUMNS).withColumn("date", F.col("date").cast("date")).cache()


def test_temporal_split(days):
    train, test = M.temporal_split(days)
    assert train.agg(F.max("date")).first()[0].day == 15
    assert test.agg(F.min("date")).first()[0].day == 16
    assert train.count() + test.count() == days.count()


def test_temporal_split_needs_dates_and_classes(days):
    assert M.temporal_split(days.where("day(date) <= 7")) is None
    assert M.temporal_split(days.withColumn("has_fatality", (F.dayofmonth("date") > 18).cast("int"))) is None


def test_stratified_split_is_exact_and_reproducible(days):
    train, test = M.stratified_split(days)
    counts = {r["has_fatality"]: r["count"] for r in days.groupBy("has_fatality").count().collect()}
    got = {r["has_fatality"]: r["count"] for r in test.groupBy("has_fatality").count().collect()}
    assert got == {c: round(n * 0.25) for c, n in counts.items()}
    assert train.count() + test.count() == days.count()
    again = M.stratified_split(days.repartition(5))[1]
    assert test.select("entity_id", "date").exceptAll(again.select("entity_id", "date")).count() == 0
    other = M.stratified_split(days, seed=7)[1]
    assert test.select("entity_id", "date").exceptAll(other.select("entity_id", "date")).count() > 0


def test_rare_class_split(days):
    rare = days.withColumn("y", F.expr("cast(entity_id = 3 and day(date) = 2 as int)"))
    train, test = M.rare_class_split(rare, "y")
    assert train.where("y = 1").count() == 1
    assert test.count() == 200
    assert M.split_train_test(rare, "y")[2] == M.RARE
    with pytest.raises(ValueError):
        M.rare_class_split(days)
    with pytest.raises(ValueError):
        M.split_train_test(days.withColumn("has_fatality", F.lit(0)))


def test_class_weights(days):
    rows = {r["label"]: r for r in M.class_weights(days).collect()}
    n = days.count()
    assert all(r["weight"] == pytest.approx(n / (2 * r["n"])) for r in rows.values())


def newton(x, y, weights):
    """C = 1 logistic regression with a free intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weights * (p - y)) + penalty @ beta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta[:-1]


def test_coefficients_match_the_objective(days):
    fitted = M.train_risk_model(days)
    got = {r["feature"]: r["coef"] for r in M.model_coefficients(fitted, days).collect()}
    frame = days.toPandas()
    numeric = ["mean_speed", "p95_speed", "total_violations", "low_visibility_hours"]
    scaled = (frame[numeric] - frame[numeric].mean()) / frame[numeric].std(ddof=1)
    names, parts = list(numeric), [scaled.to_numpy()]
    for col in ("region", "city", "kind"):
        for level in sorted(frame[col].unique()):
            names.append(f"{col}_{level}")
            parts.append((frame[col] == level).to_numpy(float)[:, None])
    y = frame.has_fatality.to_numpy(float)
    weights = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    want = dict(zip(names, newton(np.hstack(parts), y, weights)))
    assert set(got) == set(want)
    for name, value in want.items():
        assert got[name] == pytest.approx(value, abs=2e-3)


def test_unseen_category_is_all_zeros(days):
    fitted = M.train_risk_model(days.where("region <> 'N'"))
    scored = M.score_risk(fitted, days.where("region = 'N'"))
    assert scored.where("predicted_risk is null").count() == 0


def test_threshold_and_metrics(spark):
    rng = np.random.default_rng(2)
    y, s = (rng.random(300) < 0.3).astype(int), np.round(rng.random(300), 3)
    df = spark.createDataFrame(list(zip(y.tolist(), s.tolist())), "has_fatality int, predicted_risk double")

    def f1(t):
        hit = s >= t
        tp = (hit & (y == 1)).sum()
        return 2 * tp / max(1, hit.sum() + y.sum())

    best = max(M.THRESHOLDS, key=lambda t: (f1(t), -t))
    row = M.choose_threshold(df).first()
    assert (row["threshold"], row["f1"]) == (pytest.approx(best), pytest.approx(f1(best)))
    metrics = M.classification_metrics(df, best).first()
    hit = s >= best
    assert metrics["f1"] == pytest.approx(f1(best))
    assert metrics["precision"] == pytest.approx(y[hit].mean())
    assert metrics["recall"] == pytest.approx(hit[y == 1].mean())
    none = M.classification_metrics(df, 2.0).first()
    assert (none["f1"], none["precision"], none["recall"]) == (0.0, 0.0, 0.0)


def test_risk_run(days):
    run = run_risk_model(days)
    metrics = run.metrics.first()
    assert run.split == M.TEMPORAL
    assert metrics["auc"] > 0.6 and 0 < metrics["f1"] <= 1
    assert (metrics["train_rows"], metrics["test_rows"]) == (600, 200)
    assert run.groups.count() == 6
    assert run.features.count() == 15
    bands = {r["risk_band"] for r in run.holdout.select("risk_band").distinct().collect()}
    assert bands <= set(M.BAND_LABELS)


def test_scenarios(days):
    fitted = M.train_risk_model(days)
    result = run_scenarios(days, S.model_scorer(fitted))
    summary = {r["scenario"]: r for r in result.summary.collect()}
    assert set(summary) == set(S.PACKAGES) - {S.BASELINE}
    assert summary["Speed Management"]["avg_risk_reduction"] > 0
    top = result.opportunities.groupBy("scenario").count().collect()
    assert {r["count"] for r in top} == {20}
    assert result.regions.count() == 16


def test_pressure_falls_under_every_package(days):
    bounds = S.quantile_bounds(days, list(S.PRESSURE_WEIGHTS))
    base = S.pressure_score(days, bounds).select("entity_id", "date", F.col("pressure").alias("before"))
    after = S.pressure_score(S.apply_scenarios(days), bounds).join(base, ["entity_id", "date"])
    assert after.where("pressure > before + 1e-12").count() == 0
    assert after.where("scenario = 'Baseline' and abs(pressure - before) > 1e-12").count() == 0
    assert S.pressure_score(days.select("entity_id"), bounds).first()["pressure"] == 0.0


def test_split_with_repeated_keys_and_rows(spark):
    rows = [(1, "2024-01-01", i % 20, i % 2) for i in range(80)] + [(1, "2024-01-01", 0, 0)] * 20
    df = spark.createDataFrame(rows, "entity_id int, date string, x int, has_fatality int")
    train, test = M.stratified_split(df)
    assert test.groupBy().sum("has_fatality").first()[0] == 10 and test.count() == 25
    assert sorted(map(tuple, train.unionByName(test).collect())) == sorted(rows)


def test_rows_without_target_are_in_no_class(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,), (None,)], "has_fatality int")
    assert sorted((r.label, r.n, r.weight) for r in M.class_weights(df).collect()) == [(0, 3, 4 / 6), (1, 1, 2.0)]


def test_gradient_is_zero_at_the_optimum_only(days):
    train, _, _ = M.split_train_test(days)
    holes = train.withColumn("has_fatality", F.when(F.col("entity_id") % 11 != 0, F.col("has_fatality")))
    fitted = M.train_risk_model(holes)
    table = M.model_coefficients(fitted, days, intercept=True)
    gradient = {r["feature"]: r["gradient"] for r in M.loss_gradient(table, holes).collect()}
    assert set(gradient) == {r["feature"] for r in table.collect()} and M.INTERCEPT in gradient
    assert max(map(abs, gradient.values())) < 1e-7
    moved = table.withColumn("coef", F.when(F.col("feature") == "mean_speed", F.col("coef") + 0.05).otherwise(F.col("coef")))
    assert max(abs(r["gradient"]) for r in M.loss_gradient(moved, holes).collect()) > 1e-4
    # by hand: the same loss over the same encoding, changed a little in one coefficient
    frame = holes.where("has_fatality is not null").toPandas()
    coefs = {r["feature"]: r["coef"] for r in moved.collect()}
    weight = frame.has_fatality.map(len(frame) / (2 * frame.has_fatality.value_counts()))

    def loss(step):
        z = coefs[M.INTERCEPT]
        for c in ("mean_speed", "p95_speed", "total_violations", "low_visibility_hours"):
            z = z + (coefs[c] + (step if c == "mean_speed" else 0)) * (frame[c] - frame[c].mean()) / frame[c].std(ddof=0)
        for c in ("region", "city", "kind"):
            z = z + frame[c].map(lambda v, c=c: coefs[f"{c}_{v}"])
        y = frame.has_fatality
        own = sum((coefs[k] + (step if k == "mean_speed" else 0)) ** 2 for k in coefs if k != M.INTERCEPT)
        return (weight * (np.log1p(np.exp(z)) - y * z)).mean() + own / 2 / len(frame)

    slope = (loss(1e-4) - loss(-1e-4)) / 2e-4
    assert {r["feature"]: r["gradient"] for r in M.loss_gradient(moved, holes).collect()}["mean_speed"] == pytest.approx(slope, rel=1e-4)


def test_plain_encoding_scores_like_the_model(days):
    train, test, _ = M.split_train_test(days)
    unseen = test.withColumn("city", F.when(F.col("entity_id") == 3, "elsewhere").otherwise(F.col("city")))
    fitted = M.train_risk_model(train)
    table = M.model_coefficients(fitted, days, intercept=True)
    scored = M.score_risk(fitted, unseen).withColumn("x", M.encoded_values(unseen, M.feature_scales(train)))
    rows = M.with_logistic_risk(scored, table, "x", "plain").collect()
    assert len(rows) == test.count() and all(r["plain"] == pytest.approx(r[M.RISK], abs=1e-12) for r in rows)


def test_equal_rows_are_split_exactly(spark):
    equal = spark.range(0, 200_000, numPartitions=8).select(
        F.lit(1).alias("entity_id"), F.lit("2024-01-01").alias("date"), (F.col("id") % 4 == 0).cast("int").alias("has_fatality")
    )
    train, test = M.stratified_split(equal)
    counts = lambda df: {r["has_fatality"]: r["count"] for r in df.groupBy("has_fatality").count().collect()}
    assert counts(test) == {0: 37_500, 1: 12_500} and counts(train) == {0: 112_500, 1: 37_500}
    assert train.columns == equal.columns
    # rows are counted off where they are: no exchange by class or hash
    taken, rest = M._take(equal.where("has_fatality = 1"), 7)
    assert (taken.count(), rest.count()) == (7, 49_993)
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(has_fatality" not in plan and "hashpartitioning(_h" not in plan



def test_scores_as_one_expression(spark, days):
    fitted = M.train_risk_model(days.where("region <> 'N'"))
    risk = M.risk_column(fitted)
    assert risk is not None
    plan = M.score_risk(fitted, days)._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan  # no vector passes from function to function
    both = fitted.transform(M.score_risk(fitted, days)).withColumn("own", vector_to_array("probability")[1])
    assert both.agg(F.max(F.abs(F.col("own") - F.col(M.RISK)))).first()[0] < 1e-12
    unseen = days.where("region = 'N'")
    assert unseen.count() and M.score_risk(fitted, unseen).where(f"{M.RISK} is null").count() == 0
    for gap in ("null", "'NaN'"):
        with pytest.raises(Exception):  # noqa: B017
            M.score_risk(fitted, days.withColumn("mean_speed", F.expr(f"cast({gap} as double)"))).agg(F.sum(M.RISK)).collect()


def test_scores_of_other_models(spark, days):
    wide = days.withColumn("region", F.concat_ws(" ", "region", "entity_id", "date"))
    assert wide.select("region").distinct().count() > M.MAX_LISTED
    fitted = M.train_risk_model(wide, max_iter=2)
    assert M.risk_column(fitted) is None
    own = vector_to_array("probability")[1]
    both = fitted.transform(M.score_risk(fitted, wide)).withColumn("off", F.abs(own - F.col(M.RISK)))
    assert both.agg(F.max("off")).first()[0] < 1e-12
