"""What-if scenarios: rescore the entity-day table under changed features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.order_stats import exact_percentile_of_table, exact_percentiles
from daygrain.functions.scalars import normalize_bounds, safe_ratio
from daygrain.names import GENERIC, Names
from daygrain.operators.aggregates import quantile_bounds
from daygrain.operators.model import score_risk
from daygrain.operators.ranking import top_k_per_group

Scorer = Callable[[DataFrame], DataFrame]  # adds the column "model_risk"

BASELINE = "Baseline"
# Feature factors per package, feature weights of the pressure score,
# share of the model in the blended risk, threshold floor and quantile, list length.
SPEED = {"mean_speed": 0.92, "p95_speed": 0.88}
ENFORCEMENT = {
    "total_violations": 0.78,
    "violations_per_1000_volume": 0.78,
    "Speeding": 0.78,
    "UnsafeLaneChange": 0.78,
    "RedLight": 0.78,
}
VISIBILITY = {"low_visibility_hours": 0.65, "fog_hours": 0.60, "rain_hours": 0.80}
PACKAGES: dict[str, dict[str, float]] = {
    BASELINE: {},
    "Speed Management": SPEED,
    "Targeted Enforcement": ENFORCEMENT,
    "Visibility Response": VISIBILITY,
    "Combined Safe System": {**SPEED, **ENFORCEMENT, **VISIBILITY},
}
PRESSURE_WEIGHTS = {
    "p95_speed": 0.25,
    "mean_speed": 0.15,
    "total_violations": 0.10,
    "violations_per_1000_volume": 0.20,
    "low_visibility_hours": 0.12,
    "fog_hours": 0.08,
    "rain_hours": 0.05,
    "daily_volume": 0.05,
}
MODEL_SHARE = 0.65
RISK_FLOOR = 0.50
RISK_QUANTILE = 0.85
TOP_PER_SCENARIO = 20


def apply_scenarios(
    df: DataFrame, packages: Mapping[str, Mapping[str, float]] = PACKAGES
) -> DataFrame:
    """One row per input row and scenario, with the scenario's factors applied.

    The handful of packages is an array on each row, so nothing is joined or shuffled.
    Columns a table lacks are skipped.
    """
    touched = [c for c in dict.fromkeys(c for p in packages.values() for c in p) if c in df.columns]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("scenario"),
                *[(F.col(c).cast("double") * F.lit(float(factors.get(c, 1.0)))).alias(c) for c in touched],
            )
            for name, factors in packages.items()
        ]
    )
    kept = [c for c in df.columns if c not in touched]
    return df.select(*kept, F.inline(rows)).select(*df.columns, "scenario")


def pressure_score(
    df: DataFrame,
    bounds: DataFrame,
    weights: Mapping[str, float] = PRESSURE_WEIGHTS,
    col: str = "pressure",
) -> DataFrame:
    """Weighted mean of the features scaled between their bounds, over the features present.

    ``bounds`` has one row per weighted feature; its numbers go into the plan as
    constants, so scoring is a single pass without a join or shuffle.
    """
    return df.withColumn(col, pressure_column(df.columns, bound_values(bounds, weights), weights))


def bound_values(
    bounds: DataFrame, weights: Mapping[str, float] = PRESSURE_WEIGHTS
) -> dict[str, tuple[float, float]]:
    """The bounds of the weighted features as numbers (one small row each)."""
    rows = bounds.where(F.col("feature").isin(list(weights))).collect()
    return {r["feature"]: (r["lower"], r["upper"]) for r in rows if r["lower"] is not None}


def pressure_column(
    columns: Sequence[str],
    values: Mapping[str, tuple[float, float]],
    weights: Mapping[str, float] = PRESSURE_WEIGHTS,
) -> Column:
    available = {c: w for c, w in weights.items() if c in columns}
    score = F.lit(0.0)
    for feature, weight in available.items():
        lo, hi = values.get(feature, (0.0, 0.0))
        score = score + normalize_bounds(feature, F.lit(lo), F.lit(hi)) * F.lit(weight)
    return score / F.lit(sum(available.values())) if available else score


def blended_risk(model_risk: str = "model_risk", pressure: str = "pressure") -> Column:
    return F.lit(MODEL_SHARE) * F.col(model_risk) + F.lit(1.0 - MODEL_SHARE) * F.col(pressure)


def high_risk_threshold(
    scored: DataFrame,
    col: str = "baseline_risk",
    floor: float = RISK_FLOOR,
    q: float = RISK_QUANTILE,
    **limits: int,
) -> DataFrame:
    """One row ``threshold``: the quantile of the risk, not below the floor."""
    found = exact_percentile_of_table(scored, col, {"_q": q}, **limits)
    return found.select(F.greatest(F.lit(floor), F.coalesce(F.col("_q"), F.lit(floor))).alias("threshold"))


def model_scorer(model: PipelineModel) -> Scorer:
    return lambda df: score_risk(model, df, "model_risk")


def blended(
    df: DataFrame, scorer: Scorer, values: Mapping[str, tuple[float, float]], col: str
) -> DataFrame:
    """Append the blended risk of the rows as they are."""
    scored = scorer(df).withColumn("pressure", pressure_column(df.columns, values))
    return scored.withColumn(col, blended_risk()).select(*df.columns, col)


def scenario_scores(
    entity_day: DataFrame,
    scorer: Scorer,
    packages: Mapping[str, Mapping[str, float]] = PACKAGES,
    floor: float = RISK_FLOOR,
    names: Names = GENERIC,
    **limits: int,
) -> DataFrame:
    """Per row and scenario: baseline and scenario risk, their difference, and threshold flags.

    The bounds and the threshold (17 numbers) come first; then all scenarios are scored
    in one pass over the table, without a shuffle.
    """
    values = bound_values(quantile_bounds(entity_day, list(PRESSURE_WEIGHTS), **limits))
    base = blended(entity_day, scorer, values, "baseline_risk")
    threshold = F.lit(high_risk_threshold(base, "baseline_risk", floor, **limits).first()["threshold"])
    flagged = base.withColumn("baseline_high_risk", (F.col("baseline_risk") >= threshold).cast("int"))
    scored = blended(apply_scenarios(flagged, packages), scorer, values, "scenario_risk")
    below = (F.col("scenario_risk") < threshold).cast("int")
    return scored.select(
        *names.grain,
        names.region,
        names.city,
        names.kind,
        "scenario",
        "baseline_risk",
        "scenario_risk",
        (F.col("baseline_risk") - F.col("scenario_risk")).alias("risk_delta"),
        "baseline_high_risk",
        (F.col("baseline_high_risk") * below).alias("moved_below_threshold"),
    )


def _changed(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("scenario") != BASELINE)


def scenario_summary(scores: DataFrame, **limits: int) -> DataFrame:
    """Per scenario: risk reduction figures and how many high-risk days fall below the threshold."""
    summary = exact_percentiles(
        _changed(scores),
        ["scenario"],
        "risk_delta",
        {"median_risk_reduction": 0.5},
        [
            F.avg("risk_delta").alias("avg_risk_reduction"),
            F.max("risk_delta").alias("max_risk_reduction"),
            F.avg("baseline_risk").alias("avg_baseline_risk"),
            F.avg("scenario_risk").alias("avg_scenario_risk"),
            F.sum("baseline_high_risk").alias("baseline_high_risk_road_days"),
            F.sum("moved_below_threshold").alias("high_risk_road_days_reduced"),
        ],
        **limits,
    )
    return summary.select(
        "scenario",
        "avg_risk_reduction",
        "median_risk_reduction",
        "max_risk_reduction",
        "avg_baseline_risk",
        "avg_scenario_risk",
        "baseline_high_risk_road_days",
        "high_risk_road_days_reduced",
        safe_ratio("high_risk_road_days_reduced", "baseline_high_risk_road_days").alias(
            "high_risk_reduction_rate"
        ),
    ).orderBy(F.desc("avg_risk_reduction"), F.desc("high_risk_road_days_reduced"), "scenario")


def scenario_opportunities(
    scores: DataFrame, k: int = TOP_PER_SCENARIO, names: Names = GENERIC
) -> DataFrame:
    """The ``k`` entity-days per scenario with the largest reduction."""
    return top_k_per_group(
        _changed(scores), ["scenario"], ["risk_delta", "baseline_risk"], k, names.grain
    ).drop("baseline_high_risk")


def scenario_region_impact(scores: DataFrame, names: Names = GENERIC, **limits: int) -> DataFrame:
    """Risk reduction per scenario and region."""
    impact = exact_percentiles(
        _changed(scores).where(F.col(names.region).isNotNull()),
        ["scenario", names.region],
        "risk_delta",
        {"median_risk_reduction": 0.5},
        [
            F.avg("risk_delta").alias("avg_risk_reduction"),
            F.sum("moved_below_threshold").alias("high_risk_road_days_reduced"),
            F.avg("baseline_risk").alias("baseline_mean_risk"),
            F.avg("scenario_risk").alias("scenario_mean_risk"),
        ],
        **limits,
    )
    return impact.orderBy(
        "scenario", F.desc("avg_risk_reduction"), F.desc("high_risk_road_days_reduced"), names.region
    )
