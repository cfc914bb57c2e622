"""Model and scenario runs put together from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.storage import reliable
from daygrain.names import GENERIC, Names
from daygrain.operators import model as M
from daygrain.operators import scenario as S
from daygrain.operators.joins import scalar_broadcast


@dataclass(frozen=True)
class RiskRun:
    model: PipelineModel
    split: str
    threshold: DataFrame  # one row: threshold, f1 on train
    metrics: DataFrame  # one row
    groups: DataFrame
    features: DataFrame
    holdout: DataFrame


def run_risk_model(
    entity_day: DataFrame, target: str = M.TARGET, names: Names = GENERIC, seed: int = 42
) -> RiskRun:
    """Split, train, pick the threshold on train, evaluate on the holdout.

    The scored holdout is stored: every figure below restarts from it instead of
    scoring again.
    """
    train, test, split = M.split_train_test(entity_day, target, seed=seed, names=names)
    model = M.train_risk_model(train, target, names)
    scored_train = M.score_risk(model, train).select(target, M.RISK)
    threshold = reliable(M.choose_threshold(scored_train, target))
    limit = threshold.select("threshold").scalar()
    scored = reliable(M.score_risk(model, test))
    labelled = scored.withColumn(M.LABEL, (F.col(M.RISK) >= limit).cast("int"))
    train_shape = train.agg(
        F.count("*").alias("train_rows"), F.avg(F.col(target).cast("double")).alias("train_positive_rate")
    )
    held_out = M.classification_metrics(scored, limit, target).withColumnsRenamed(
        {"rows": "test_rows", "positive_rate": "test_positive_rate"}
    )
    metrics = held_out.withColumns({"split": F.lit(split), "decision_threshold": limit})
    metrics = scalar_broadcast(metrics, M.auc(scored, (), target))
    metrics = scalar_broadcast(metrics, train_shape)
    return RiskRun(
        model,
        split,
        threshold,
        metrics,
        M.group_metrics(labelled, [c for c in (names.region, names.kind) if c in test.columns], target),
        M.top_features(model, entity_day),
        M.holdout_scores(scored, limit, target, names=names),
    )


@dataclass(frozen=True)
class ScenarioRun:
    summary: DataFrame
    opportunities: DataFrame
    regions: DataFrame


def run_scenarios(entity_day: DataFrame, scorer: S.Scorer, names: Names = GENERIC) -> ScenarioRun:
    """Score every package once, then derive the three result tables from the stored scores."""
    scores = reliable(S.scenario_scores(entity_day, scorer, names=names))
    return ScenarioRun(
        S.scenario_summary(scores),
        S.scenario_opportunities(scores, names=names),
        S.scenario_region_impact(scores, names=names),
    )
