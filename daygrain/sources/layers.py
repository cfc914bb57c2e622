"""Writing layers, result tables and models, and the raw → staged → curated run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.names import ROADS, Names
from daygrain.operators.aggregates import build_entity_day, enrich_incident
from daygrain.operators.clean import clean_sources
from daygrain.operators.model import TARGET, feature_fingerprint, train_risk_model
from daygrain.sources.readers import load_sources


def write_layer(
    tables: Mapping[str, DataFrame],
    path: str,
    fmt: str = "parquet",
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Overwrite one folder per table. Partitioned tables are rebalanced on their partition
    columns first, so each day gets few files and a large day is split over several."""
    for name, df in tables.items():
        columns = list((partition_by or {}).get(name, ()))
        if columns:
            df = df.hint("rebalance", *columns)
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        if columns:
            writer = writer.partitionBy(*columns)
        writer.save(f"{path}/{name}")


def read_layer(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def curate(
    spark: SparkSession, staged: Mapping[str, DataFrame], out_dir: str, names: Names = ROADS
) -> dict[str, DataFrame]:
    """Clean and integrate staged sources, write the curated layer, return it as read back.

    Reading each table back cuts the lineage: later steps restart from files.
    """
    clean = clean_sources(staged, names)
    facts = {"incident": [names.day], "typed": [names.day], "measure": [names.day]}
    first = {k: clean[k] for k in ("registry", "typed", "measure", "context")}
    write_layer(first, out_dir, partition_by=facts)
    tables = read_layer(spark, out_dir, list(first))
    write_layer(
        {"incident": enrich_incident({**tables, "incident": clean["incident"]}, names)},
        out_dir,
        partition_by=facts,
    )
    tables.update(read_layer(spark, out_dir, ["incident"]))
    write_layer({"entity_day": build_entity_day(tables, names)}, out_dir)
    tables.update(read_layer(spark, out_dir, ["entity_day"]))
    return tables


def run_layers(
    spark: SparkSession, raw_dir: str, out_dir: str, batch: str, extracted_at: str, names: Names = ROADS, **options
) -> dict[str, DataFrame]:
    """raw CSV → staged (with lineage) → curated, both as parquet under ``out_dir``; ``options`` as for ``load_sources``."""
    sources = load_sources(spark, raw_dir, batch, extracted_at, **options)
    write_layer(sources, f"{out_dir}/staged")
    staged = read_layer(spark, f"{out_dir}/staged", list(sources))
    return curate(spark, staged, f"{out_dir}/curated", names)


def write_results(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Result tables, one folder each, as many files as Spark produces."""
    write_layer(tables, path, fmt)


def export_star(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Star tables; facts partitioned by day for date pruning."""
    days = {name: ["date"] for name, df in tables.items() if name.startswith("fact_") and "date" in df.columns}
    write_layer(tables, path, fmt, days)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_or_fit(
    train: DataFrame, path: str, target: str = TARGET, names: Names = ROADS, **options: int
) -> tuple[PipelineModel, bool]:
    """The model stored under ``path``, and False; or one fitted on ``train`` and stored there, and True.

    It is fitted if there is none, if it does not load, or if the fingerprint stored beside it tells that it was fitted
    on other columns. ``options`` go to ``train_risk_model``.
    """
    wanted = feature_fingerprint(train, target, names)
    stored = _stored_model(train.sparkSession, path, wanted)
    if stored is not None:
        return stored, False
    model = train_risk_model(train, target, names, **options)
    save_model(model, f"{path}/model")
    train.sparkSession.range(1).select(F.lit(wanted).alias("columns")).write.mode("overwrite").parquet(f"{path}/fitted_on")
    return model, True


def _stored_model(spark: SparkSession, path: str, wanted: str) -> PipelineModel | None:
    try:
        row = spark.read.parquet(f"{path}/fitted_on").first()
        return load_model(f"{path}/model") if row and row["columns"] == wanted else None
    except (PySparkException, Py4JJavaError, KeyError, ValueError):  # absent or damaged
        return None
