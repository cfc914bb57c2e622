"""Top-k, top-k per group and set operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.names import GENERIC, Names


def _descending(order: Sequence[str], tie: Sequence[str]) -> list:
    return [F.desc_nulls_last(c) for c in order] + [F.asc_nulls_last(c) for c in tie]


def top_k(df: DataFrame, order: Sequence[str], k: int, tie: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by descending columns; nulls last; ties broken by ``tie`` ascending."""
    return df.orderBy(*_descending(order, tie)).limit(k)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], k: int, tie: Sequence[str] = ()
) -> DataFrame:
    """First ``k`` rows of each group. Each task keeps ``k`` per group before the shuffle."""
    window = W.partitionBy(*group).orderBy(*_descending(order, tie))
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= k).drop("_place")


def priority_entity_days(df: DataFrame, k: int = 10, names: Names = GENERIC) -> DataFrame:
    """Entity-days to look at first."""
    ranked = top_k(df, ["has_fatality", "severe_rate", "fatalities", "accidents"], k, names.grain)
    return ranked.select(
        *names.grain,
        names.region,
        names.city,
        names.kind,
        "accidents",
        "fatalities",
        "severe_rate",
        "has_fatality",
    )


def best_scenario(summary: DataFrame) -> DataFrame:
    """The scenario with the largest mean risk reduction."""
    return top_k(summary, ["avg_risk_reduction", "high_risk_road_days_reduced"], 1, ["scenario"])


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables, columns matched by name."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out


def distinct_days(dfs: Mapping[str, DataFrame] | Sequence[DataFrame], ts: str = "ts") -> DataFrame:
    """Distinct calendar days over the tables; each table is reduced before the union."""
    tables = list(dfs.values()) if isinstance(dfs, Mapping) else list(dfs)
    days = [df.select(F.to_date(ts).alias("date")).dropna().distinct() for df in tables]
    return union_all(days).distinct()
