"""Row-level lineage: source, batch, extraction time, content hash, and their summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.scalars import python_text
from daygrain.names import LINEAGE
from daygrain.operators.ranking import union_all

# Batch id format, hash length, and the suffixes joins may leave on lineage columns.
BATCH_FORMAT = "B%Y%m%dT%H%M%SZ"
HASH_LENGTH = 16
SUFFIXES = ("_x", "_accident", "_source")


def batch_id(at: datetime) -> str:
    return at.strftime(BATCH_FORMAT)


def add_lineage(df: DataFrame, source: str, batch: str, extracted_at: str) -> DataFrame:
    """Append source system, batch id and extraction time as constants."""
    return df.withColumns(
        {
            "source_system": F.lit(source),
            "ingest_batch_id": F.lit(batch),
            "extracted_at_utc": F.lit(extracted_at),
        }
    )


def record_hash(
    df: DataFrame, cols: Sequence[str] | None = None, include_lineage: bool = True
) -> DataFrame:
    """Append ``record_hash``: 16 hex digits of SHA-256 over sorted ``name=value`` pairs.

    ``include_lineage=False`` leaves the batch columns out, which makes the hash
    comparable between batches.
    """
    lineage = {"source_system", "ingest_batch_id", "extracted_at_utc"}
    chosen = list(cols) if cols is not None else [c for c in df.columns if c != "record_hash"]
    if not include_lineage:
        chosen = [c for c in chosen if c not in lineage]
    types = dict(df.dtypes)
    pairs = [F.concat(F.lit(f"{c}="), python_text(c, types[c])) for c in sorted(chosen)]
    digest = F.sha2(F.concat_ws("|", *pairs), 256)
    return df.withColumn("record_hash", F.substring(digest, 1, HASH_LENGTH))


def normalize_lineage(df: DataFrame) -> DataFrame:
    """Rename a suffixed lineage column to its plain name where the plain one is absent."""
    renames = {}
    for name in LINEAGE:
        if name in df.columns:
            continue
        suffixed = next((name + s for s in SUFFIXES if name + s in df.columns), None)
        if suffixed:
            renames[suffixed] = name
    return df.withColumnsRenamed(renames) if renames else df


def _joined_values(df: DataFrame, name: str):
    if name not in df.columns:
        return F.lit("")
    return F.array_join(F.array_sort(F.collect_set(F.col(name).cast("string"))), ", ")


def lineage_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, columns, source systems, batch ids and share of rows with a hash.

    Rows are first counted per (source, batch), so the sets are built from one row per pair.
    """
    parts = []
    for name, df in tables.items():
        present = [c for c in ("source_system", "ingest_batch_id") if c in df.columns]
        hashed = F.count("record_hash") if "record_hash" in df.columns else F.lit(0)
        pairs = df.groupBy(*present).agg(F.count("*").alias("_n"), hashed.cast("long").alias("_h"))
        rows = F.coalesce(F.sum("_n"), F.lit(0))
        coverage = F.try_divide(F.sum("_h").cast("double"), F.sum("_n").cast("double"))
        if "record_hash" not in df.columns:
            coverage = F.lit(0.0)
        parts.append(
            pairs.agg(
                F.lit(name).alias("dataset"),
                rows.alias("rows"),
                F.lit(len(df.columns)).alias("columns"),
                _joined_values(pairs, "source_system").alias("source_systems"),
                _joined_values(pairs, "ingest_batch_id").alias("batch_ids"),
                coverage.alias("record_hash_coverage"),
            )
        )
    return union_all(parts)


def manifest_counts(
    tables: Mapping[str, DataFrame], gate: DataFrame | None = None, metrics: DataFrame | None = None
) -> DataFrame:
    """(section, name, value) rows: table sizes, rule counts by status, model figures."""
    parts = [
        df.agg(
            F.lit("dataset_rows").alias("section"),
            F.lit(name).alias("name"),
            F.count("*").cast("string").alias("value"),
        )
        for name, df in tables.items()
    ]
    for section, table in (("quality", gate), ("model", metrics)):
        if table is not None:
            text = table.select(*[F.col(c).cast("string").alias(c) for c in table.columns])
            parts.append(
                text.unpivot([], table.columns, "name", "value").select(
                    F.lit(section).alias("section"), "name", "value"
                )
            )
    return union_all(parts)


def content_digest(df: DataFrame, name: str) -> DataFrame:
    """One row ``name, rows, digest`` for the content of a table whatever the order of rows and columns.

    The digest is the sum of 48 bits of MD5 per row, over ``name=value`` pairs in the order of the names; doubles count in
    millionths, nulls as ``~``. Two tables with equal rows and digest hold the same rows.
    """
    def shown(c: str, kind: str) -> Column:
        value = F.col(f"`{c}`")
        if kind in ("double", "float"):
            value = F.round(F.round(value, 6) * 1e6).cast("bigint")
        return F.concat(F.lit(f"{c}="), F.coalesce(value.cast("string"), F.lit("~")))

    row = F.md5(F.concat_ws("|", *[shown(c, kind) for c, kind in sorted(df.dtypes)]))
    number = F.conv(F.substring(row, 1, 12), 16, 10).cast("bigint")
    # summed as two halves of 24 bits, which fit whole numbers for 2^39 rows; a decimal a row takes longer than the MD5
    upper, lower = F.sum(F.shiftright("_number", 24)), F.sum(F.col("_number").bitwiseAND(F.lit((1 << 24) - 1)))
    both = upper.cast("decimal(20,0)") * F.lit(1 << 24).cast("decimal(8,0)") + lower.cast("decimal(20,0)")
    digest = F.coalesce(both, F.lit(0)).cast("string")
    numbers = df.select(number.alias("_number"))
    return numbers.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), digest.alias("digest"))
