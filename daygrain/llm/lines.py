"""Removal of lines that many sites share, with Spark's own functions only.

Sites per line hash are counted by HyperLogLog sketches that merge by aggregation. A line whose estimate is within
``SIGMAS`` standard errors of the limit gets an exact distinct count; the others are decided by the sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import Stored, small

LOG_BUCKETS = 10
SIGMAS = 5
MIN_SITES = 10
BLANKS = " \t\r"


def _trimmed(line):
    return F.btrim(line, F.lit(BLANKS))


def shared_lines(
    docs: DataFrame, stored: Stored, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """(h1, h2): hashes of the trimmed lines, not empty, that stand on ``min_sites`` sites or more. Null sites do not count."""
    lines = docs.where(F.col(site_col).isNotNull()).select(
        F.col(site_col).alias("site"), F.explode(F.array_distinct(F.transform(F.split(text_col, "\n"), _trimmed))).alias("line")
    )
    hashed = lines.where("line <> ''").select("site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"))
    error = SIGMAS * 1.04 / 2 ** (LOG_BUCKETS / 2)
    spread = stored.put(
        hashed.groupBy("h1", "h2")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_BUCKETS))).alias("sites"))
        .where(F.col("sites") * (1 + error) >= min_sites)
    )
    near = spread.where(F.col("sites") <= min_sites * (1 + error)).select("h1", "h2")
    exact = (
        hashed.join(small(near), ["h1", "h2"], "left_semi")
        .distinct()
        .groupBy("h1", "h2")
        .count()
        .where(F.col("count") >= min_sites)
    )
    far = spread.where(F.col("sites") > min_sites * (1 + error))
    return stored.put(far.select("h1", "h2").unionByName(exact.select("h1", "h2")))


def remove_shared_lines(
    docs: DataFrame,
    stored: Stored,
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    spare_whole: bool = False,
) -> DataFrame:
    """(row: all columns of ``docs`` with the text reduced, lines_removed) for every document.

    A line goes, in all documents, if equal lines (trimmed of spaces, tabs and returns) stand on ``min_sites`` sites or
    more. With ``spare_whole`` a text without any other line but blank ones stays as it is, which is how copies of a document
    look that stand on many sites: all lines of them are shared. Null and empty texts stay. Rows that repeat an id or a text
    are reduced alike.

    Texts are found again by two hashes of theirs, so hot lines are joined as (line, text) hashes of few bytes and
    Spark can split them; only the last join, by text, moves texts.
    """
    shared = shared_lines(docs, stored, text_col, site_col, min_sites)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text")).withColumns(
        {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(2), "text")}
    )
    lines = F.transform(F.split("text", "\n"), _trimmed)
    found = (
        rows.select("k1", "k2", F.explode(F.array_distinct(lines)).alias("line"))
        .where("line <> ''")
        .select("k1", "k2", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"))
        .join(small(shared), ["h1", "h2"])
    )
    by_text = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("h1", "h2")).alias("hits"))
    hits = stored.put(by_text)
    goes = lambda x: F.array_contains(
        F.col("hits"), F.struct(F.xxhash64(_trimmed(x)).alias("h1"), F.xxhash64(F.lit(2), _trimmed(x)).alias("h2"))
    )
    joined = rows.join(hits, ["k1", "k2"], "left")
    kept = F.filter(F.split("text", "\n"), lambda x: ~goes(x))
    text = F.when(F.col("hits").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    spared = ~F.exists(kept, lambda x: _trimmed(x) != "") if spare_whole else F.lit(False)
    before = F.size(F.split("text", "\n"))
    cut = joined.select("row", "text", text.alias("new"), (before - F.size(kept)).alias("gone"), (F.col("hits").isNotNull() & ~spared).alias("use"))
    fields = [
        F.when(F.col("use"), F.col("new")).otherwise(F.col("text")).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return cut.select(F.struct(*fields).alias("row"), F.when(F.col("use"), F.col("gone")).otherwise(0).alias("lines_removed"))
