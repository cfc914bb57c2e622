"""Exact order statistics that stay balanced when one group holds most of the rows.

``percentile`` keeps every distinct value of a group in one buffer. That is fine
for ordinary groups, so those use it. A group above a row limit is instead narrowed down in rounds: a sketch of
the group's own values gives borders, slice totals (combined before the shuffle) locate the slice
that holds the wanted rank, and a slice that is still above the limit is cut again by its own borders. Each border is a
slice of its own, so a value that repeats without end is found as such. A round leaves only the rows of slices that are still
open, and at last those are shuffled and ordered. The result is exact whatever the borders are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.functions.storage import reliable

HOT_ROWS = 250_000  # groups, and slices, up to this many values are ordered in one task
MAX_HOT = 200_000  # up to this many hot groups are joined by broadcast, more of them by key
SLICES = 1024  # of a whole table
CUTS = 64  # borders of one slice and round
ROUNDS = 24
SKETCH_SIZE = 1024
MERGE_PARTS = 256


def find_hot(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Groups above the row limit as (keys, ``_size``), or None: the size check.

    One counting job that reads only the key columns. The few rows are stored so that plans using them stay short.
    """
    return _hot_groups(rows, keys, hot_rows)[0]


def _hot_groups(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame | None, int, int]:
    """``find_hot``, the number of its rows and that of all groups."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_size"))
    shape = sizes.agg(F.count_if(F.col("_size") > hot_rows).alias("hot"), F.count("*").alias("all")).first()
    hot = reliable(sizes.where(F.col("_size") > hot_rows)) if shape["hot"] else None
    return hot, shape["hot"], shape["all"]


def slice_borders(df: DataFrame, value: str, slices: int = SLICES) -> list[float]:
    """Borders of about equally filled value slices: at most ``slices - 1`` numbers.

    Quantile sketches are merged in two steps, so no task receives one from every scan
    task. The borders are fixed here, once, because a sketch may differ between runs
    and every use of the slices must see the same ones.
    """
    cuts = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("_part")
    row = (
        df.where(F.col(value).isNotNull())
        .select(F.col(value).cast("double").alias("_b"), part)
        .groupBy("_part")
        .agg(F.kll_sketch_agg_double("_b", F.lit(SKETCH_SIZE)).alias("_sketch"))
        .agg(F.kll_merge_agg_double("_sketch", F.lit(SKETCH_SIZE)).alias("_sketch"), F.count("*").alias("_parts"))
        .select(F.when(F.col("_parts") > 0, F.kll_sketch_get_quantile_double("_sketch", cuts)).alias("_borders"))
        .first()
    )
    return sorted(set(row["_borders"] or ()))


def with_slice(df: DataFrame, value: str, borders: Sequence[float]) -> DataFrame:
    """Add ``_slice``: the number of borders below the value, by binary search in steps."""
    out = df.withColumn("_slice", F.lit(0))
    if not borders:
        return out
    listed = F.array(*[F.lit(float(b)) for b in borders])
    out = out.withColumn("_borders", listed)
    step = 1 << (len(borders).bit_length() - 1)
    while step:
        ahead = F.col("_slice") + F.lit(step)
        below = F.try_element_at(F.col("_borders"), ahead) < F.col(value)
        out = out.withColumn("_slice", F.when(below, ahead).otherwise(F.col("_slice")))
        step //= 2
    return out.drop("_borders")


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, few: bool) -> DataFrame:
    """Join that also matches null keys, by broadcast if ``right`` was found to have ``few`` rows."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    same = [left[key].eqNullSafe(renamed[f"_r_{key}"]) for key in keys]
    return left.join(F.broadcast(renamed) if few else renamed, reduce(and_, same), how)


def _inside(present: DataFrame, cells: DataFrame, keys: Sequence[str], value: str, few: bool) -> DataFrame:
    """The rows in each cell, with the cell's columns but for its keys. A row may lie in a cell per rank."""
    d = F.col(value).cast("double")
    right = cells.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in cells.columns if c not in keys])
    condition = [present[k].eqNullSafe(right[f"_r_{k}"]) for k in keys]
    above, below = F.col("_low").isNull() | (d > F.col("_low")), F.col("_high").isNull() | (d < F.col("_high"))
    condition.append(F.when(F.col("_point"), d == F.col("_low")).otherwise(above & below))
    return present.join(F.broadcast(right) if few else right, reduce(and_, condition)).drop(*[f"_r_{k}" for k in keys])


def locate(
    present: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column], cell_rows: int, cuts: int, max_hot: int
) -> tuple[DataFrame, int]:
    """Per group and rank the cell that holds it, and the number of rounds: (keys, _n, _name, _rank, _id, _low, _high, _point,
    _start, _size, _value).

    A cell is an open interval of values, or one value (``_point``), with the number of values before it (``_start``). ``_value``
    is set where all values of the cell are equal; other cells have ``cell_rows`` rows at most.
    """
    return _narrow(present, keys, value, ranks, cell_rows, cuts, max_hot)[:2]


def _open(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cells, each once, whose rows have to be ordered or cut."""
    return cells.where(F.col("_value").isNull()).select(*keys, "_id", "_low", "_high", "_point", "_start").distinct()


def _narrow(
    present: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column], cell_rows: int, cuts: int, max_hot: int
) -> tuple[DataFrame, int, DataFrame]:
    """``locate``, and those of the rows that lie in cells without ``_value``."""
    wanted = F.inline(F.array(*[F.struct(F.lit(name).alias("_name"), rank.cast("long").alias("_rank")) for name, rank in ranks.items()]))
    groups = present.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(value).alias("_least"), F.max(value).alias("_most"))
    numbered = groups.withColumn("_id", F.monotonically_increasing_id().cast("string"))
    nothing = F.lit(None).cast("double")
    cells = reliable(
        numbered.select("*", wanted)
        .where("_rank >= 0 and _rank < _n")
        .select(
            *keys, "_n", "_name", "_rank", "_id", nothing.alias("_low"), nothing.alias("_high"), F.lit(False).alias("_point"),
            F.lit(0).cast("long").alias("_start"), F.col("_n").alias("_size"), F.when(F.col("_least") == F.col("_most"), F.col("_most")).alias("_value"),
        )
    )
    too_large = (F.col("_size") > cell_rows) & F.col("_value").isNull() & ~F.col("_point")
    for done in range(ROUNDS):
        cell = [*keys, "_id", "_low", "_high", "_point", "_start"]
        cut = cells.where(too_large).select(*cell).distinct()
        count = cut.count()
        if not count:
            return cells, done, present
        few = count <= max_hot
        marks = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
        part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("_part")
        # quantile sketches are merged in two steps, so no task receives one from every scan task
        borders = (
            _inside(present, cut, keys, value, few)
            .select("_id", F.col(value).cast("double").alias("_b"), part)
            .groupBy("_id", "_part")
            .agg(F.kll_sketch_agg_double("_b", F.lit(SKETCH_SIZE)).alias("_s"))
            .groupBy("_id")
            .agg(F.kll_merge_agg_double("_s", F.lit(SKETCH_SIZE)).alias("_s"))
            .select("_id", F.array_distinct(F.array_sort(F.kll_sketch_get_quantile_double("_s", marks))).alias("_borders"))
        )
        # stored, because a sketch may differ between runs and every use must see the same borders
        lined = reliable(cut.join(borders, "_id").select(*cell, "_borders"))
        d = F.col(value).cast("double")
        at_border = F.coalesce(F.try_element_at("_borders", F.col("_below") + 1) == d, F.lit(False))
        placed, step = _inside(present, lined, keys, value, few).withColumn("_below", F.lit(0)), 1 << (cuts.bit_length() - 1)
        while step:  # the number of borders below the value, by binary search: a column a step, as one expression it would double with each
            ahead = F.col("_below") + F.lit(step)
            placed = placed.withColumn("_below", F.when(F.try_element_at("_borders", ahead) < d, ahead).otherwise(F.col("_below")))
            step //= 2
        sliced = (
            placed.withColumn("_at", at_border)
            .groupBy("_id", "_below", "_at")
            .agg(F.count("*").alias("_c"), F.min(value).alias("_least"), F.max(value).alias("_most"))
        )
        upto = F.sum("_c").over(W.partitionBy("_id").orderBy("_below", "_at"))
        edge = lambda k: F.when(k > 0, F.try_element_at("_borders", k))
        parts = sliced.withColumn("_upto", upto).join(lined.select("_id", "_low", "_high", "_start", "_borders"), "_id").select(
            F.col("_id").alias("_of"), F.concat_ws(".", "_id", "_below", "_at").alias("_new_id"),
            F.when(F.col("_at"), F.try_element_at("_borders", F.col("_below") + 1)).otherwise(F.coalesce(edge(F.col("_below")), "_low")).alias("_new_low"),
            F.coalesce(edge(F.col("_below") + 1), "_high").alias("_new_high"), F.col("_at").alias("_new_point"),
            (F.col("_start") + F.col("_upto") - F.col("_c")).alias("_new_start"), F.col("_c").alias("_new_size"),
            F.when(F.col("_least") == F.col("_most"), F.col("_most")).alias("_new_value"),
        )
        holds = (F.col("_rank") >= F.col("_new_start")) & (F.col("_rank") < F.col("_new_start") + F.col("_new_size"))
        moved = cells.where(too_large).join(parts, (F.col("_id") == F.col("_of")) & holds)
        changed = ("_id", "_low", "_high", "_point", "_start", "_size", "_value")
        moved = moved.select(*keys, "_n", "_name", "_rank", *[F.col(f"_new{c}").alias(c) for c in changed])
        cells = reliable(cells.where(~too_large).unionByName(moved))
        # the next round and the ordering at the end read the few rows in question, not the whole table again
        still = _open(cells, keys)
        present = reliable(_inside(present, still, keys, value, still.count() <= max_hot).select(*keys, value))
    raise RuntimeError("slices did not get smaller")


def ranked_values(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, Column],
    cell_rows: int = HOT_ROWS,
    cuts: int = CUTS,
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """(keys, _n, a column per rank): values at given 0-based ranks per group; the rank columns may use ``_n`` (group rows).

    A rank outside the group has no value. Groups without values, or with all ranks outside, have no row.
    """
    keys = list(keys)
    # stored: it is read several times a round, and the plan behind it may be costly
    present = reliable(rows.where(F.col(value).isNotNull()).select(*keys, value))
    cells, _, present = _narrow(present, keys, value, ranks, cell_rows, cuts, max_hot)
    settled = F.col("_value").isNotNull()
    last = _open(cells, keys)
    few = last.count() <= max_hot
    in_cell = W.partitionBy("_id").orderBy(value)
    placed = (
        _inside(present, last, keys, value, few)
        .groupBy("_id", "_start", value)
        .agg(F.count("*").alias("_c"))
        .withColumn("_upto", F.col("_start") + F.sum("_c").over(in_cell))
        .select("_id", F.col(value).alias("_found"), (F.col("_upto") - F.col("_c")).alias("_first"), "_upto")
    )
    asked = cells.where(~settled).alias("a")
    holds = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_upto"))
    found = asked.join(placed.withColumnRenamed("_id", "_of"), (F.col("_id") == F.col("_of")) & holds)
    both = found.select(*keys, "_n", "_name", "_found").unionByName(
        cells.where(settled).select(*keys, "_n", "_name", F.col("_value").alias("_found"))
    )
    return both.groupBy(*keys).agg(
        F.max("_n").alias("_n"), *[F.max(F.when(F.col("_name") == name, F.col("_found"))).alias(name) for name in ranks]
    )


def _sliced_percentiles(rows: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], **limits: int) -> DataFrame:
    ranks = {}
    for name, p in probs.items():
        place = (F.col("_n") - 1) * F.lit(float(p))
        ranks[f"_lo_{name}"] = F.floor(place)
        ranks[f"_hi_{name}"] = F.ceil(place)
    found = ranked_values(rows, keys, value, ranks, **limits)
    out = []
    for name, p in probs.items():
        place = (F.col("_n") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        # both ends weighed, as in ``percentile``: the two ways agree to the last bit
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        out.append(F.when(low == high, low).otherwise(between).alias(name))
    return found.select(*keys, *out)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    aggs: Sequence[Column] = (),
    hot_rows: int = HOT_ROWS,
    max_hot: int = MAX_HOT,
    cuts: int = CUTS,
) -> DataFrame:
    """Per group: linear-interpolated percentiles of ``value`` plus any further aggregates.

    With no keys the whole table is one group (no row when it is empty).
    """
    group = list(keys) or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    rows = rows.withColumn("_v", F.col(value).cast("double"))
    hot, n_hot, n_groups = _hot_groups(rows, group, hot_rows)
    few = n_hot <= max_hot
    result = None
    if n_hot < n_groups or not n_groups:
        ordinary = rows if hot is None else _match(rows, hot, group, "left_anti", few)
        result = ordinary.groupBy(*group).agg(*aggs, *[F.percentile("_v", float(p)).alias(name) for name, p in probs.items()])
    if hot is not None:
        hot_part = rows if result is None else _match(rows, hot, group, "left_semi", few)
        sliced = _sliced_percentiles(hot_part, group, "_v", probs, cell_rows=hot_rows, cuts=cuts, max_hot=max_hot)
        # one row per hot group, matched with null keys equal
        others = hot_part.groupBy(*group).agg(*aggs) if aggs else hot.select(*group)
        names = [c for c in others.columns if c not in group]
        pairs = sliced.select(*[F.col(k).alias(f"_r_{k}") for k in group], *probs)
        same = [others[key].eqNullSafe(pairs[f"_r_{key}"]) for key in group]
        sliced = others.join(pairs, reduce(and_, same), "left").select(*group, *names, *probs)
        result = sliced if result is None else result.unionByName(sliced)
    return result if keys else result.drop("_all")


def exact_percentile_of_table(df: DataFrame, value: str, probs: Mapping[str, float], hot_rows: int = HOT_ROWS, **limits: int) -> DataFrame:
    """One row of percentiles over the whole table; nulls when it is empty.

    No size check: the count of the first round tells whether the table is within the limit.
    """
    rows = df.select(F.lit(0).alias("_all"), F.col(value).cast("double").alias("_v"))
    found = _sliced_percentiles(rows, ["_all"], "_v", probs, cell_rows=hot_rows, **limits)
    return reliable(found.agg(*[F.max(name).alias(name) for name in probs]))
