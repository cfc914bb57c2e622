"""Mixing sources to target weights along a curriculum.

Each source has a weight and a schedule: how strongly it is asked for in each phase of training. The
weights give every source a target number of words, limited to a multiple of its size. A schedule is
integrated over the phases into the source's cumulative demand. Its documents stand one after another on
that demand, in the order of a hash, and once more for each further pass. Inverting the demand at a
document's place gives its training position in [0, 1); the mix is the documents sorted by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.llm.tables import Stored, numbered, parts_for, row_keys, small

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (1, 2, 3)
LIMIT = 3
#: (end of the phase, strength of sources of weight 1, 2, 3): light sources early, heavy ones late.
PHASES = ((0.25, (3.0, 1.0, 1.0)), (0.75, (1.0, 1.0, 1.0)), (1.0, (1.0, 1.0, 3.0)))
BUCKET_ROWS = 2_000  # of a bucket of the hash, on average over all sources
PART_ROWS = 20_000  # of a range of the sorted mix


def _position(share: Column, turn: Column, phases: Sequence[tuple[float, Sequence[float]]], cycle: int) -> Column:
    """Time at which a source of this place in the weight cycle has met ``share`` of its demand."""
    out = None
    for k in range(cycle):
        areas, start = [], 0.0
        for end, strengths in phases:
            areas.append((start, end, (end - start) * strengths[k]))
            start = end
        total, done, time = sum(a for _, _, a in areas), 0.0, F.lit(1.0)
        pieces = []
        for start, end, area in areas:
            pieces.append((done / total, area / total, start, end))
            done += area
        for low, part, start, end in reversed(pieces):
            if part:
                inside = F.lit(start) + (share - F.lit(low)) / F.lit(part) * F.lit(end - start)
                time = F.when(share < F.lit(low + part), inside).otherwise(time)
        out = F.when(turn == k, time) if out is None else out.when(turn == k, time)
    return out


def source_targets(
    sources: DataFrame, stored: Stored, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT
) -> DataFrame:
    """``sources`` (source, source_size) plus ``turn`` (place in the weight cycle) and ``target``.

    Sources in order, null last, take the weights in turn and share the total size by them. A target stops
    at ``limit`` times its size; what is over is shared again by weight until no source is above.
    The loop's every pass fixes one source at least and brings two sums to the driver.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = numbered(sources, [F.col("source").asc_nulls_last()], stored)
    table = stored.put(
        placed.select(
            "source", "source_size", (F.col("_n") % len(weights)).cast("int").alias("turn"),
        ).withColumn("weight", F.element_at(cycle, F.col("turn") + 1))
    )
    most = F.col("source_size") * limit
    unit = 0.0
    while True:
        # a source at its limit stays there: the unit only grows
        free = most > F.lit(unit) * F.col("weight") if unit else F.lit(True)
        total, fixed, weight = table.agg(
            F.sum("source_size"),
            F.coalesce(F.sum(F.when(~free, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not weight:
            break
        again = float((total or 0) - fixed) / weight
        if again == unit:
            break
        unit = again
    target = F.least(most.cast("double"), F.lit(unit) * F.col("weight"))
    return table.select("source", "source_size", "turn", target.alias("target"))


def mix(
    docs: DataFrame,
    stored: Stored,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    phases: Sequence[tuple[float, Sequence[float]]] = PHASES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, source, ``keep``, size, source_size, target, copies, positions, taken.

    A document's size is its number of words, 0 for a null text. It is taken once for every pass in which
    the middle of its words comes before the target, so a source misses its target by half a document at most.
    ``positions`` are the training positions of its copies. Documents of one source go by the MD5 of their
    id, equal ids by size; null ids are one id, a null source is a source. Reruns agree. Columns named in
    ``keep`` are carried along; none may have a name of the result.

    A hot source is cut into buckets of the hash, so its running sum needs no task of its own.
    """
    key = F.coalesce(F.md5(F.col(id_col).cast("string")), F.lit(""))
    sizes = stored.put(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), *[F.col(c) for c in keep],
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            key.alias("_key"),
        )
    )
    rows, digits = sizes.count(), 1
    while 16**digits * BUCKET_ROWS < rows:
        digits += 1
    bucketed = sizes.withColumns(
        {"_s": F.coalesce("source", F.lit("")), "_none": F.col("source").isNull(), "_bucket": F.substring("_key", 1, digits)}
    )
    group = ["_s", "_none"]
    sums = stored.put(bucketed.groupBy(*group, "_bucket").agg(F.sum("size").alias("_sum")))
    by_source = sums.groupBy(*group).agg(F.sum("_sum").alias("source_size"))
    names = by_source.select(F.when(~F.col("_none"), F.col("_s")).alias("source"), "source_size")
    targets = source_targets(names, stored, weights, limit).withColumns(
        {"_s": F.coalesce("source", F.lit("")), "_none": F.col("source").isNull()}
    )
    before = F.sum("_sum").over(W.partitionBy(*group).orderBy("_bucket")) - F.col("_sum")
    starts = sums.withColumn("_before", before).drop("_sum").join(targets.drop("source"), group)
    inside = W.partitionBy(*group, "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    begin = F.col("_before") + F.sum("size").over(inside) - F.col("size")
    laid = bucketed.join(starts, [*group, "_bucket"]).withColumn("_begin", begin)
    passes = (F.lit(2.0) * F.col("target") - 2 * F.col("_begin") - F.col("size")) / (2 * F.col("source_size"))
    counted = laid.withColumn(
        "copies", F.when(F.col("source_size") > 0, F.greatest(F.ceil(passes), F.lit(0))).otherwise(F.lit(0)).cast("long")
    )
    share = lambda p: (p * F.col("source_size") + F.col("_begin")) / F.col("target")
    positions = F.when(
        F.col("copies") > 0,
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("copies") - 1),
            lambda p: _position(share(p), F.col("turn"), phases, len(weights)),
        ),
    ).otherwise(F.array().cast("array<double>"))
    return counted.select(
        "doc_id", "source", *keep, "size", "source_size", "target", "copies", positions.alias("positions"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def sorted_mix(docs: DataFrame, stored: Stored, **options) -> DataFrame:
    """``mix`` with the places that each document's copies have in the mix sorted by training position.

    Copies (document, pass) are range-sorted by position and numbered through from 0; ``first_place`` and ``last_place``
    are the least and the largest number, null for a document that is not taken. Equal positions go by source, id, size and pass,
    nulls first, so reruns agree. Options, nulls and names as for ``mix``.
    """
    rows = stored.put(mix(docs, stored, **options).withColumn("_row", F.monotonically_increasing_id()))
    turns = rows.select("_row", "source", "doc_id", "size", F.posexplode("positions").alias("_pass", "_position"))
    # rows are told apart by _row only where they are equal in all else
    placed = numbered(turns, ["_position", "source", "doc_id", "size", "_pass", "_row"], stored)
    places = placed.groupBy("_row").agg(F.min("_n").alias("first_place"), F.max("_n").alias("last_place"))
    return rows.join(places, "_row", "left").drop("_row")


def curriculum(
    docs: DataFrame, stored: Stored, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents of the mix, each as often as taken, range-sorted by training position; ``options`` as for ``mix``.

    All columns of ``docs`` are kept, none added. A document of no words comes along where it stands, unless its whole
    source has none: such a source is in no demand. The mix is made of ids and sizes; texts are moved twice, to
    their positions and into their order.
    """
    key = ["k1", "k2"]
    names = {"doc_id": id_col, "source": source_col, "text": text_col}
    slim = docs.select(*[F.col(c).alias(n) for n, c in names.items()], *[h.alias(k) for k, h in row_keys(docs).items()])
    mixed = mix(slim, stored, keep=key, **options).where("copies > 0")
    places = stored.put(
        mixed.groupBy(*key).agg(F.flatten(F.collect_list("positions")).alias("positions"), F.count("*").alias("c"))
    )
    total, repeated = places.agg(F.sum(F.size("positions")), F.count_if(F.col("c") > 1)).first()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[h.alias(k) for k, h in row_keys(docs).items()]
    )
    if repeated:  # equal rows are one, which stands at the positions of all
        twice = small(places.where("c > 1").select(*key), repeated)
        once = rows.join(twice, key, "left_semi").dropDuplicates(key)
        rows = rows.join(twice, key, "left_anti").unionByName(once)
    turns = rows.join(places, key).select("row", *key, F.posexplode("positions").alias("pass", "position"))
    parts = parts_for(docs.sparkSession, int(total or 0), PART_ROWS)
    order = ["position", *key, "pass"]
    return turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("row.*")
