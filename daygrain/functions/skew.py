"""Lookup joins that keep working when one key holds a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.storage import reliable

HOT_ROWS = 1_000_000  # rows of a key that one task may join
MAX_HOT = 10_000
NULL_SPREAD = 4096
BUCKETS = 1 << 20  # of hashed keys in a sketch


def find_hot(rows: DataFrame, keys: Sequence[str], hot_rows: int, max_hot: int) -> DataFrame | None:
    """Groups above the row limit as (keys, ``_size``, ``_limit``), or None: the size check.

    One counting job that reads only the key columns. The limit grows with the table,
    so fewer than ``max_hot`` groups can pass it, which bounds every later broadcast
    of the result; the few rows are stored so that plans using them stay short.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_size"))
    shape = sizes.agg(F.sum("_size").alias("total"), F.max("_size").alias("largest")).first()
    limit = max(float(hot_rows), (shape["total"] or 0) / max_hot)
    if (shape["largest"] or 0) <= limit:
        return None
    return reliable(sizes.where(F.col("_size") > limit).withColumn("_limit", F.lit(limit)))


def _any_null(keys: Sequence[str]) -> Column:
    test = F.lit(False)
    for key in keys:
        test = test | F.col(key).isNull()
    return test


class KeySketch:
    """Rows of a table per bucket of hashed keys, for all lookups that are to be joined to it.

    One job reads the table once, whatever the number of lookups; the counts (at most ``BUCKETS`` rows a lookup) are stored
    and later plans read those. Keys that share a bucket are counted together, so a key may be cut into more pieces than
    it needs, never into fewer. Keys of floating point are left out: they go by ``find_hot``.
    """

    def __init__(
        self, rows: DataFrame, key_sets: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT
    ) -> None:
        kinds = dict(rows.dtypes)
        known = [tuple(keys) for keys in key_sets if all(kinds.get(k) not in (None, "float", "double") for k in keys)]
        self.kinds = {keys: [kinds[k] for k in keys] for keys in dict.fromkeys(known)}
        self._pieces: dict[tuple[str, ...], DataFrame | None] = {}
        if not self.kinds:
            return
        places = [
            F.struct(F.lit(i).alias("_set"), _bucket(keys).alias("_code")) for i, keys in enumerate(self.kinds)
        ]
        coded = rows.select(F.explode(F.array(*places)).alias("_at")).select("_at.*")
        counts = reliable(coded.groupBy("_set", "_code").agg(F.count("*").alias("_size")))
        shapes = counts.groupBy("_set").agg(F.sum("_size").alias("total"), F.max("_size").alias("largest"))
        shape = {r["_set"]: r for r in shapes.collect()}
        for i, keys in enumerate(self.kinds):
            limit = max(float(hot_rows), shape[i]["total"] / max_hot) if i in shape else float(hot_rows)
            hot = None
            if i in shape and shape[i]["largest"] > limit:
                hot = counts.where((F.col("_set") == i) & (F.col("_size") > limit)).select(
                    "_code", F.ceil(F.col("_size") / F.lit(limit)).cast("long").alias("_pieces")
                )
            self._pieces[keys] = hot

    def covers(self, base: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> bool:
        """Whether both sides' keys have the counted types, so that equal keys share a bucket."""
        sides = [[dict(side.dtypes)[k] for k in keys] for side in (base, lookup)]
        return self.kinds.get(tuple(keys)) == sides[0] == sides[1]

    def pieces(self, keys: Sequence[str]) -> DataFrame | None:
        """Pieces per hot bucket (``_code``), or None."""
        return self._pieces[tuple(keys)]


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def _split_join(
    base: DataFrame, lookup: DataFrame, keys: Sequence[str], pieces: DataFrame, by: Sequence[str], salt: Column
) -> DataFrame:
    """Left join on keys and a salt below the ``_pieces`` that both sides find by the columns ``by``."""
    salted_base = (
        base.join(F.broadcast(pieces), by, "left")
        .withColumn(
            "_salt",
            F.when(_any_null(keys), F.pmod(salt, F.lit(NULL_SPREAD)))
            .when(F.col("_pieces").isNull(), F.lit(0))
            .otherwise(F.pmod(salt, F.col("_pieces")))
            .cast("long"),
        )
        .drop("_pieces")
    )
    repeats = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    repeated = (
        lookup.join(F.broadcast(pieces), by, "left").withColumn("_salt", F.explode(repeats)).drop("_pieces")
    )
    return salted_base.join(repeated, [*keys, "_salt"], "left")


def salted_lookup(
    base: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    max_hot: int = MAX_HOT,
    sketch: KeySketch | None = None,
) -> DataFrame:
    """Left equi-join to a lookup with one row per key, splitting hot base keys.

    A key above the row limit is cut into ``ceil(rows / limit)`` pieces and its single
    lookup row repeated once per piece, so at most ``2 * max_hot`` rows are added.
    Other keys join unchanged and Spark picks broadcast or shuffle from the sizes it
    measures. Base rows with a null key cannot match; many of them are spread as well.
    A ``sketch`` of the base's keys, where it covers these, saves the size check.
    """
    keys = list(keys)
    extra = [c for c in lookup.columns if c not in keys]
    sketched = sketch is not None and sketch.covers(base, lookup, keys)
    if sketched:
        pieces, by = sketch.pieces(keys), ["_code"]
    else:
        hot, by, pieces = find_hot(base, keys, hot_rows, max_hot), keys, None
        if hot is not None:
            pieces = hot.select(*keys, F.ceil(F.col("_size") / F.col("_limit")).cast("long").alias("_pieces"))
    if pieces is None:
        return base.join(lookup, keys, "left").select(*base.columns, *extra)
    hashable = [c for c, kind in base.dtypes if "map<" not in kind]
    rows_hash = F.abs(F.xxhash64(*hashable) % F.lit(1_000_003)) + F.spark_partition_id()
    left, right = base, lookup
    if sketched:
        left, right = left.withColumn("_code", _bucket(keys)), right.withColumn("_code", _bucket(keys))
    joined = _split_join(left, right, keys, pieces, by, rows_hash)
    return joined.select(*base.columns, *extra)


def crowd_lookup(
    base: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    member: str,
    members: DataFrame,
    crowd: Sequence[str],
    most: int = HOT_ROWS,
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """Left join to a lookup with one row per key, where a key has one base row per member of its crowd at most.

    For base tables that are costly to count: ``members`` is the small table behind them, one row per ``member`` with its
    ``crowd`` (some of the keys). A crowd of more than ``most`` members is cut into ``ceil(members / most)`` pieces by a hash of
    the member, others stay whole. Base rows with a null key cannot match and are spread by member.
    """
    keys, crowd = list(keys), list(crowd)
    extra = [c for c in lookup.columns if c not in keys]
    hot = find_hot(members.select(*crowd), crowd, most, max_hot)
    salt = F.xxhash64(member)
    if hot is None:
        left = base.withColumn("_salt", F.when(_any_null(keys), F.pmod(salt, F.lit(NULL_SPREAD))).otherwise(F.lit(0).cast("long")))
        joined = left.join(lookup.withColumn("_salt", F.lit(0).cast("long")), [*keys, "_salt"], "left")
    else:
        pieces = hot.select(*crowd, F.ceil(F.col("_size") / F.col("_limit")).cast("long").alias("_pieces"))
        joined = _split_join(base, lookup, keys, pieces, crowd, salt)
    return joined.select(*base.columns, *extra)
