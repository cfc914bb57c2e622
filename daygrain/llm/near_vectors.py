"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A rotation is three rounds of random signs and a Hadamard transform. A vector's hash is the axis of the rotated
vector with the largest absolute value, with its sign; a bucket joins ``hashes`` of them. In each table a
vector lives in its own bucket and visits the next likely ones. Two vectors meet in a table if one visits or shares the
other's bucket. The number of tables follows from the measured chance that two vectors just at the limit meet.

All vectors that meet are compared in double precision; a pair that meets in several tables counts in the first. A task
holds one block of a bucket's residents and one of its residents and visitors, so hot buckets spread; it returns
counts per vector and links that join components, never the pairs. Equal vectors are one, with a count.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm import vectors as V
from daygrain.llm.graphs import components
from daygrain.llm.tables import Stored, small

PROBES = 2  # buckets of a table that a vector is in
MISS = 1e-5  # chance that a pair at the limit meets in no table
BLOCK = 512
BUCKET = 64  # mean residents of a bucket, from which the number of hashes follows
_EDGE = 1e-9  # cosines so near the limit are computed again, term by term


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / math.sqrt(width)


def bucket_codes(unit: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` likeliest buckets of each unit vector in a table, its own first."""
    n, dim = unit.shape
    width = max(2, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    tops, codes = [], []
    near = min(probes, width)
    for h in range(hashes):
        signs = np.random.default_rng([17, table, h]).choice([-1.0, 1.0], (3, width))
        x = padded
        for row in signs:
            x = hadamard(x * row)
        order = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :near]
        value = np.take_along_axis(x, order, axis=1)
        tops.append(np.abs(value))
        codes.append(2 * order + (value < 0))
    # going to a later axis in one hash costs the square of the height given up
    combos = [c for c in itertools.product(range(near), repeat=hashes) if sum(c) < probes]
    costs = np.stack([sum((tops[h][:, 0] - tops[h][:, k]) ** 2 for h, k in enumerate(c)) for c in combos], axis=1)
    values = np.stack([sum(codes[h][:, k] * (2 * width) ** h for h, k in enumerate(c)) for c in combos], axis=1)
    best = np.argsort(costs, axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(values, best, axis=1).astype(np.int64)


def tables_needed(dim: int, least: float, hashes: int, probes: int, miss: float) -> int:
    """Tables after which a pair with cosine ``least`` is missed with at most ``miss``, by simulation."""
    rng = np.random.default_rng(3)
    x, z = rng.normal(size=(2, 4000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.maximum(np.linalg.norm(z, axis=1)[:, None], 1e-12)
    a = bucket_codes(x, 0, hashes, probes)
    b = bucket_codes(least * x + math.sqrt(1 - least**2) * z, 0, hashes, probes)
    meet = ((b == a[:, :1]).any(axis=1) | (a == b[:, :1]).any(axis=1)).mean()
    return max(1, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - min(meet, 1 - 1e-9)))))


def _codes(batches: Iterator[pa.RecordBatch], tables: int, hashes: int, probes: int) -> Iterator[pa.RecordBatch]:
    """Adds the buckets of all tables, table after table, as a list and as bytes."""
    for batch in batches:
        vec = V.matrix(batch.column(2))
        unit = vec / np.linalg.norm(vec, axis=1)[:, None]
        codes = np.concatenate([bucket_codes(unit, t, hashes, probes) for t in range(tables)], axis=1)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                V.bytes_column(vec.astype(np.float64)),
                V.bytes_column(codes.astype(np.int32 if codes.max(initial=0) < 1 << 31 else np.int64)),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(vec) + 1, dtype=np.int32) * codes.shape[1]), pa.array(codes.reshape(-1))
                ),
            ],
            names=["node", "copies", "vec", "codes", "buckets"],
        )


def _cells(batches: Iterator[pa.RecordBatch], least: float, probes: int, wide: bool) -> Iterator[pa.RecordBatch]:
    def solve(table: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        last = np.append(first[1:], table.num_rows)
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        row_, column_, home_ = (table[k].to_numpy() for k in ("asks", "asked", "home"))
        number = table["table"].to_numpy()
        vec = V.bytes_matrix(V.plain(table, "vec"), np.float64)
        codes = V.bytes_matrix(V.plain(table, "codes"), np.int64 if wide else np.int32)
        codes = codes.reshape(len(codes), -1, probes)
        unit = vec / np.linalg.norm(vec, axis=1)[:, None]
        a_out, b_out, n_out = [], [], []
        for s, e in zip(first, last, strict=True):
            if e - s < 2:
                continue
            rows, columns = np.flatnonzero(row_[s:e]) + s, np.flatnonzero(column_[s:e]) + s
            cosine = unit[rows] @ unit[columns].T
            i, j = np.nonzero(cosine >= least - _EDGE)
            x, y = rows[i], columns[j]
            # residents are compared once, by the smaller node; a visitor always by the resident
            good = (node[x] != node[y]) & (~home_[y] | (node[x] < node[y]))
            x, y, c = x[good], y[good], cosine[i, j][good]
            edge = np.flatnonzero(np.abs(c - least) <= _EDGE)
            if len(edge):
                p, q = vec[x[edge]], vec[y[edge]]
                exact = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1)))
                good = np.ones(len(x), bool)
                good[edge] = exact >= least
                x, y = x[good], y[good]
            if not len(x):
                continue
            t = int(number[s])
            new = np.ones(len(x), bool)
            for k in range(t + 1):
                if k < t:
                    met = (codes[x, k] == codes[y, k, :1]).any(axis=1) | (codes[y, k] == codes[x, k, :1]).any(axis=1)
                else:
                    # each visits the other: it counts in the smaller bucket
                    met = ~home_[y] & (codes[x, k] == codes[y, k, :1]).any(axis=1) & (codes[y, k, 0] < codes[x, k, 0])
                new &= ~met
            x, y = x[new], y[new]
            if not len(x):
                continue
            local = np.zeros(e - s, np.int64)
            np.add.at(local, x - s, copies[y])
            np.add.at(local, y - s, copies[x])
            linked = np.flatnonzero(local)
            a_out.append(node[s + linked])
            b_out.append(np.full(len(linked), -1))
            n_out.append(local[linked])
            # links that join components of this cell, by label propagation over its own links
            label = node[s:e].copy()
            while True:
                low = np.minimum(label[x - s], label[y - s])
                before = label.copy()
                np.minimum.at(label, x - s, low)
                np.minimum.at(label, y - s, low)
                if (before == label).all():
                    break
            joined = np.flatnonzero(label != node[s:e])
            a_out.append(node[s + joined])
            b_out.append(label[joined])
            n_out.append(np.zeros(len(joined), np.int64))
        columns_ = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a_out, b_out, n_out)]
        flags = columns_[1] < 0 if len(columns_[1]) else np.zeros(0, bool)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns_[0]), pa.array(columns_[1], mask=flags & (columns_[2] > 0)), pa.array(columns_[2])],
            names=["a", "b", "n"],
        )

    yield from V.whole_groups(batches, ["table", "bucket", "i", "j"], solve)


def near_vectors(
    vectors: DataFrame,
    stored: Stored,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    least: float = 0.9,
    probes: int = PROBES,
    miss: float = MISS,
) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors with cosine of ``least`` or more (above 0) are linked; of them one at the limit is missed with a chance of
    ``miss``. ``n_links`` counts the other vectors linked, copies included. Vectors that are null, zero, of another
    length than most, or hold null or non-finite components link with nothing, nor do rows without id, whose component
    is null and which are kept. Rows that repeat an id are one vector, its greatest.
    """
    spark = vectors.sparkSession
    usable = stored.put(V.usable_vectors(vectors, id_col, vec_col))
    dims = usable.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    found = None
    if dims:
        rows, dim = dims["count"], dims["d"]
        width = 2 * max(2, 1 << (dim - 1).bit_length())
        hashes = max(2, math.ceil(math.log(max(2, rows / BUCKET)) / math.log(width)))
        tables = tables_needed(dim, least, hashes, probes, miss)
        keyed = usable.where(F.size("vec") == dim).withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(2), "vec")})
        classes = keyed.groupBy("k1", "k2").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
        members = stored.put(keyed.join(classes, ["k1", "k2"]).select("id", "node", "copies", "vec"))
        wide = width**hashes >= 1 << 31
        coded = stored.put(
            members.where("id = node")
            .select("node", "copies", "vec")
            .mapInArrow(
                lambda it: _codes(it, tables, hashes, probes),
                "node long, copies long, vec binary, codes binary, buckets array<long>",
            )
        )
        placed = coded.select("node", F.posexplode("buckets").alias("at", "bucket")).select(
            "node", "bucket", F.floor(F.col("at") / probes).cast("long").alias("table"), (F.col("at") % probes == 0).alias("home")
        )
        sizes = (
            placed.groupBy("table", "bucket")
            .agg(F.count("*").alias("all"), F.count_if("home").alias("homes"))
            .where("all > 1 and homes > 0")
            .withColumns(
                {"rows_in": F.ceil(F.col("homes") / BLOCK), "cols_in": F.ceil(F.col("all") / BLOCK)}
            )
        )
        spread = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
        met = placed.join(sizes, ["table", "bucket"]).withColumns({"r": spread % F.col("rows_in"), "c": spread % F.col("cols_in")})
        # the cells of a resident's row and of everyone's column; where both meet the row comes once
        across = F.transform(F.sequence(F.lit(0).cast("long"), F.col("cols_in") - 1), lambda j: F.struct(F.col("r").alias("i"), j.alias("j")))
        down = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rows_in") - 1), lambda i: F.struct(i.alias("i"), F.col("c").alias("j")))
        cells = met.withColumn("cell", F.explode(F.array_distinct(F.concat(F.when(F.col("home"), across).otherwise(F.array().cast("array<struct<i:bigint,j:bigint>>")), down))))
        cell_rows = cells.select(
            "table", "bucket", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "node", "home",
            (F.col("home") & (F.col("cell.i") == F.col("r"))).alias("asks"), (F.col("cell.j") == F.col("c")).alias("asked"),
        )
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["table", "bucket", "i", "j"]
        found = stored.put(
            cell_rows.join(coded.drop("buckets"), "node")
            .repartition(parts, *order)
            .sortWithinPartitions(*order)
            .mapInArrow(lambda it: _cells(it, least, probes, wide), "a long, b long, n long")
        )
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    if found is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b is not null").select("a", "b"), stored)
    linked = (
        members.where("copies > 1")
        .select("node")
        .unionByName(counts.select("node"))
        .distinct()
        .join(counts, "node", "left")
        .join(roots, "node", "left")
    )
    result = members.select("id", "node", "copies").join(linked, "node").select(
        F.col("id").alias("vec_id"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    out = ids.join(small(stored.put(result)), "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
