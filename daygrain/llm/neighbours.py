"""Nearest neighbours by inner product: a neighbour graph from NN-descent, queried by greedy graph search.

Vectors get one more component so that all have the same length; then the largest inner product is also the
nearest point, and a neighbour of a neighbour is likely a neighbour. The graph starts from blocks of
random projections: vectors with the same signs are compared with each other, in a few such trees. In each round of
NN-descent every node hears of some neighbours and of some nodes that it is a neighbour of, new ones first; all of
these are compared with each other and the better links kept, until few links change.

A query starts at the best of a fixed number of pivots and, if it is a row itself, at its own neighbours. In each step it
opens the nearest nodes not opened yet and meets their neighbours, until all that it holds are opened. What it met nearest
is scored again on the original vectors.

Vectors travel as bytes of 4-byte numbers, or 8-byte ones if any needs them, and are compared in double precision: links by
distance, so that nodes near each other are told apart, queries by inner product. Rows a node may receive are limited by
rank before any shuffle, so a node that is everybody's neighbour fills no task. Equal vectors are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.llm import vectors as V
from daygrain.llm.tables import Stored

DEGREE = 32  # neighbours of a node
TREES, LEAF, LEAF_LINKS = 12, 1024, 10  # first links: trees, rows of a leaf, links a leaf gives a node
HEAR = 16  # new and old neighbours, and nodes pointing here, that a node hears of: four times as many at most
OFFER = 6  # links that one comparison offers a node
ROUNDS, SETTLED = 100, 0.002  # rounds after which it is an error; share of changed links below which a round was the last
PIVOTS = 1024
BEAM, OPEN, STEPS = 128, 32, 300  # nodes a query holds at least, opens in a step; steps after which it is an error
_GRAPH = "id long, other long, score double"
_LINKS = "array<struct<score: double, other: bigint, fresh: boolean>>"


def _encode(batches: Iterator[pa.RecordBatch], longest: float, kind: type) -> Iterator[pa.RecordBatch]:
    """Vectors with the component that makes all lengths equal, less that of the zero vector: distances stay the same."""
    for batch in batches:
        vec = V.matrix(batch.column(1))
        size = (vec**2).sum(axis=1)
        rest = -size / (longest + np.sqrt(np.maximum(longest**2 - size, 0)))
        both = np.concatenate([vec, rest[:, None]], axis=1).astype(kind)
        yield pa.RecordBatch.from_arrays([batch.column(0), V.bytes_column(both)], names=["id", "vec"])


def _encode_queries(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[pa.RecordBatch]:
    """A query's own added component is 0: what it scores is the inner product alone."""
    for batch in batches:
        vec = V.matrix(batch.column(1))
        both = np.concatenate([vec, np.zeros((len(vec), 1))], axis=1).astype(kind)
        yield pa.RecordBatch.from_arrays([batch.column(0), V.bytes_column(both)], names=["query", "vec"])


def _nearness(vec: np.ndarray) -> np.ndarray:
    """Squared distances of all rows, negative."""
    size = np.einsum("ij,ij->i", vec, vec)
    return 2 * (vec @ vec.T) - size[:, None] - size[None, :]


def _leaves(batches: Iterator[pa.RecordBatch], depth: int, trees: int, kind: type) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vec = V.bytes_matrix(batch.column(1), kind)[:, :-1].astype(float)
        signs = [
            (vec @ np.random.default_rng([29, t]).normal(size=(vec.shape[1], depth)) > 0)
            @ (1 << np.arange(depth, dtype=np.int64))
            for t in range(trees)
        ]
        for t, leaf in enumerate(signs):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(leaf), t, np.int64)), pa.array(leaf)], names=["id", "vec", "tree", "leaf"]
            )


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest of each row."""
    k = min(k, score.shape[1])
    return np.argpartition(-score, k - 1, axis=1)[:, :k] if k else np.zeros((len(score), 0), int)


def _links(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b, s = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array(s)],
        names=["id", "other", "score"],
    )


def _leaf_links(batches: Iterator[pa.RecordBatch], degree: int, kind: type) -> Iterator[pa.RecordBatch]:
    def solve(table: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        ids = table["id"].to_numpy()
        vec = V.bytes_matrix(V.plain(table, "vec"), kind).astype(float)
        out = []
        for s, e in zip(first, np.append(first[1:], len(ids)), strict=True):
            if e - s < 2:
                continue
            score = _nearness(vec[s:e])
            np.fill_diagonal(score, -np.inf)
            best = _best(score, min(degree, e - s - 1))
            out.append((np.repeat(ids[s:e], best.shape[1]), ids[s:e][best].reshape(-1), np.take_along_axis(score, best, 1).reshape(-1)))
        return _links(out)

    yield from V.whole_groups(batches, ["tree", "leaf", "part"], solve)


def _joins(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[pa.RecordBatch]:
    """All that a node heard of, compared with each other unless both are old. What it heard twice counts once."""

    def solve(table: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        ids, worst, fresh = (table[k].to_numpy() for k in ("other", "worst", "fresh"))
        vec = V.bytes_matrix(V.plain(table, "vec"), kind).astype(float)
        out = []
        for s, e in zip(first, np.append(first[1:], len(ids)), strict=True):
            if e - s < 2 or not fresh[s:e].any():
                continue
            # rows are sorted by id, fresh ones last
            one, lasts = ids[s:e], np.append(ids[s + 1 : e] != ids[s : e - 1], True)
            one, new, x, limit = one[lasts], fresh[s:e][lasts], vec[s:e][lasts], worst[s:e][lasts]
            score = _nearness(x)
            score[~(new[:, None] | new[None, :])] = -np.inf
            np.fill_diagonal(score, -np.inf)
            best = _best(score, OFFER)
            value = np.take_along_axis(score, best, 1)
            i, j = np.nonzero(value > limit[:, None])
            out.append((one[i], one[best[i, j]], value[i, j]))
        return _links(out)

    yield from V.whole_groups(batches, ["at"], solve)


def _told(fresh: bool) -> Column:
    """Some of a node's neighbours, by luck: of the new ones, or of the others."""
    chosen = F.filter("links", lambda x: x["fresh"] if fresh else ~x["fresh"])
    lucky = F.transform(chosen, lambda x: F.struct(F.xxhash64("id", x["other"]).alias("luck"), x["other"].alias("other")))
    return F.transform(F.slice(F.sort_array(lucky), 1, HEAR), lambda x: x["other"])


def _merged(nodes: DataFrame, links: DataFrame, degree: int) -> DataFrame:
    """``nodes`` (id, vec, links) with the best ``degree`` of their links and those offered (id, other, score).

    Each task passes on a bounded number of a node's links. A link that was there before is not fresh anew.
    """
    nearest = W.partitionBy("id").orderBy(F.desc("score"), "other")
    few = links.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= 4 * degree)
    offered = few.groupBy("id").agg(F.collect_set(F.struct("score", "other", F.lit(True).alias("fresh"))).alias("offers"))
    both = F.concat("links", F.coalesce("offers", F.expr(f"cast(array() as {_LINKS})")))
    # a link offered again stands next to itself, the one that is not fresh first
    by_other = F.sort_array(F.transform(both, lambda x: F.struct(x["other"].alias("other"), x["fresh"].alias("fresh"), x["score"].alias("score"))))
    ordered = nodes.join(offered, "id", "left").select("id", "vec", by_other.alias("ordered"))
    first = F.filter("ordered", lambda x, i: (i == 0) | (F.get("ordered", i - 1)["other"] != x["other"]))
    links = F.transform(first, lambda x: F.struct(x["score"].alias("score"), x["other"].alias("other"), x["fresh"].alias("fresh")))
    return ordered.select("id", "vec", F.slice(F.sort_array(links, asc=False), 1, degree).alias("links"))


def neighbour_graph(nodes: DataFrame, stored: Stored, rows: int, degree: int = DEGREE, kind: type = np.float32) -> DataFrame:
    """(id, vec, links): each node of ``nodes`` (id, vec) with about its ``degree`` nearest, nearest first.

    A round has five exchanges: what nodes hear back, the vectors they hear of (two), the comparisons and the offers.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    depth = max(1, int(np.ceil(np.log2(max(2, rows / LEAF)))))
    leaves = nodes.mapInArrow(lambda it: _leaves(it, depth, TREES, kind), "id long, vec binary, tree long, leaf long")
    sizes = leaves.groupBy("tree", "leaf").count().withColumn("parts", F.ceil(F.col("count") / (2 * LEAF))).drop("count")
    cells = leaves.join(sizes, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), "parts"))
    keys = ["tree", "leaf", "part"]
    first = cells.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(lambda it: _leaf_links(it, LEAF_LINKS, kind), _GRAPH)
    bare = nodes.withColumn("links", F.expr(f"cast(array() as {_LINKS})"))
    graph = stored.put(_merged(bare, first, degree))
    for _ in range(ROUNDS):
        told = graph.select("id", _told(True).alias("new"), _told(False).alias("old"), "vec", "links")
        forth = told.select("id", F.explode(F.concat(
            F.transform("new", lambda x: F.struct(x.alias("other"), F.lit(True).alias("fresh"))),
            F.transform("old", lambda x: F.struct(x.alias("other"), F.lit(False).alias("fresh"))),
        )).alias("x")).select(F.col("id").alias("at"), "x.other", "x.fresh")
        back = forth.select(F.col("other").alias("at"), F.col("at").alias("other"), "fresh")
        place = F.row_number().over(W.partitionBy("at", "fresh").orderBy(F.xxhash64("at", "other", F.lit(31))))
        back = back.withColumn("_k", place).where(F.col("_k") <= HEAR).drop("_k")
        worst = F.when(F.size("links") >= degree, F.element_at("links", -1)["score"])
        known = graph.select(F.col("id").alias("other"), "vec", F.coalesce(worst, F.lit(float("-inf"))).alias("worst"))
        offers = (
            forth.unionByName(back)
            .join(known, "other")
            .repartition(parts, "at")
            .sortWithinPartitions("at", "other", "fresh")
            .mapInArrow(lambda it: _joins(it, kind), _GRAPH)
        )
        told_new = F.transform("links", lambda x: F.struct(
            x["score"].alias("score"), x["other"].alias("other"), (x["fresh"] & ~F.array_contains("new", x["other"])).alias("fresh")
        ))
        before, graph = graph, stored.put(_merged(told.select("id", "vec", told_new.alias("links")), offers, degree))
        stored.drop(before)
        spark._jvm.System.gc()  # lets Spark delete the round's shuffle files
        changed, links = graph.agg(F.sum(F.size(F.filter("links", lambda x: x["fresh"]))), F.sum(F.size("links"))).first()
        if (changed or 0) <= SETTLED * (links or 0):
            return graph
    raise RuntimeError(f"the neighbour graph did not settle in {ROUNDS} rounds")


def _ways(graph: DataFrame, degree: int) -> DataFrame:
    """(node, other): what a query meets when it opens a node: its neighbours and up to ``degree`` nodes it is one of.

    Of the latter those that fewest nodes point at come first, so that nodes at the rim are found.
    """
    pairs = graph.select("id", F.explode("links").alias("x")).select(F.col("x.other").alias("node"), F.col("id").alias("other"), "x.score")
    known = pairs.groupBy("node").count().select(F.col("node").alias("other"), F.col("count").alias("known"))
    place = F.row_number().over(W.partitionBy("node").orderBy(F.coalesce("known", F.lit(0)), F.desc("score"), "other"))
    back = pairs.join(known, "other", "left").withColumn("_k", place).where(F.col("_k") <= degree)
    heard = back.groupBy("node").agg(F.collect_list("other").alias("heard"))
    both = F.array_union("other", F.coalesce("heard", F.expr("cast(array() as array<bigint>)")))
    return graph.select(F.col("id").alias("node"), "links.other").join(heard, "node", "left").select("node", both.alias("other"))


def _steps(batches: Iterator[pa.RecordBatch], beam: int, kind: type) -> Iterator[pa.RecordBatch]:
    """The nearest nodes a query has met, and which of them it opens next.

    A query's group holds its own vector first, then by node what it met: with a score if it was met before, else a vector.
    """

    def solve(table: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        query, node = table["query"].to_numpy(), table["node"].to_numpy()
        score = table["score"].to_numpy(zero_copy_only=False).astype(float)
        opened = table["opened"].to_numpy(zero_copy_only=False).astype(bool)
        vec = V.bytes_matrix(V.plain(table, "vec"), kind).astype(float)
        owner = np.repeat(first, np.diff(np.append(first, len(query))))
        score = np.where(np.isnan(score), np.einsum("ij,ij->i", vec, vec[owner]), score)
        # of equal nodes the first counts: opened ones are sorted before
        rest = np.ones(len(query), bool)
        rest[first] = False
        rest[1:] &= (query[1:] != query[:-1]) | (node[1:] != node[:-1])
        at = np.flatnonzero(rest)
        at = at[np.lexsort((node[at], -score[at], query[at]))]
        rank = np.arange(len(at)) - np.searchsorted(query[at], query[at])
        at = at[rank < beam]
        closed = np.flatnonzero(~opened[at])
        turn = np.arange(len(closed)) - np.searchsorted(query[at][closed], query[at][closed])
        opens = np.zeros(len(at), bool)
        opens[closed[turn < OPEN]] = True
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (query[at], node[at], score[at], opened[at] | opens, opens)],
            names=["query", "node", "score", "opened", "opens"],
        )

    yield from V.whole_groups(batches, ["query"], solve)


def _pivot_starts(batches: Iterator[pa.RecordBatch], ids: np.ndarray, vec: np.ndarray, k: int, kind: type) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = V.bytes_matrix(batch.column(1), kind).astype(float) @ vec.T
        best = _best(score, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), best.shape[1])), pa.array(ids[best].reshape(-1))],
            names=["query", "node"],
        )


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = V.matrix(batch.column(2)), V.matrix(batch.column(3))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array((a * b).sum(axis=1))], names=["query_id", "node", "score"])


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    stored: Stored,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    degree: int = DEGREE,
    beam: int | None = None,
    steps: int = STEPS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest rows found, by inner product in double precision.

    A query's own row (same id) is no candidate; ties go to the smaller id; all candidates come if they are no more than
    ``k``. In ``vectors`` and ``queries``, vectors that are null, empty, zero, of another length than most, or hold null or
    non-finite components take no part, nor do rows without id; a repeated id is its greatest vector. Other columns are not
    read. Every row is in the graph; the pivots are the only sample, of ``PIVOTS`` rows. ``beam`` grows with the logarithm of
    the rows unless given. It is an error if ``steps`` steps do not end the search.
    """
    result = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    usable = stored.put(V.usable_vectors(vectors, id_col, vec_col))
    asked = V.usable_vectors(queries, id_col, vec_col)
    dims = usable.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if not dims:
        return spark.createDataFrame([], result)
    rows, dim = dims["count"], dims["d"]
    alike = usable.where(F.size("vec") == dim).withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(2), "vec")})
    place = F.row_number().over(W.partitionBy("k1", "k2").orderBy("id"))
    # of equal vectors, k + 1 are enough: a query may be one of them
    copies = stored.put(alike.withColumn("place", place).where(F.col("place") <= k + 1))
    firsts = copies.where("place = 1").select(F.col("id").alias("node"), "k1", "k2", "vec")
    members = stored.put(copies.join(firsts.select("node", "k1", "k2"), ["k1", "k2"]).select("node", "id"))
    originals = stored.put(firsts.select("node", "vec"))
    asked = stored.put(asked.where(F.size("vec") == dim).withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(2), "vec")}))
    size = F.aggregate("vec", F.lit(0.0), lambda n, x: n + x * x)
    longest = float(originals.agg(F.max(size)).first()[0]) ** 0.5
    beam = beam or max(BEAM, 2 * k, round(BEAM / 4 * np.log2(rows / 1024)))
    narrow = F.forall("vec", lambda x: x == x.cast("float").cast("double"))
    kind = np.float64 if originals.select("vec").unionByName(asked.select("vec")).where(~narrow).head(1) else np.float32
    nodes = stored.put(originals.mapInArrow(lambda it: _encode(it, longest, kind), "id long, vec binary"))
    graph = neighbour_graph(nodes, stored, rows, degree, kind)
    ways = stored.put(_ways(graph, degree))
    coded = stored.put(asked.select("id", "vec").mapInArrow(lambda it: _encode_queries(it, kind), "query long, vec binary"))
    pivot_rows = nodes.orderBy(F.xxhash64("id", F.lit(37)), "id").limit(PIVOTS).collect()
    pivot_ids = np.array([r["id"] for r in pivot_rows], np.int64)
    pivot_vec = np.stack([np.frombuffer(r["vec"], kind) for r in pivot_rows]).astype(float)
    starts = coded.mapInArrow(lambda it: _pivot_starts(it, pivot_ids, pivot_vec, OPEN, kind), "query long, node long")
    own = asked.select(F.col("id").alias("query"), "k1", "k2").join(firsts.select("node", "k1", "k2"), ["k1", "k2"]).select("query", "node")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    score, unopened = F.lit(None).cast("double").alias("score"), F.lit(False).alias("opened")
    heads = coded.select("query", F.lit(-(1 << 63)).cast("long").alias("node"), score, unopened, "vec")
    blank = F.lit(bytes((dim + 1) * np.dtype(kind).itemsize)).alias("vec")
    met, state = starts.unionByName(own).distinct(), None
    for _ in range(steps):
        rows_ = heads.unionByName(
            met.join(graph.select(F.col("id").alias("node"), "vec"), "node").select("query", "node", score, unopened, "vec")
        )
        if state is not None:
            rows_ = rows_.unionByName(state.select("query", "node", "score", "opened", blank))
        stepped = (
            rows_.repartition(parts, "query")
            .sortWithinPartitions("query", "node", F.col("opened").desc(), F.col("score").desc_nulls_last())
            .mapInArrow(lambda it: _steps(it, beam, kind), "query long, node long, score double, opened boolean, opens boolean")
        )
        before, state = state, stored.put(stepped)
        if before is not None:
            stored.drop(before)
        spark._jvm.System.gc()
        if not state.where("opens").head(1):
            break
        met = (
            state.where("opens")
            .select("query", "node")
            .join(ways, "node")
            .select("query", F.explode("other").alias("node"))
            .distinct()
        )
    else:
        raise RuntimeError(f"the search did not end in {steps} steps")
    pairs = state.select("query", "node").join(originals, "node").withColumnRenamed("vec", "other")
    exact = (
        pairs.join(asked.select(F.col("id").alias("query"), "vec"), "query")
        .select("query", "node", "vec", "other")
        .mapInArrow(_exact, "query_id long, node long, score double")
        .join(members, "node")
        .where("id <> query_id")
    )
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return exact.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
