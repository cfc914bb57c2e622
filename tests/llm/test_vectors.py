import math

import brute
import cases
import numpy as np
import pytest

from daygrain.llm.near_vectors import near_vectors
from daygrain.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, id int, vec string"


def _rows(n=400, dim=16, copies=60, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    for i in range(copies):  # a dense group around row 0, some of them equal
        x[n - 1 - i] = x[0] + rng.normal(size=dim) * (0.3 if i % 3 else 0.0)
    rows = [(i, [float(v) for v in r], 1, 2, "z") for i, r in enumerate(x)]
    bad = [None, [], [0.0] * dim, [math.nan] + [1.0] * (dim - 1), [math.inf] * dim, [1.0] * (dim - 1), [None] * dim]
    rows += [(n + i, v, None, None, None) for i, v in enumerate(bad)]
    return rows + [(None, rows[0][1], 1, 1, "z"), rows[3]], x


def test_near_vectors_match_brute_force(spark):
    rows, x = _rows()
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), cases.stored(spark), least=0.9).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    root = brute.roots(list(range(len(x))), [tuple(map(int, p)) for p in np.argwhere(links)])
    want = [(r[0], int(links[r[0]].sum()), root[r[0]], root[r[0]] == r[0]) if r[0] is not None and r[0] < len(x) else (r[0], 0, r[0], True) for r in rows]
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == sorted(want, key=repr)


def test_hot_bucket_in_blocks_counts_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr("daygrain.llm.near_vectors.BLOCK", 16)
    test_near_vectors_match_brute_force(spark)


def test_nearest_finds_what_brute_force_finds(spark):
    rows, x = _rows()
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = nearest(vectors, vectors.where("vec_id % 20 = 0"), cases.stored(spark), k=10).collect()
    exact, hits = x.astype(float) @ x.astype(float).T, 0
    for q in range(0, len(x), 20):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        assert all(m[1] != q and abs(m[2] - exact[q, m[1]]) < 1e-9 for m in mine)
        others = [j for j in range(len(x)) if j != q]
        hits += len({m[1] for m in mine} & set(sorted(others, key=lambda j: (-exact[q, j], j))[:10]))
    assert hits >= 0.97 * 10 * len(range(0, len(x), 20))
    assert {r.query_id for r in got} == set(range(0, len(x), 20))


def _recall(spark, x, queries, k=20):
    vectors = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = nearest(vectors, vectors.where(f"vec_id in ({','.join(map(str, queries))})"), cases.stored(spark), k=k).collect()
    exact, hits = x.astype(float) @ x.astype(float).T, 0
    for q in queries:
        mine = {r.vec_id for r in got if r.query_id == q}
        hits += len(mine & set([j for j in np.argsort(-exact[q], kind="stable") if j != q][:k]))
    return hits / (k * len(queries))


def test_nearest_in_a_tight_group(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1800, 16))
    x[:1200] = x[0] + 1e-4 * rng.normal(size=(1200, 16))
    assert _recall(spark, x.astype(np.float32), list(range(0, 1200, 60))) > 0.95


def test_nearest_with_one_very_long_vector(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1800, 16))
    x[7] *= 1e4
    assert _recall(spark, x.astype(np.float32), list(range(0, 1800, 60))) > 0.95


def test_unfinished_graph_or_search_is_an_error(spark, monkeypatch):
    vectors = spark.createDataFrame(_rows()[0], SCHEMA)
    with pytest.raises(RuntimeError, match="search"):
        nearest(vectors, vectors, cases.stored(spark), steps=1)
    monkeypatch.setattr("daygrain.llm.neighbours.ROUNDS", 1)
    with pytest.raises(RuntimeError, match="graph"):
        nearest(vectors, vectors, cases.stored(spark))


def test_fewer_candidates_than_asked_for_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -1.0])], "vec_id long, embedding array<float>")
    got = nearest(few, few, cases.stored(spark), k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 5.0), (0, 2, 2, 1.0), (1, 1, 0, 5.0), (1, 2, 2, 1.0), (2, 1, 0, 1.0), (2, 2, 1, 1.0),
    ]
    none = spark.createDataFrame([], SCHEMA)
    assert nearest(none, none, cases.stored(spark)).count() == 0
    assert near_vectors(none, cases.stored(spark)).count() == 0
    assert near_vectors(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"), cases.stored(spark)).first()[1] == 0
