from collections import Counter

import brute
import cases
import pytest

from daygrain.llm import lines, mixing


@pytest.mark.parametrize(("min_sites", "spare_whole"), [(2, False), (3, False), (2, True)])
def test_shared_lines_match_brute_force(spark, min_sites, spare_whole):
    docs = cases.edge_docs(spark)
    got = lines.remove_shared_lines(docs, cases.stored(spark), min_sites=min_sites, spare_whole=spare_whole)
    rows = cases.edge_rows()
    new = brute.without_shared_lines([(r[1], r[3]) for r in rows], min_sites, spare_whole)
    want = Counter((r[0], t, *r[2:]) for r, t in zip(rows, new, strict=True))
    assert Counter(tuple(r.row) for r in got.collect()) == want


def test_counts_near_the_limit_are_exact(spark):
    rows = [(i, f"line {k}\nown {i}", f"site{i % (95 + k)}") for k in range(10) for i in range(k * 1000, k * 1000 + 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lines.remove_shared_lines(docs, cases.stored(spark), min_sites=100)
    new = brute.without_shared_lines([(r[1], r[2]) for r in rows], 100)
    assert sorted((r.row.doc_id, r.row.text) for r in got.collect()) == sorted(zip([r[0] for r in rows], new, strict=True))


def test_mixture_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    docs = cases.edge_docs(spark)
    got = mixing.mix(docs, cases.stored(spark)).collect()
    rows = [(r[0], sum(1 for _ in __import__("re").findall("[^\x20\x09-\x0d]+", r[1] or "")), r[3]) for r in cases.edge_rows()]
    target, copies = brute.mixture(rows, mixing.WEIGHTS, mixing.LIMIT)
    want = Counter((i, n, s, n * c) for (i, n, s), c in zip(rows, copies, strict=True))
    assert Counter((r.doc_id, r.size, r.source, r.taken) for r in got) == want
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 3 * r.size
        assert len(r.positions) == r.copies and all(0 <= p < 1 for p in r.positions)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    largest = max(n for _, n, _ in rows)
    assert all(abs(taken[s] - t) <= largest for s, t in target.items())


def test_curriculum_order_and_columns(spark):
    docs = cases.edge_docs(spark)
    got = mixing.curriculum(docs, cases.stored(spark))
    assert got.columns == docs.columns
    rows = [(r[0], len((r[1] or "").split()), r[3]) for r in cases.edge_rows()]
    _, copies = brute.mixture(rows, mixing.WEIGHTS, mixing.LIMIT)
    want = Counter()
    for r, c in zip(cases.edge_rows(), copies, strict=True):
        want[(r[0], r[1])] += c
    found = Counter((r.doc_id, r.text) for r in got.collect())
    assert found == +want or found.total() == want.total()


def test_places_follow_the_positions(spark):
    docs = cases.edge_docs(spark)
    got = mixing.sorted_mix(docs, cases.stored(spark)).collect()
    low = lambda x: (x is not None, x)
    turns = sorted(
        ((p, low(r.source), low(r.doc_id), r.size, k) for r in got for k, p in enumerate(r.positions)),
    )
    at = {}
    for n, turn in enumerate(turns):
        at.setdefault(turn, []).append(n)
    for r in got:
        mine = [at[p, low(r.source), low(r.doc_id), r.size, k] for k, p in enumerate(r.positions)]
        assert (r.first_place is None) == (r.copies == 0) and (r.last_place is None) == (r.copies == 0)
        if mine:
            assert r.first_place in mine[0] and r.last_place in mine[-1]
    assert Counter(r.first_place for r in got if r.copies).most_common(1)[0][1] == 1
    again = mixing.sorted_mix(docs.repartition(5), cases.stored(spark)).collect()
    tell = lambda rows: Counter((r.doc_id, r.source, r.size, r.first_place, r.last_place) for r in rows)
    assert tell(again) == tell(got)
    assert mixing.sorted_mix(cases.empty_docs(spark), cases.stored(spark)).count() == 0


def test_heavy_sources_come_later(spark):
    rows = [(i, "w " * 10, f"s{i % 3}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = [r.source for r in mixing.curriculum(docs, cases.stored(spark)).collect()]
    half = len(order) // 2
    assert order[:half].count("s0") > order[half:].count("s0") and order[:half].count("s2") < order[half:].count("s2")


def test_empty_tables(spark):
    assert mixing.mix(cases.empty_docs(spark), cases.stored(spark)).count() == 0
    assert mixing.curriculum(cases.empty_docs(spark), cases.stored(spark)).count() == 0
    assert lines.remove_shared_lines(cases.empty_docs(spark), cases.stored(spark)).count() == 0


def test_pages_of_boilerplate_lose_their_shared_lines(spark):
    shared = [f"shared line {k}" for k in range(8)]
    rows = [(i, "\n".join([*shared, f"own {i}"]) if i < 60 else "\n".join(shared), f"s{i % 12}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for spare in (False, True):
        got = {r.row.doc_id: r.row.text for r in lines.remove_shared_lines(docs, cases.stored(spark), spare_whole=spare).collect()}
        assert all(got[i] == f"own {i}" for i in range(60))
        assert all(got[i] == ("\n".join(shared) if spare else "") for i in range(60, 80))
