from collections import Counter

import brute
import cases
import numpy as np
import pytest

from daygrain.llm import near_text as N

ROWS = [(r[0], r[1]) for r in cases.edge_rows()]


@pytest.mark.parametrize(("width", "num", "den"), [(3, 85, 100), (5, 80, 100), (1, 1, 2)])
def test_matches_brute_force_on_edge_rows(spark, width, num, den):
    rows = [r for r in ROWS if r[0] != 10 or r[1] == ROWS[10][1]]  # one text per id
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = N.near_duplicates(docs, cases.stored(spark), width=width, num=num, den=den).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute.near_text(rows, width, num, den)


def test_group_of_near_copies_that_are_not_all_linked(spark):
    """Chains of edits: neighbours are linked, ends are not, and one bucket holds many of them."""
    rows, text = [], cases.prose(20, 400)
    for i in range(150):
        rows.append((1000 - i, text))
        text = cases.edited(text, i, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = N.near_duplicates(docs, cases.stored(spark), width=3, num=85, den=100).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute.near_text(rows, 3, 85, 100)


def test_one_of_each(spark):
    docs = cases.edge_docs(spark)
    got = N.one_of_each(docs, cases.stored(spark), width=5)
    assert got.columns == docs.columns
    rows = got.collect()
    base = ROWS[10][1]
    with_base = [r.doc_id for r in rows if r.text in (base, base.upper())]
    assert sorted(with_base, key=str) == [10, None]  # one copy, and the row without id
    assert sum(r.text is None for r in rows) == 2
    assert {4, 6, 7, 16, 21} <= {r.doc_id for r in rows} and 5 not in {r.doc_id for r in rows}


def test_empty_table(spark):
    assert N.near_duplicates(cases.empty_docs(spark), cases.stored(spark)).count() == 0
    assert N.one_of_each(cases.empty_docs(spark), cases.stored(spark)).count() == 0


def test_sketches_fill_every_bin_and_estimate_similarity():
    rng = np.random.default_rng(0)
    common, own = rng.integers(0, 1 << 63, 800, dtype=np.uint64), rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.concatenate([common, own[:200]]), np.concatenate([common, own[200:]]), common[:1]]
    sketch = N.similarity_sketches(np.concatenate(sets), np.array([len(s) for s in sets]), 512)
    assert (sketch > 0).all()
    assert abs((sketch[0] == sketch[1]).mean() - 800 / 1200) < 0.08


def test_band_shape_keeps_the_miss_bound():
    for least in (0.5, 0.8, 0.85, 0.95):
        bands, rows = N.band_shape(least)
        assert bands * rows == N.COORDS and (1 - least**rows) ** bands <= N.MISS
