import random
import re

import pytest

from daygrain.llm import decontaminate as D
from cases import edge_docs, edge_rows, empty_docs, prose, stored

ITEMS = "item_id long, text string, doc_id long, words string, m int"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """(id, n_words, covered words, item ids) of every document."""
    out = []
    for doc_id, text in docs:
        have, covered, ids = words(text), set(), set()
        for item_id, item in items:
            want = words(item)
            m = min(len(want), D.WINDOW)
            windows = {tuple(want[i : i + m]) for i in range(len(want) - m + 1)} if m else set()
            for i in range(len(have) - m + 1):
                if tuple(have[i : i + m]) in windows:
                    covered |= set(range(i, i + m))
                    ids.add(item_id)
        out.append((doc_id, len(have), tuple(sorted(covered)), tuple(sorted(ids - {None}))))
    return sorted(out, key=repr)


def found(spark, docs, items):
    table = spark.createDataFrame([(*x, 1, "w", 2) for x in items], ITEMS)
    rows = D.contamination(docs, table, stored(spark)).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    covered = lambda r: tuple(i for s in r.spans for i in range(s.start, s.end))
    return sorted(((r.doc_id, r.n_words, covered(r), tuple(sorted(r["items"]))) for r in rows), key=repr)


def test_edge_documents(spark):
    passage, base = prose(2, 120), prose(1, 300)
    items = [
        (1, passage), (2, " ".join(base.split()[40:60])), (3, " ".join(base.split()[40:60]).upper()), (4, None), (5, ""), (6, "... !"), (7, "one"),
        (8, "One, two"), (9, "shared line here"), (10, " ".join(base.split()[100:109])), (11, " ".join(base.split()[100:106]) + " zz " * 8),
        (12, "日本語 テキスト"), (13, "a" * 3000), (None, " ".join(base.split()[200:215])), (2, "ab " * 30), (14, "x y"),
    ]
    docs = edge_docs(spark)
    assert found(spark, docs, items) == brute([(r[0], r[1]) for r in edge_rows()], items)
    assert found(spark, docs, []) == brute([(r[0], r[1]) for r in edge_rows()], [])
    assert found(spark, empty_docs(spark), items) == []


@pytest.mark.parametrize("size", [1, 2, 5, 6, 7, 9, 10, 11, 30])
def test_every_shared_window_is_found(spark, size):
    rng = random.Random(size)
    text = lambda n: " ".join(rng.choice(["a", "b", "c"]) for _ in range(n))
    items = [(i, text(size)) for i in range(12)]
    docs = [(i, text(rng.randrange(60)) + f" u{i} " + items[i % 12][1] + ". " + text(rng.randrange(40))) for i in range(60)]
    assert found(spark, spark.createDataFrame(docs, "doc_id long, text string"), items) == brute(docs, items)


def test_a_passage_that_items_and_documents_share(spark, monkeypatch):
    monkeypatch.setattr(D, "FILTER_BITS", (6, 7))  # a full filter only lets more through
    passage = prose(5, 25)
    items = [(i, passage + " " + prose(100 + i, 5)) for i in range(150)]
    docs = [(i, prose(i, 10) + " " + (passage if i % 3 else "") + " " + prose(i + 500, 5)) for i in range(200)]
    assert found(spark, spark.createDataFrame(docs, "doc_id long, text string"), items) == brute(docs, items)
