import random

import brute
import cases
import numpy as np
import pytest

from daygrain.llm import suffixes as S


def _texts():
    rng, texts = random.Random(1), []
    pool = ["".join(rng.choice("abcd") for _ in range(150)) for _ in range(4)]
    for _ in range(60):
        parts = ["".join(rng.choice("abcd") for _ in range(rng.randrange(60))), rng.choice(pool)[rng.randrange(60) :]]
        texts.append("".join(parts + ["".join(rng.choice("ab") for _ in range(rng.randrange(40)))]))
    texts += ["a" * 400, "a" * 39, "ab" * 100, "é" * 60, texts[0], texts[1] + texts[2], pool[0] * 3]
    return texts


@pytest.mark.parametrize(("length", "hot"), [(40, 20_000), (40, 2), (41, 20_000), (400, 20_000)])
def test_matches_brute_force(spark, monkeypatch, length, hot):
    monkeypatch.setattr(S, "HOT_GROUP", hot)
    rows = [(r[0], r[1]) for r in cases.edge_rows()] if length == 400 else list(enumerate(_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.remove_repeats(docs, cases.stored(spark), length=length).collect()
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), t, spans in zip(rows, texts, brute.repeats(texts, length), strict=True):
        edges = [0, *(x for s in spans for x in s), len(t)]
        want.append((i, len(t), tuple(spans), b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))))
    assert sorted(((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert S.remove_repeats(cases.empty_docs(spark), cases.stored(spark)).count() == 0


def test_sorted_order_and_extensions():
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 99, (300, 30)).astype(np.uint8)
    sizes = rng.integers(1, 31, 300)
    group = np.sort(rng.integers(0, 20, 300))
    for i, n in enumerate(sizes):
        rows[i, n:] = 0
    found = S.Extensions(rows, sizes, group, 5)
    text = [(g, bytes(r[:n])) for g, r, n in zip(group, rows, sizes, strict=True)]
    assert [text[i] for i in found.order] == sorted(text)
    longest, partner = found.nearest()
    for i in range(300):
        others = [j for j in range(300) if j != i and group[j] == group[i]]
        common = lambda j: next((k for k in range(31) if k == min(sizes[i], sizes[j]) or rows[i, k] != rows[j, k]), 0)  # noqa: B023, E731
        assert longest[i] == max(map(common, others), default=0)
        assert not others or common(partner[i]) == longest[i]
