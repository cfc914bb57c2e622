import hashlib

import numpy as np
import pytest

from daygrain.llm import infill as I
from cases import edge_docs, edge_rows, empty_docs


def brute(doc_id, text):
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((a % (len(t) + 1), b % (len(t) + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return (doc_id, len(t), "plain", None, None, t)
    pre, mid, suf = t[:low], t[low:high], t[high:]
    if d % 100 < 20:
        return (doc_id, len(t), "spm", low, high - low, f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, len(t), "psm", low, high - low, f"<P>{pre}<S>{suf}<M>{mid}")


def held(rows):
    return sorted((tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in rows), key=repr)


@pytest.mark.parametrize("segment", [3, 64, I.SEGMENT])
def test_edge_documents(spark, segment):
    odd = ["<P>", "a<S", "S>b<", "x<M>y", "<", "é😀́e" * 400, "𝄞", "\x00\n\r", "<P" * 9]
    rows = [r[:2] for r in edge_rows()] + [(100 + i, odd[i % len(odd)]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as form", "2 as h1").repartition(3)
    made = I.fill_in_middle(docs, segment=segment).withColumn("back", I.restored("output", "form")).collect()
    assert held(made) == sorted((brute(*r) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.back) for r in made), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_no_documents_and_clashing_columns(spark):
    assert I.fill_in_middle(empty_docs(spark)).count() == 0
    assert held(I.fill_in_middle(edge_docs(spark)).collect()) == sorted((brute(*r[:2]) for r in edge_rows()), key=repr)


def test_pieces_of_slices():
    texts = ["", "abc", "é😀x" * 5, "z"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    low, high = np.array([0, 1, 4, 0]), np.array([0, 3, 9, 1])
    got = zip(*(x.to_pylist() for x in I.pieces_of(data, offsets, low, high, segment=4)), strict=True)
    assert list(got) == [(t[:a], t[a:b], t[b:]) for t, a, b in zip(texts, low, high, strict=True)]
