"""The registered queries: against SQL where it exists, the pipeline against a plain version of its stages."""

from __future__ import annotations

import hashlib
from collections import Counter

import brute
import compare
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from daygrain.llm import langid, lines, mixing, queries
from daygrain.llm.packing import public_vocabulary

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), queries.ORACLE[name]) is None


def test_op5_and_op9_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op5_minhash(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute.near_text(rows, 3, 85, 100)
    spans = brute.repeats([(t or "").encode() for _, t in rows], 400)
    want = {i: (len((t or "").encode()), sum(b - a for a, b in s), len(s)) for (i, t), s in zip(rows, spans, strict=True)}
    got = queries.op9_suffix_array(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got} == want
    kept = {}
    for (i, t), s in zip(rows, spans, strict=True):
        data, ends = (t or "").encode(), [0, *[x for span in s for x in span]]
        kept[i] = b"".join(data[a:b] for a, b in zip(ends[::2], [*ends[1::2], len(data)], strict=True))
    assert {r.doc_id: r.kept_sha256 for r in got} == {i: hashlib.sha256(k).hexdigest() for i, k in kept.items()}
    for r in got:  # only characters that were cut through differ
        try:
            assert r.kept_text == kept[r.doc_id].decode()
        except UnicodeDecodeError:
            assert "\ufffd" in r.kept_text


def test_pipeline_matches_a_plain_version(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    # language: the trees are frozen statistics; each text is scored by dictionaries
    import zlib

    order = {r.doc_id: r.h for r in spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id", "xxhash64(doc_id) h").collect()}

    def sample(held):
        """Texts by language of one of the two parts of the labelled documents."""
        chosen = {}
        for d in docs:
            if d["lang"] is not None and d["text"] is not None and (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1) == held:
                n = len(d["text"].encode())
                chosen.setdefault(d["lang"], []).append((n if n * langid.LONG > langid.SAMPLE_BYTES else 0, order[d["doc_id"]], d["doc_id"], n, d["text"]))
        out = {}
        for lang, rows in chosen.items():
            size, out[lang] = 0, []
            for *_, n, text in sorted(rows)[: langid.SAMPLE_ROWS]:
                if size == 0 or size + n <= langid.SAMPLE_BYTES:
                    out[lang].append(text)
                size += n
        return out

    models = [brute.Ppm(texts, langid.ORDER, langid.LEAST) for _, texts in sorted(sample(False).items())]
    bits = lambda text: min(m.bits(text) for m in models)
    known = lambda text: any(c.isalpha() for c in text or "")
    rates = [bits(t) / len(t.encode()) for texts in sample(True).values() for t in texts if known(t)]
    limit = np.quantile(rates, langid.QUANTILE) * langid.MARGIN

    def stays(text):
        return known(text) and bits(text) <= limit * len(text.encode()) + langid.SLACK_BITS

    short = [d for d in docs if stays(d["text"])]
    new = brute.without_shared_lines([(d["text"], d["source"]) for d in short], lines.MIN_SITES, True)
    texts = [(d["doc_id"], t, d["source"]) for d, t in zip(short, new, strict=True)]
    kept = {i for i, _, _, keep in brute.near_text([t[:2] for t in texts], 5, 80, 100) if keep}
    texts = [t for t in texts if t[0] in kept]
    _, copies = brute.mixture([(i, len((t or "").split()), s) for i, t, s in texts], mixing.WEIGHTS, mixing.LIMIT)
    tokenizer = Tokenizer.from_file(public_vocabulary())
    want = Counter()
    for (i, t, _), c in zip(texts, copies, strict=True):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), 1024):
            part = ids[start : start + 1024]
            want[(i, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += c
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == +want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
