import brute
import cases
import numpy as np
import pyarrow as pa
import pytest

from daygrain.llm import buffers, langid

SAMPLES = {"aa": "the cat sat on the mat and the dog ran", "bb": "le chat est sur la table et le chien", "cc": "abab cdcd abab"}


def _trees():
    rows = [(lang, text, n) for lang, text in SAMPLES.items() for n in range(3)]
    grams = []
    for k, lang in enumerate(sorted(SAMPLES)):
        texts = [t for x, t, _ in rows if x == lang]
        data, offsets = buffers.string_bytes(pa.array(texts))
        gram, count = np.unique(langid.gram_codes(data, offsets), return_counts=True)
        grams.append((np.full(len(gram), k), gram, count.astype(float)))
    return langid.Trees(sorted(SAMPLES), *(np.concatenate(x) for x in zip(*grams, strict=True)))


def test_code_lengths_are_those_of_ppm():
    trees = _trees()
    texts = ["the cat", "", "zebra Ünd", "le chat est", "x", "ab" * 50, "the dog est sur abab", "日本"]
    got = trees.code_lengths(*buffers.string_bytes(pa.array(texts)))
    for k, lang in enumerate(sorted(SAMPLES)):
        model = brute.Ppm([SAMPLES[lang]] * 3, langid.ORDER, langid.LEAST)
        assert got[:, k] == pytest.approx([model.bits(t) for t in texts], rel=1e-5)


def test_edge_rows(spark):
    docs = cases.edge_docs(spark)
    trees = langid.train(docs)
    assert trees.languages == ["en", "fr"]
    rows = langid.identify(docs, trees).collect()
    assert len(rows) == docs.count() and rows[0].row.asDict().keys() == set(docs.columns)
    for r in rows:
        known = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == "und") == (not known) and 0 <= r.score <= 1 and (known or r.score == 0)
    kept = langid.in_learned_language(docs, trees)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 10 in ids and 0 not in ids and 6 not in ids


def test_nothing_learned_and_no_rows(spark):
    docs = cases.edge_docs(spark)
    nothing = langid.train(docs.where("false"))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(cases.empty_docs(spark), langid.train(docs)).count() == 0


def test_held_out_accuracy(spark):
    from daygrain.llm.queries import op4_language

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("lang is not null").select("doc_id", "lang")
    joined = op4_language(spark, folder).where("held_out").join(docs, "doc_id").collect()
    assert len(joined) > 100
    assert sum(r.lang == r.lang_pred for r in joined) / len(joined) > 0.97


def test_long_documents_do_not_end_the_sample(spark):
    ids = [r.id for r in spark.range(60).selectExpr("id", "xxhash64(id) h").orderBy("h").collect()]
    text = lambda i: cases.prose(i, 40)
    for sizes in ({0: 20_001}, {1: 20_001}, {0: 30_000, 1: 15_000}):
        rows = [(i, "z" * sizes[k] if k in sizes else text(i), "en") for k, i in enumerate(ids)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        trees = langid.train(docs, size=20_000)
        short = [t for _, t, _ in rows if len(t) * langid.LONG <= 20_000]
        want = brute.Ppm([*short, *("z" * n for n in sizes.values() if sum(map(len, short)) + n <= 20_000)], langid.ORDER, langid.LEAST)
        probe = [text(99), "zzzz", text(ids[5])]
        got = trees.code_lengths(*buffers.string_bytes(pa.array(probe)))[:, 0]
        assert got == pytest.approx([want.bits(t) for t in probe], rel=1e-5)
    # nothing but long texts: the shortest is learned from
    only = spark.createDataFrame([(i, "q" * (30_000 + i), "en") for i in range(3)], "doc_id long, text string, lang string")
    assert langid.train(only, size=20_000).languages == ["en"]


def test_the_sample_is_the_first_of_the_order(spark):
    rows = [(i % 700, cases.prose(i, 3 + i % 90), ["en", "fr", "de"][min(i % 9, 2)]) for i in range(4000)]
    docs = spark.createDataFrame([*rows, (None, "x", "en"), (1, None, "en"), (2, "y", None)], "doc_id long, text string, lang string")
    order = {r.id: r.h for r in spark.range(700).selectExpr("id", "xxhash64(id) h").collect()}
    for count, size in ((400, 100_000), (30, 2_000), (5000, 10**7)):
        got = sorted((r.lang, r.text) for r in langid.sample(docs, rows=count, size=size).collect())
        want = []
        for lang in ("en", "fr", "de"):
            late = lambda t: len(t) if len(t) * langid.LONG > size else 0  # noqa: E731, B023
            own = sorted((late(t), order[i], i, t) for i, t, x in rows if x == lang)[:count]
            at = 0
            for k, (_, _, _, t) in enumerate(own):
                if k == 0 or at + len(t) <= size:
                    want.append((lang, t))
                at += len(t)
        assert got == sorted(want)


def test_texts_in_languages_not_learned_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trees = langid.train(docs.where(~langid.held_out()))
    limit = langid.most_bits(trees, docs.where(langid.held_out()))
    # sentences written for this test, in Finnish, Polish and Hungarian
    other = [
        "Kissa istuu ikkunalla ja katselee ulos, kun lumi sataa hiljaa pihalle. Pöydällä on kahvikuppi ja vanha kirja, jota kukaan ei ole lukenut.",
        "Wczoraj wieczorem poszliśmy nad rzekę, żeby zobaczyć zachód słońca. Dzieci bawiły się w piasku, a pies pływał w chłodnej wodzie.",
        "A kertben álló öreg diófa alatt mindig hűvös van nyáron. Nagymama ott szokott ülni, és közben zöldborsót fejt egy kék tálba.",
    ]
    assert 4 < limit < 10
    table = spark.createDataFrame([(i, t * 4) for i, t in enumerate(other)], "doc_id long, text string")
    assert langid.in_learned_language(table, trees, max_bits=limit).count() == 0
    own = docs.where("lang is not null")
    assert langid.in_learned_language(own, trees, max_bits=limit).count() >= 0.995 * own.count()
    assert langid.most_bits(trees, docs.where("false")) is None


def _many(spark, n):
    """More texts of a language than a sample takes, the last ones of words that no other has."""
    rows = [(i, cases.prose(i, 6) if i < n - 60 else f"zqx{i % 7}kw wqj{i % 5}zx xx{i % 11}yq", "en") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_trees_are_counted_over_all_texts(spark):
    docs, rows = _many(spark, 3 * langid.SAMPLE_ROWS)
    want = brute.Ppm([t for _, t, _ in rows], langid.ORDER, langid.LEAST)
    probe = ["zqx3kw wqj2zx xx4yq", cases.prose(5, 6), "zzqx"]
    for held in (langid.HELD_GRAMS, 50):  # also where a task adds up and sends its counts several times
        langid.HELD_GRAMS, kept = held, langid.HELD_GRAMS
        try:
            got = langid.train(docs).code_lengths(*buffers.string_bytes(pa.array(probe)))[:, 0]
        finally:
            langid.HELD_GRAMS = kept
        assert got == pytest.approx([want.bits(t) for t in probe], rel=1e-5)


def test_the_limit_is_taken_over_all_labelled_texts(spark):
    docs, _ = _many(spark, 3 * langid.SAMPLE_ROWS)
    trees = langid.train(docs.where("doc_id < 500"))
    bits = [r[0] for r in langid.identify(docs, trees, keep=()).where("lang_pred <> 'und'").select("bits_per_byte").collect()]
    assert len(bits) == docs.count()
    assert langid.most_bits(trees, docs) == pytest.approx(np.quantile(bits, langid.QUANTILE) * langid.MARGIN, rel=1e-9)


def test_a_bound_on_the_trees_leaves_every_byte_counted(spark):
    docs, _ = _many(spark, 300)
    full = docs.select("lang", "text").mapInArrow(langid._gram_counts, "lang string, gram long, count long")
    counts = full.groupBy("lang", "gram").agg({"count": "sum"}).withColumnRenamed("sum(count)", "count")
    fewer = langid._fewer(counts, 400).toPandas()
    whole = counts.toPandas()
    assert len(whole) > 400 >= len(fewer)
    last = lambda x: x.groupby(x["gram"] & 0xFF)["count"].sum().to_dict()
    assert last(fewer) == last(whole)
    assert langid._fewer(counts, len(whole)).count() == len(whole)
