import random
import re
import zlib
from collections import Counter

import pytest

from daygrain.llm import spelling as S
from cases import empty_docs, stored


def brute_words(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, chars=6, least=5, times=5):
    n = {w: c for w, c in brute_words(docs).items() if len(w) >= chars and c >= least}
    form, count = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        count[w], top = len(others), min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = top if top and n[top] >= times * n[w] else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n[w], count[w], n[form[w]] if form[w] else 0) for w in n)


def got(spark, docs, **options):
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "'w' as word", "'r' as ref").repartition(3)
    rows = S.variants(table, stored(spark), **options).collect()
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in rows)


def documents():
    rng = random.Random(3)
    letters = "abéÿ×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(25)]
    pool = []
    for k, stem in enumerate(stems):
        pool += [stem] * (600 if k % 5 == 0 else 8)
        for _ in range(6):
            i = rng.randrange(len(stem))
            pool += [stem[:i] + rng.choice(["", "b", "bé"]) + stem[i + rng.randrange(2) :]] * rng.choice([1, 6, 40])
    pool += ["letter"] * 700 + ["leter", "lettter", "lettar"] * 100 + ["lettaar"] * 12 + ["aaaaaa", "aaaaaaa", "aaaaaaaa"] * 5
    rng.shuffle(pool)
    docs = [(i, " ".join(pool[i::90]).upper() if i % 2 else ", ".join(pool[i::90])) for i in range(90)]
    return docs + [(None, "Letter letter"), (7, None), (8, ""), (9, "12 _ \n"), docs[0], (docs[1][0], "letter")]


def test_words_and_variants(spark):
    docs = documents()
    counted = S.words(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.word: r.n for r in counted} == dict(brute_words(docs))
    assert len(brute(docs)) > 60
    assert got(spark, docs) == brute(docs)
    assert got(spark, docs, least_chars=1, least_count=1, times=2) == brute(docs, 1, 1, 2)


@pytest.mark.parametrize("size", [3, 4, 5, 6])
def test_words_around_the_limit_of_literal_keys(spark, monkeypatch, size):
    monkeypatch.setattr(S, "LONG", size)
    assert got(spark, documents()) == brute(documents())


def test_very_long_words(spark):
    rng = random.Random(1)
    long_ = "".join(rng.choice("abcdeé") for _ in range(30_000))
    kinds = [(long_, 30), (long_[1:], 5), (long_ + "z", 6), (long_[:9000] + "y" + long_[9001:], 30), (long_[:-2], 9), ("a" * 64, 40), ("a" * 63, 6), ("a" * 65, 5)]
    docs = [(i, w) for i, w in enumerate(w for w, n in kinds for _ in range(n))]
    assert got(spark, docs) == brute(docs)


def test_no_words(spark):
    assert S.variants(empty_docs(spark), stored(spark)).count() == 0
    assert got(spark, [(1, "few words only")]) == []
