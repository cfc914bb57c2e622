import itertools
from collections import Counter

import cases
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daygrain.llm import packing as P

ODD = [
    "it's we're I'll 'tis ''s x'd,'s\n's  foo   bar\n\n baz \t", "a", " ", "  ", "é's × ÷ ²", "don'ttt o'clock 'll'll \r\n", "12ab34 __x_y  ",
    "'", "'s", "a'", " 's", "x　y “q” it’s", "a  \nb\n", "tail '", "<|endoftext|> <|endoftext|>", "words before<|endoftext|>and after", "\x1c\x1d x", "a b \x85c", "😀 ok",
]


def test_round_trip_and_layout(spark):
    rows = [(r[0], r[1]) for r in cases.edge_rows()] + list(enumerate(ODD, 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokenizer = Tokenizer.from_file(P.public_vocabulary())
    pieces = P.token_pieces(docs, P.public_vocabulary(), capacity=64)
    got = P.pack(pieces, cases.stored(spark), capacity=64).collect()
    want = Counter((i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 0) for i, t in rows)
    # rows that repeat an id are told apart by their number of tokens
    texts = {}
    for r in got:
        texts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    found = Counter()
    for (i, n), parts in texts.items():
        parts.sort(key=lambda p: p[0])
        copies = sum(len(x) for _, x in parts) // n
        for k in range(copies):
            found[(i, *itertools.chain(*(x for _, x in parts[k::copies])))] += 1
    assert found == want
    sequences = {}
    for r in got:
        assert r.length == len(r.ids) // 4
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= sum(r.length for r in got) / 64 * 1.1 + 2


def test_empty_table(spark):
    assert P.pack(P.token_pieces(cases.empty_docs(spark), P.public_vocabulary()), cases.stored(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9), st.integers(0, 40))
def test_best_filling_is_the_largest_sum(lengths, room):
    used = P.best_filling(dict(Counter(lengths)), room)
    assert all(n <= lengths.count(k) for k, n in used.items())
    sums = {sum(c) for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n)}
    assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_patterns_use_every_piece_once(lengths):
    used = Counter()
    for times, use in P.patterns(dict(Counter(lengths)), 64):
        assert sum(k * n for k, n in use.items()) <= 64
        for k, n in use.items():
            used[k] += times * n
    assert used == Counter(lengths)


def test_crc_is_of_the_ids(spark):
    import zlib

    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    r = P.token_pieces(docs, P.public_vocabulary()).withColumn("c", F.crc32("ids")).first()
    assert r.c == zlib.crc32(bytes(r.ids))
