"""Benchmark decontamination by winnowing.

A window is a run of ``WINDOW`` words of a benchmark item, or a whole shorter item. Every ``GRAM`` neighbouring words are hashed,
and of the grams inside a window the least hash is kept: the window's fingerprint. Equal windows have equal fingerprints, so no
shared window can be missed, and neighbouring windows mostly share one, so few need a look. Fingerprints of documents are
joined with those of the items. A hit is extended from the gram to the windows around it, first by a second hash, then word by
word, and windows that touch are one span.

A window that stands in many items is one row with the signature of its set of items. So passages which many items share, in
documents that have them many times, cost one row per document and window, not one per item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm import buffers as B
from daygrain.llm.suffixes import sliding_min
from daygrain.llm.tables import Stored, small

WINDOW = 10
GRAM = 6
#: log2 of the bits of the filter through which fingerprints pass before they leave a Python task; more items fill it, which costs time only.
FILTER_BITS = (12, 23)
_codes, _powers = B.byte_codes(11, lower=True), B.POWERS
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
OTHER_HASH = np.uint64(0xA24BAED4963EE407)

_FOUND = "m int, start int, fingerprint long, whole long, words string"


class Words:
    """The words of a chunk of texts: places, hashes and the text each stands in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = WORD_BYTE[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True  # a word ends with its text
        before = np.concatenate(([False], inside[:-1]))
        self.starts = np.flatnonzero(inside & (~before | first))
        self.ends = np.flatnonzero(before & (~inside | first))
        self.text = data.tobytes().lower()
        size = (self.ends - self.starts).astype(np.uint64)
        self.hashes = B.mix(B.PrefixHash(data, _codes, _powers).of(self.starts, self.ends) + size)
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.row, minlength=len(offsets) - 1)
        self.first = np.cumsum(self.counts) - self.counts

    def of(self, at: int, n: int) -> str:
        """``n`` words from one on, lower-cased, with one space between."""
        spans = zip(self.starts[at : at + n], self.ends[at : at + n], strict=True)
        return b" ".join(self.text[a:b] for a, b in spans).decode()

    def windows(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, fingerprint and second hash of every window of ``m`` words that lies in one text."""
        n = len(self.hashes) - m + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        k = min(GRAM, m)
        least = sliding_min(_grams(self.hashes, k), m - k + 1)
        whole = _grams(self.hashes ^ OTHER_HASH, m)
        at = np.flatnonzero(self.row[:n] == self.row[m - 1 :])
        return at, least[at], whole[at]


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    n = len(hashes) - k + 1
    out = hashes[:n].copy()
    for j in range(1, k):
        out = out * np.uint64(B.BASE) + hashes[j : j + n]
    return B.mix(out)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    data, offsets = B.string_bytes(batch.columns[-1])
    for i, j in B.row_chunks(offsets):
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, _, words in _chunks(batch):
            size = np.minimum(words.counts, WINDOW)
            for m in np.unique(size[size > 0]).tolist():
                at, fingerprint, whole = words.windows(m)
                own = size[words.row[at]] == m
                at, fingerprint, whole = at[own], fingerprint[own], whole[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(words.row[at] + i)), pa.array(np.full(len(at), m, np.int32)),
                        pa.array(fingerprint.view(np.int64)), pa.array(whole.view(np.int64)), pa.array([words.of(a, m) for a in at], pa.string()),
                    ],
                    names=["item_id", "m", "fingerprint", "whole", "words"],
                )


class Filter:
    """Which hashes may be an item's, as bits."""

    def __init__(self, bits: int, places: np.ndarray, words: np.ndarray) -> None:
        self.shift = np.uint64(64 - bits)
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[places] = words

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes >> self.shift
        return (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def _filter(windows: DataFrame, rows: int) -> Filter:
    """Of all fingerprints and second hashes; at most ``2 ** (FILTER_BITS[1] - 6)`` rows of two numbers go to the driver."""
    bits = min(max(int(rows * 32).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    bit = F.explode(F.array(*[F.shiftrightunsigned(c, 64 - bits) for c in ("fingerprint", "whole")])).alias("bit")
    words = (
        windows.select(bit)
        .groupBy(F.shiftright("bit", 6).alias("place"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word"))
        .toPandas()
    )
    return Filter(bits, words["place"].to_numpy(np.int64), words["word"].to_numpy(np.int64).view(np.uint64))


def _found(batches: Iterator[pa.RecordBatch], lengths: list[int], known: Filter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in _chunks(batch):
            parts = []
            for m in lengths:
                at, fingerprint, whole = words.windows(m)
                hit = np.flatnonzero(known.may_hold(fingerprint))
                hit = hit[known.may_hold(whole[hit])]
                parts.append((at[hit], np.full(len(hit), m, np.int32), fingerprint[hit], whole[hit]))
            at, m, fingerprint, whole = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(at, kind="stable")
            at, m = at[order], m[order]
            row = words.row[at]
            offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=j - i)))).astype(np.int32)
            fields = [
                pa.array(m), pa.array((at - words.first[row]).astype(np.int32)), pa.array(fingerprint[order].view(np.int64)),
                pa.array(whole[order].view(np.int64)), pa.array([words.of(a, n) for a, n in zip(at, m, strict=True)], pa.string()),
            ]
            names = [x.split()[0] for x in _FOUND.split(", ")]
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, names))
            carried = [c.slice(i, j - i) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*carried, pa.array(words.counts.astype(np.int64)), found], names=[*batch.schema.names[:-1], "n_words", "found"]
            )


def _spans(windows: Column) -> Column:
    """Maximal runs of (start, end) pairs that overlap or touch, and the words in them."""
    start = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(-1).alias("reach"),
        F.array().cast("array<int>").alias("starts"), F.array().cast("array<int>").alias("ends"),
    )

    def step(run, x):
        fresh = x["start"] > run["reach"]
        known = run["reach"] >= 0
        return F.struct(
            (run["n"] + F.greatest(x["end"] - F.greatest(x["start"], run["reach"]), F.lit(0))).alias("n"),
            F.greatest(run["reach"], x["end"]).alias("reach"),
            F.when(fresh, F.array_append(run["starts"], x["start"])).otherwise(run["starts"]).alias("starts"),
            F.when(fresh & known, F.array_append(run["ends"], run["reach"])).otherwise(run["ends"]).alias("ends"),
        )

    def done(run):
        spans = F.arrays_zip(run["starts"].alias("start"), F.array_append(run["ends"], run["reach"]).alias("end"))
        return F.struct(run["n"].alias("n_hit"), spans.alias("spans"))

    return F.aggregate(F.array_sort(windows), start, step, done)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    stored: Stored,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (array of start and end, in words), items (array of item ids).

    Words are runs of letters, digits and characters beyond ASCII; A-Z counts as a-z. Items of ``WINDOW`` words or more are
    looked for by each of their windows, shorter ones as a whole; items without words are nowhere. ``spans`` are the document's
    words that some window covers. Null texts have no words; an item without an id is looked for but never listed; an id given
    twice is listed once. Each document is a row of its own, also if it repeats an id or has none. Other columns are not read.

    Documents are read once. What leaves the Python tasks is one row per document with its candidate windows; these are
    joined with the items' windows, by broadcast if those are few.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(item_text_col, F.lit("")).alias("text"))
    kind = dict(items.dtypes)["item_id"]
    windows = stored.put(
        items.mapInArrow(_item_windows, f"item_id {kind}, m int, fingerprint long, whole long, words string").distinct()
    )
    key = ["m", "fingerprint", "whole", "words"]
    sets = ["n_ids", "x1", "x2"]  # the signature of the set of items that a window stands in
    signed = stored.put(
        windows.groupBy(*key).agg(
            F.count("item_id").alias("n_ids"),
            F.coalesce(F.bit_xor(F.xxhash64("item_id")), F.lit(0)).alias("x1"),
            F.coalesce(F.bit_xor(F.xxhash64(F.lit(2), "item_id")), F.lit(0)).alias("x2"),
        )
    )
    rows = signed.count()
    lengths = sorted(r["m"] for r in signed.select("m").distinct().collect())
    held = spark.sparkContext.broadcast(_filter(signed, rows))
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("k1"), F.xxhash64(F.lit(2), id_col, text_col).alias("k2"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    kind = dict(texts.dtypes)["doc_id"]
    if lengths:
        out = f"doc_id {kind}, k1 long, k2 long, n_words long, found array<struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>>"
        found = stored.put(texts.mapInArrow(lambda it: _found(it, lengths, held.value), out))
    else:
        n = F.coalesce(F.regexp_count("text", F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")), F.lit(0))
        none = F.array().cast(f"array<struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>>")
        found = stored.put(texts.select("doc_id", "k1", "k2", n.cast("long").alias("n_words"), none.alias("found")))
    doc = ["k1", "k2"]
    candidates = found.where(F.size("found") > 0).select(*doc, F.inline("found"))
    hits = stored.put(candidates.join(small(signed, rows), key).select(*doc, "m", "start", *sets).distinct())
    spans = hits.groupBy(*doc).agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("m")).alias("end"))).alias("windows")
    )
    one = signed.groupBy(*sets).agg(F.min(F.struct(*key)).alias("w")).select(*sets, "w.*")
    listed = stored.put(one.join(windows, key).where(F.col("item_id").isNotNull()).select(*sets, "item_id"))
    named = hits.select(*doc, *sets).distinct().join(small(listed), sets).groupBy(*doc).agg(F.collect_set("item_id").alias("items"))
    told = spans.join(named, doc, "left").select(*doc, _spans(F.col("windows")).alias("s"), "items")
    return found.select("doc_id", *doc, "n_words").join(stored.put(told), doc, "left").select(
        "doc_id", "n_words", F.coalesce("s.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("s.spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast(f"array<{dict(listed.dtypes)['item_id']}>")).alias("items"),
    )
