"""Packing token pieces into sequences of a fixed length by minimum bin slack.

Every document is cut into full windows and one remainder. Only the number of pieces of each length
decides how remainders are combined, so the driver works on that table of at most ``capacity`` rows,
whatever the corpus: it takes the longest length left, finds by subset-sum dynamic programming over a bitset
the multiset of remaining lengths that fills the window closest to its capacity, reads the counts back from
the saved bitsets, and repeats that pattern as often as the counts allow. A piece's rank among those of
its length then names its window and place: ranks come from a range sort, so a length that a
third of all pieces share is spread over many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm import buffers as B
from daygrain.llm.tables import Stored, numbered

CAPACITY = 1024
END = 0
SLOT_BITS = 20  # of the word table's places; it is emptied when half full
SLOTS = 1 << SLOT_BITS
# The byte-to-character map of byte-level vocabularies, and letters and marks of Latin texts.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
BYTE_CHARS = dict(zip(_VISIBLE + _HIDDEN, map(chr, [*_VISIBLE, *range(256, 256 + len(_HIDDEN))]), strict=True))
UNUSUAL = "[^\t-\r -~À-ÖØ-öø-ɏ]"
_codes, _powers = B.byte_codes(7), B.POWERS
SPACE_, LETTER, DIGIT, OTHER = 0, 1, 2, 3
KIND = np.full(256, OTHER, np.uint8)
KIND[[32, *range(9, 14)]] = SPACE_
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
KIND[48:58] = DIGIT


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the words of a byte-level vocabulary start, for texts without unusual characters.

    A word is a run of letters, digits or other marks with one space before it, a clitic such as 's, or
    white space; the last character of white space before a word is apart from the rest.
    """
    n = len(data)
    kind = KIND[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first[n] = True
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= first[:n]
    space = data == 32
    gap = kind == SPACE_
    before_word = np.zeros(n, bool)  # white space right before a word of the same text
    before_word[:-1] = gap[:-1] & ~gap[1:] & ~first[1:n]
    start = change | before_word
    joined = np.zeros(n, bool)
    joined[1:] = space[:-1] & ~gap[1:] & ~first[1:n]
    start &= ~joined
    mark = np.flatnonzero((data == 39) & start)
    if len(mark):
        padded = np.concatenate((data, np.zeros(2, np.uint8)))
        one, two = padded[mark + 1].astype(np.int64), padded[mark + 2]
        room = offsets[np.searchsorted(offsets, mark, side="right")] - mark
        short = np.isin(one, [115, 116, 109, 100]) & (room > 1)
        pair = one * 256 + two
        longer = np.isin(pair, [114 * 256 + 101, 118 * 256 + 101, 108 * 256 + 108]) & (room > 2)
        for found, width in ((mark[short], 2), (mark[longer & ~short], 3)):
            start[found + 1] = False
            after = found + width
            start[after[after < n]] = True
    return np.flatnonzero(start)


class WordTable:
    """Token ids of the words seen by this process, found by their 64-bit hash."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Texts with other characters, or with the string of a special token, are tokenized whole, without the table.
        self.unusual = re.compile("|".join([UNUSUAL, *added]))
        self.clear()

    def clear(self) -> None:
        self.keys, self.index = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(0, np.uint32), 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word, -1 for a new one."""
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            held = self.keys[slot[open_]]
            hit = held == hashes[open_]
            out[open_[hit]] = self.index[slot[open_[hit]]]
            open_ = open_[~hit & (held != 0)]
            slot[open_] = (slot[open_] + 1) & (SLOTS - 1)
        return out

    def _add(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        sizes = np.array([len(x) for x in ids], np.int64)
        base = len(self.pool)
        self.pool = np.concatenate((self.pool, np.array([i for x in ids for i in x], np.uint32)))
        self.at = np.concatenate((self.at, base + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        number = np.arange(self.used, self.used + len(hashes), dtype=np.int32)
        self.used += len(hashes)
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            free = open_[self.keys[slot[open_]] == 0]
            self.keys[slot[free]] = hashes[free]
            self.index[slot[free]] = number[free]
            open_ = open_[self.keys[slot[open_]] != hashes[open_]]
            slot[open_] = (slot[open_] + 1) & (SLOTS - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of usual texts one after another, and their number per text."""
        starts = word_starts(data, offsets)
        ends = np.concatenate((starts[1:], [len(data)])).astype(np.int64)
        sizes = (ends - starts).astype(np.uint64)
        hashes = B.mix(B.PrefixHash(data, _codes, _powers).of(starts, ends) + sizes) | np.uint64(1)
        word = self._find(hashes)
        missing = np.flatnonzero(word < 0)
        if len(missing):
            fresh, where = np.unique(hashes[missing], return_index=True)
            if self.used + len(fresh) > SLOTS // 2:
                self.clear()
                missing = np.arange(len(hashes))
                fresh, where = np.unique(hashes, return_index=True)
            raw, tokenize = data.tobytes().decode("latin-1").translate(BYTE_CHARS), self.tokenizer.model.tokenize
            ids = [[t.id for t in tokenize(raw[starts[w] : ends[w]])] for w in missing[where]]
            self._add(fresh, ids)
            word[missing] = self._find(hashes[missing])
        counts = self.size[word]
        stops = np.cumsum(counts)
        out = np.repeat(self.at[word] - (stops - counts), counts) + np.arange(int(stops[-1]) if len(stops) else 0)
        total = np.concatenate(([0], stops))
        edges = np.searchsorted(starts, offsets)
        return self.pool[out], np.diff(total[edges])


def public_vocabulary() -> str:
    """Where the installed package of public tokenizers has its byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_tables: dict[str, WordTable] = {}


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    table = _tables.get(path) or _tables.setdefault(path, WordTable(path))
    try:
        for batch in batches:
            data, offsets = B.string_bytes(batch.column(1))
            texts = batch.column(1)
            for i, j in B.row_chunks(offsets):
                strings = texts[i:j].to_pylist()
                odd = {k: x for k, x in enumerate(strings) if table.unusual.search(x)}
                if odd:
                    part = pa.array(["" if k in odd else x for k, x in enumerate(strings)], pa.large_string())
                    ids, counts = table.encode(*B.string_bytes(part))
                    lists = np.split(ids, np.cumsum(counts)[:-1])
                    for k, x in odd.items():
                        lists[k] = np.array(table.tokenizer.encode(x, add_special_tokens=False).ids, np.uint32)
                    ids, counts = np.concatenate(lists), np.array([len(x) for x in lists])
                else:
                    ids, counts = table.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids = np.insert(ids, np.cumsum(counts), END).astype("<u4")
                counts = counts + 1
                cuts = -(-counts // capacity)
                row = np.repeat(np.arange(j - i), cuts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * capacity
                length = np.minimum(capacity, counts[row] - start)
                edges = np.zeros(len(row) + 1, np.int32)
                np.cumsum(length * 4, out=edges[1:])
                binary = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + i)), pa.array(start), pa.array(length), binary, pa.array(counts[row])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )
    finally:
        table.clear()  # the process goes on to other tasks, and its memory is theirs


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): each document's tokens, closed by id 0, in windows and a remainder.

    ``ids`` are little-endian unsigned 32-bit integers. A null or empty text has the closing id only. Each row is a
    document of its own, also if it repeats an id or has none. Other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).mapInArrow(
        B.tidy(lambda it: _pieces(it, path, capacity)), f"doc_id {kind}, start long, length long, ids binary, doc_tokens long"
    )


def best_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose sum is the largest up to ``room``.

    Bit s of the bitset says that sum s can be reached. Counts are taken in powers of two, so a length needs
    a logarithmic number of shifts; the saved bitsets give the counts back from the best sum.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            times = min(times, left)
            steps.append((reach, length, times))
            reach |= (reach << (length * times)) & mask
            left, times = left - times, times * 2
    total, used = reach.bit_length() - 1, {}
    for before, length, times in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            used[length] = used.get(length, 0) + times
    return used


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, lengths with their number in one window) until every piece has a place."""
    counts, out = dict(counts), []
    while counts:
        longest = max(counts)
        rest = dict(counts)
        rest[longest] -= 1
        use = best_filling({k: c for k, c in rest.items() if c}, capacity - longest)
        use[longest] = use.get(longest, 0) + 1
        times = min(counts[k] // u for k, u in use.items())
        out.append((times, use))
        for k, u in use.items():
            counts[k] -= u * times
            if not counts[k]:
                del counts[k]
    return out


def pack(pieces: DataFrame, stored: Stored, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with doc_id, start, length) plus ``sequence_id`` and ``offset``.

    Each piece of 1 to ``capacity`` tokens is placed whole; offsets are gapless from 0 in each sequence. Equal
    rows are separate pieces. Broadcast: the histogram of lengths and the places of the patterns, a few
    thousand rows whatever the number of pieces.
    """
    spark = pieces.sparkSession
    ordered = numbered(
        pieces.withColumn("_mix", F.xxhash64("doc_id", "start")), [F.col("length").desc(), "_mix", "doc_id", "start"], stored
    )
    histogram = {r["length"]: r["c"] for r in ordered.groupBy("length").agg(F.count("*").alias("c")).collect()}
    first, at = {}, 0
    for length in sorted(histogram, reverse=True):
        first[length], at = at, at + histogram[length]
    taken, places, window = dict.fromkeys(histogram, 0), [], 0
    for times, use in patterns(histogram, capacity):
        offset = 0
        for length in sorted(use, reverse=True):
            begin = first[length] + taken[length]
            taken[length] += times * use[length]
            places.append((length, begin, begin + times * use[length], use[length], window, offset))
            offset += length * use[length]
        window += times
    schema = "length long, _from long, _to long, _each long, _window long, _offset long"
    table = F.broadcast(spark.createDataFrame(places, schema))
    place = F.col("_n") - F.col("_from")
    return (
        ordered.join(table, "length")
        .where("_n >= _from and _n < _to")
        .withColumns(
            {
                "sequence_id": F.col("_window") + F.floor(place / F.col("_each")),
                "offset": F.col("_offset") + F.pmod(place, F.col("_each")) * F.col("length"),
            }
        )
        .select(*pieces.columns, "sequence_id", "offset")
    )
