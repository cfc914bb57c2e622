"""Repeated byte strings: sparse suffix sort with hash-compared suffixes.

A byte is removed when a string of ``length`` bytes that covers it also starts anywhere else. Half of that
length is the anchor size: in every run of ``length`` bytes the anchors with the least hash are chosen, from
the run's bytes alone, so equal runs have equal anchors at equal places. Anchors that occur once
end there. The suffixes at the others are sorted, group by group of equal anchors, by a mergesort whose
comparisons find the common extension by binary search over prefix polynomial hashes and then look at
one byte. Neighbours in that order give each suffix its longest common extension to the right; the same
sort of the reversed bytes before the anchors gives it to the left. Neighbours' extensions are
verified byte by byte, and a collision repeats the sort with other hash codes. If one partner has both
extensions, the repeated starts are known; else the starts in question are compared one by one.

Texts with equal bytes are one text with a count. Suffixes with equal surroundings are one suffix with
a count, so copies add no work. Anchors with more than ``HOT_GROUP`` different surroundings are not
sorted in one task: their runs are counted by hash instead, one row per start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm import buffers as B
from daygrain.llm.tables import Stored, small

HOT_GROUP = 20_000
SORT_ROWS = 4_000  # suffixes sorted together, whole groups
ANCHOR_CODES = B.byte_codes(9)
_powers = B.POWERS


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    n = len(x) - width + 1
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.full(-(-len(x) // width) * width, top, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(place, row, anchor hash, hash of the surroundings) of each anchor in rows of ``length`` bytes or more."""
    half = length // 2
    spread = length - half + 1
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    prefix = B.PrefixHash(data, ANCHOR_CODES, _powers)
    gram = B.mix(prefix.width(half)) | np.uint64(1)
    least = sliding_min(gram, spread)
    row = B.row_of(offsets)
    least[row[: len(least)] != row[length - 1 : length - 1 + len(least)]] = 0
    lead = np.zeros(spread - 1, np.uint64)
    most = ~sliding_min(~np.concatenate((lead, least, lead)), spread)
    at = np.flatnonzero(gram == most[: len(gram)])
    before = np.minimum(half, at - offsets[row[at]])
    after = np.minimum(length, offsets[row[at] + 1] - at)
    around = prefix.of(at - before, at + after)
    around = B.mix(around + B.mix((before * (2 * length) + after).astype(np.uint64)))
    return at, row[at], gram[at], around


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = B.string_bytes(batch.column(2))
        for i, j in B.row_chunks(offsets):
            at, row, gram, around = anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length)
            take = pa.array(row + i)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array((at - offsets[i : j + 1][row] + offsets[i]).astype(np.int64)),
                    pa.array(gram.view(np.int64)),
                    pa.array(around.view(np.int64)),
                ],
                names=["k1", "k2", "pos", "anchor", "around"],
            )


def _surroundings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """From (text, list of (pos, anchor, around)) the bytes before and after each place."""
    half = length // 2
    for batch in batches:
        data, offsets = B.string_bytes(batch.column(0))
        spots = batch.column(1)
        counts = np.diff(spots.offsets.to_numpy())
        flat = spots.flatten()
        place, anchor, around = (flat.field(k) for k in ("pos", "anchor", "around"))
        row = np.repeat(np.arange(len(counts)), counts)
        at = place.to_numpy() + offsets[row]
        lows, highs = np.maximum(at - half, offsets[row]), np.minimum(at + length, offsets[row + 1])
        raw = data.tobytes()
        for s in range(0, len(at), 5000):
            part = slice(s, s + 5000)
            yield pa.RecordBatch.from_arrays(
                [
                    anchor[part],
                    around[part],
                    pa.array((at - lows)[part].astype(np.int32)),
                    pa.array([raw[a:b] for a, b in zip(lows[part], highs[part], strict=True)], pa.binary()),
                ],
                names=["anchor", "around", "before", "bytes"],
            )


class Extensions:
    """Sorted order and longest common extensions of short byte rows, within groups of neighbouring rows."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, group: np.ndarray, seed: int) -> None:
        self.rows, self.sizes = rows, sizes
        self.starts = np.searchsorted(group, group, side="left")
        self.ends = np.searchsorted(group, group, side="right")
        while True:
            self._hash(seed)
            self.order = self._mergesort()
            self.next = self._next()
            if self._verified():
                return
            seed += 1

    def _hash(self, seed: int) -> None:
        codes = B.byte_codes(seed)
        _powers.upto(self.rows.shape[1])
        self.prefix = np.zeros((len(self.rows), self.rows.shape[1] + 1), np.uint64)
        np.cumsum(codes[self.rows] * _powers.up[: self.rows.shape[1]], axis=1, out=self.prefix[:, 1:])

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension, by binary search over prefix hashes."""
        low = np.zeros(len(x), np.int64)
        high = np.minimum(self.sizes[x], self.sizes[y])
        for _ in range(int(self.rows.shape[1]).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.prefix[x, middle] == self.prefix[y, middle]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def _less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        n = self.common(x, y)
        last = self.rows.shape[1] - 1
        at = np.minimum(n, last)
        inside = (n < self.sizes[x]) & (n < self.sizes[y])
        tie = (self.sizes[x] < self.sizes[y]) | ((self.sizes[x] == self.sizes[y]) & (x < y))
        return np.where(inside, self.rows[x, at] < self.rows[y, at], tie)

    def _mergesort(self) -> np.ndarray:
        """Bottom-up: an element's place in a merged run is its own plus those of the sibling run below it."""
        order = np.arange(len(self.rows))
        level, largest = 0, int((self.ends - self.starts).max(initial=0))
        while (1 << level) < largest:
            active = np.flatnonzero(self.ends - self.starts > (1 << level))
            start, end = self.starts[active], self.ends[active]
            run = (active - start) >> level
            own = start + (run << level)
            other = start + ((run ^ 1) << level)
            low = np.minimum(other, end)
            floor, high = low.copy(), np.minimum(other + (1 << level), end)
            item = order[active]
            for _ in range(level + 1):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                below = self._less(order[middle], item[open_])
                low[open_] = np.where(below, middle + 1, low[open_])
                high[open_] = np.where(below, high[open_], middle)
            place = np.minimum(own, other) + (active - own) + (low - floor)
            merged = order.copy()
            merged[place] = item
            order, level = merged, level + 1
        return order

    def _next(self) -> np.ndarray:
        """Common extension of each sorted row with the one after it; 0 at the end of a group."""
        out = np.zeros(len(self.order), np.int64)
        inner = np.flatnonzero(np.arange(len(out)) + 1 < self.ends)
        out[inner] = self.common(self.order[inner], self.order[inner + 1])
        return out

    def _verified(self) -> bool:
        column = np.arange(self.rows.shape[1])
        for s in range(0, max(len(self.order) - 1, 0), 10_000):
            i = np.arange(s, min(s + 10_000, len(self.order) - 1))
            same = self.rows[self.order[i]] == self.rows[self.order[i + 1]]
            if not (same | (column >= self.next[i][:, None])).all():
                return False
        return True

    def nearest(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row: its longest common extension with another of its group, and a row that has it."""
        before = np.concatenate(([0], self.next[:-1]))
        longest, partner = np.zeros(len(self.order), np.int64), np.arange(len(self.order))
        up = self.next >= before
        place = np.arange(len(self.order))
        inner = self.ends - self.starts > 1
        toward = np.where(up & (place + 1 < self.ends), place + 1, np.where(place > self.starts, place - 1, place + 1))
        toward = np.where(inner, toward, place)
        longest[self.order] = np.maximum(self.next, before)
        partner[self.order] = self.order[toward]
        return longest, partner


def repeated_starts(
    group: np.ndarray, before: np.ndarray, texts: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to): distances before the anchor at which runs start that another row of the group has too."""
    half = length // 2
    n = len(texts)
    right, left = np.zeros((n, length), np.uint8), np.zeros((n, max(half, 1)), np.uint8)
    after = np.zeros(n, np.int64)
    for i, (text, b) in enumerate(zip(texts, before, strict=True)):
        bytes_ = np.frombuffer(text, np.uint8)
        after[i] = len(bytes_) - b
        left[i, :b], right[i, : after[i]] = bytes_[:b][::-1], bytes_[b:]
    before = before.astype(np.int64)
    to_right, to_left = Extensions(right, after, group, 21), Extensions(left, before, group, 43)
    r, with_r = to_right.nearest()
    l, with_l = to_left.nearest()  # noqa: E741
    index = np.arange(n)
    low = np.maximum(length - r, 0)
    by_r, by_l = to_left.common(index, with_r), to_right.common(index, with_l)
    by_r, by_l = np.where(with_r == index, 0, by_r), np.where(with_l == index, 0, by_l)
    some = low <= l
    clear = some & ((by_r == l) | (by_l == r))
    found = [(index[clear], low[clear], l[clear])]
    unclear = np.flatnonzero(some & ~clear)
    if len(unclear):
        rows = np.flatnonzero(np.isin(group, group[unclear]))
        asked = np.zeros(n, bool)
        asked[unclear] = True
        for o in range(half + 1):
            live = rows[(before[rows] >= o) & (after[rows] >= length - o)]
            if len(live) < 2:
                continue
            a, b = to_right.prefix[live, length - o], to_left.prefix[live, o]
            order = np.lexsort((b, a, group[live]))
            g, a, b = group[live][order], a[order], b[order]
            same = (g[1:] == g[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            twice = np.zeros(len(live), bool)
            twice[1:] |= same
            twice[:-1] |= same
            hit = live[order][twice]
            hit = hit[asked[hit]]
            found.append((hit, np.full(len(hit), o), np.full(len(hit), o)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _sorted_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by anchor; whole groups are sorted together."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        group = table["anchor"].to_numpy()
        row, low, high = repeated_starts(group, table["before"].to_numpy(), table["bytes"].to_pylist(), length)
        around = table["around"].to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (group[row], around[row], low, high)],
            names=["anchor", "around", "low", "high"],
        )

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < SORT_ROWS:
            continue
        key = held["anchor"].to_numpy()
        cut = 0
        while held.num_rows - cut >= SORT_ROWS and key[cut + SORT_ROWS - 1] != key[-1]:
            end = int(np.searchsorted(key[cut:], key[cut + SORT_ROWS - 1], side="right")) + cut
            yield solve(held.slice(cut, end - cut))
            cut = end
        held = held.slice(cut)
    if held is not None and held.num_rows:
        yield solve(held)


def _window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row per possible start, with two hashes of its run: for anchors with too many surroundings to sort."""
    half = length // 2
    for batch in batches:
        data, offsets = B.string_bytes(batch.column(3))
        before = batch.column(2).to_numpy()
        row = np.repeat(np.arange(len(before)), half + 1)
        o = np.tile(np.arange(half + 1), len(before))
        start = offsets[row] + before[row] - o
        good = (o <= before[row]) & (start + length <= offsets[row + 1])
        row, o, start = row[good], o[good], start[good]
        hashes = [B.PrefixHash(data, B.byte_codes(k), _powers).of(start, start + length).view(np.int64) for k in (61, 62)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(batch.column(0).to_numpy()[row]), pa.array(batch.column(1).to_numpy()[row]),
                pa.array(o.astype(np.int64)), *map(pa.array, hashes),
            ],
            names=["anchor", "around", "low", "w1", "w2"],
        )


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """From (row fields, text, list of (low, high) starts) the removed spans and the bytes kept."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        ids, texts, runs = batch.column(0), batch.column(1).cast(pa.large_binary()), batch.column(2)
        spans, kept, sizes = [], [], []
        for text, found in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
            merged: list[list[int]] = []
            for low, high in sorted((x["low"], x["high"] + length) for x in found):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            spans.append([{"start": a, "end": b} for a, b in merged])
            edges = [0, *(x for pair in merged for x in pair), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame, stored: Stored, id_col: str = "doc_id", text_col: str = "text", length: int = 400
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``spans`` (maximal removed byte ranges), ``kept`` (bytes).

    A removed byte is covered by a string of ``length`` bytes that also starts elsewhere, in this or another
    document; strings do not cross documents. Null texts count as empty. Rows that repeat an id
    or a text are documents of their own, so a text of ``length`` bytes or more that stands in two rows goes
    whole. Null ids pass through. Other columns are not read.

    Memory: a task holds a chunk of rows, or one group of at most ``HOT_GROUP`` suffixes of 1.5 * ``length`` bytes.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumns(
        {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(2), "text")}
    )
    key = ["k1", "k2"]
    long_ = texts.where(F.octet_length("text") >= length)
    repeated = stored.put(
        long_.select("doc_id", *key)
        .groupBy(*key)
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("c"))
        .where("c > 1")
        .drop("c")
    )
    copies = repeated.count()
    # one row of each text; rows that also share the id are told apart below by their places being equal
    single = long_.join(small(repeated, copies), key, "left").where("first is null or doc_id <=> first")
    marks = stored.put(
        single.select(*key, "text").mapInArrow(
            lambda it: _anchor_rows(it, length), "k1 long, k2 long, pos long, anchor long, around long"
        )
    )
    # stored, so that the join can split an anchor that a third of the texts have
    often = stored.put(marks.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").drop("c"))
    met = stored.put(marks.join(often, "anchor").dropDuplicates(["k1", "k2", "pos"]))
    stored.drop(marks)
    kinds = stored.put(
        met.groupBy("anchor", "around").agg(F.count("*").alias("c"), F.max(F.struct(*key, "pos")).alias("one"))
    )
    width = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    several = kinds.join(width, "anchor")
    spots = several.groupBy("one.k1", "one.k2").agg(
        F.collect_list(F.struct("one.pos", "anchor", "around")).alias("spots")
    )
    wanted = several.select("one.k1", "one.k2").distinct()
    surroundings = stored.put(
        single.join(small(wanted), key, "left_semi")
        .dropDuplicates(key)
        .join(spots, key)
        .select("text", "spots")
        .mapInArrow(lambda it: _surroundings(it, length), "anchor long, around long, before int, bytes binary")
        .join(width, "anchor")
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["anchor", "around", "before", "bytes"]
    sorted_ = (
        surroundings.where(F.col("kinds") <= HOT_GROUP)
        .select(*columns)
        .repartition(parts, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda it: _sorted_groups(it, length), "anchor long, around long, low long, high long")
    )
    windows = (
        surroundings.where(F.col("kinds") > HOT_GROUP)
        .select(*columns)
        .mapInArrow(lambda it: _window_rows(it, length), "anchor long, around long, low long, w1 long, w2 long")
    )
    hash_ = ["anchor", "low", "w1", "w2"]
    counted = windows.groupBy(*hash_).agg(F.count("*").alias("c")).where("c > 1").drop("c")
    hot = windows.join(counted, hash_).select("anchor", "around", "low", F.col("low").alias("high"))
    partly = sorted_.unionByName(hot).groupBy("anchor", "around").agg(
        F.collect_list(F.struct("low", "high")).alias("runs")
    )
    half = length // 2
    judged = kinds.where("c > 1").select("anchor", "around", F.lit(True).alias("all"))
    starts = met.join(judged, ["anchor", "around"], "left").join(partly, ["anchor", "around"], "left")
    runs = stored.put(
        starts.where("all or runs is not null")
        .select(*key, "pos", "all", F.explode(F.when(F.col("all"), F.expr(f"array(struct(0L as low, {half}L as high))")).otherwise(F.col("runs"))).alias("run"))
        .select(*key, (F.col("pos") - F.col("run.high")).alias("low"), (F.col("pos") - F.col("run.low")).alias("high"))
        .groupBy(*key)
        .agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    )
    whole = repeated.select(*key, F.lit(True).alias("whole"))
    part = runs.join(repeated, key, "left_anti").select(*key)
    n_part = part.count()
    marked = texts.join(small(whole, copies), key, "left").join(
        small(part.withColumn("part", F.lit(True)), n_part), key, "left"
    )
    all_gone = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end")))
    plain = marked.where("part is null").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(F.col("whole"), all_gone).otherwise(F.slice(all_gone, 1, 0)).alias("spans"),
        F.when(F.col("whole"), F.lit(b"")).otherwise(F.col("text").cast("binary")).alias("kept"),
    )
    ids = dict(docs.dtypes)[id_col]
    clipped = F.transform(
        "runs",
        lambda x: F.struct(F.greatest(x["low"], F.lit(0)).alias("low"), F.least(x["high"], F.octet_length("text") - length).cast("long").alias("high")),
    )
    cut = (
        marked.where("part")
        .select("doc_id", "text", *key)
        .join(runs, key)
        .select("doc_id", "text", clipped.alias("runs"))
        .mapInArrow(
            lambda it: _cut(it, length),
            f"doc_id {ids}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary",
        )
    )
    return plain.unionByName(cut)
