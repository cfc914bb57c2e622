"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

A document's set holds the 64-bit hashes of its distinct word shingles. The sketch has ``coords``
bins. In round i every element is placed in one bin, chosen by hash, with the value (i, hash); a bin
keeps its least value. Once every bin is full the later rounds cannot change anything. After
``coords`` rounds come as many more in which every element goes to bin i, so each bin is sure to
fill. Two sets agree in a bin with the probability of their Jaccard similarity, as concentrated as
with independent hashes, at a cost near one hash per element for sets of ordinary length.

Documents with equal sets are one class and go on as one representative. Representatives that share
a band of coordinates meet in a bucket; no pairs of a bucket are listed. Each bucket first
compares its members with its smallest one. Links make components. A bucket that still holds several
components compares the members outside its largest one with all its members, in blocks. So
every pair of a bucket is either verified on full sets or known to be connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm import buffers as B
from daygrain.llm.graphs import components
from daygrain.llm.tables import Stored, small

COORDS = 120
MISS = 1e-6  # chance that a pair at the limit shares no band
BLOCK = 128  # members in a block of a bucket
SLAB = 4096  # shingles compared at once
SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
WORD_CODES = B.byte_codes(5, lower=True)
_powers = B.POWERS


def band_shape(least: float, coords: int = COORDS, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the most rows a band with which a pair at the limit is missed with at most ``miss``."""
    for rows in range(coords, 0, -1):
        if coords % rows == 0 and (1 - least**rows) ** (coords // rows) <= miss:
            return coords // rows, rows
    return coords, 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted in each row, and their number per row.

    Words are runs of bytes other than space and 0x09-0x0D, with A-Z in lower case. A row with
    1 to ``width - 1`` words has one shingle, its whole sequence.
    """
    n = len(offsets) - 1
    word = ~SPACE[data]
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    fresh = np.zeros(len(data) + 1, bool)  # a word cannot go on from the row before
    fresh[row_starts] = True
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    starts = np.flatnonzero(word & (~before | fresh[:-1]))
    after = np.concatenate((word[1:], [False])) if len(word) else word
    ends = np.flatnonzero(word & (~after | fresh[1:])) + 1
    hashes = B.mix(B.PrefixHash(data, WORD_CODES, _powers).of(starts, ends) + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, offsets)
    words = np.diff(first)
    sizes = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    out = np.zeros(len(hashes), np.uint64)
    whole = len(hashes) - width + 1
    if whole > 0:
        rolled = np.zeros(whole, np.uint64)
        for k in range(width):
            rolled = B.mix(rolled * np.uint64(B.MIX_1) + hashes[k : k + whole])
        out[:whole] = rolled
    for row in np.flatnonzero((words > 0) & (words < width)):
        value = np.zeros(1, np.uint64)
        for k in range(first[row], first[row + 1]):
            value = B.mix(value * np.uint64(B.MIX_2) + hashes[k : k + 1])
        out[first[row]] = value[0]
    keep = np.zeros(len(out), bool)
    for row in np.flatnonzero(sizes):
        part = out[first[row] : first[row] + sizes[row]]
        part.sort()
        kept = keep[first[row] : first[row] + sizes[row]]
        kept[0] = True
        np.not_equal(part[1:], part[:-1], out=kept[1:])
    counts = np.zeros(n, np.int64)
    filled = np.flatnonzero(words)
    if len(filled):
        counts[filled] = np.add.reduceat(keep.astype(np.int64), first[filled])
    return out[keep], counts


def similarity_sketches(values: np.ndarray, counts: np.ndarray, coords: int) -> np.ndarray:
    """The sketch of each set; a row of zeros for an empty one. ``values``: the sets one after another."""
    n = len(counts)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(n * coords, empty, np.uint64)
    element, row = values, np.repeat(np.arange(n), counts)
    for turn in range(2 * coords):
        if not len(element):
            break
        placed = B.mix(element ^ B.mix(np.full(1, turn + 1, np.uint64)))
        value = (np.uint64(turn) << np.uint64(32)) | (placed & np.uint64(0xFFFFFFFF))
        if turn < coords:
            bin_of = (((placed >> np.uint64(32)) * np.uint64(coords)) >> np.uint64(32)).astype(np.int64)
        else:
            bin_of = turn - coords
        np.minimum.at(bins, row * coords + bin_of, value)
        unfilled = (bins.reshape(n, coords) == empty).any(axis=1)
        left = unfilled[row]
        if not left.all():
            element, row = element[left], row[left]
    bins[bins == empty] = 0
    return bins.reshape(n, coords)


def _digests(values: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """Order-free 64-bit digest of each set."""
    out = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))[filled]
        out[filled] = np.add.reduceat(B.mix(values + np.uint64(salt)), starts)
    return out


def _features(batches: Iterator[pa.RecordBatch], width: int, coords: int, bands: int) -> Iterator[pa.RecordBatch]:
    rows = coords // bands
    for batch in batches:
        data, offsets = B.string_bytes(batch.column(1))
        for i, j in B.row_chunks(offsets):
            values, counts = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
            sketch = similarity_sketches(values, counts, coords).reshape(j - i, bands, rows)
            key = np.broadcast_to(B.mix(np.arange(1, bands + 1, dtype=np.uint64)), (j - i, bands)).copy()
            for r in range(rows):
                key = B.mix(key * np.uint64(B.MIX_1) + sketch[:, :, r])
            # a group of equal sets needs its bands once, in the row that stands for it
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[i:j],
                    batch.column(2)[i:j],
                    pa.array(counts),
                    pa.array(_digests(values, counts, 1).astype(np.int64)),
                    pa.array(_digests(values, counts, 2).astype(np.int64)),
                    B.long_lists(key.reshape(-1), np.full(j - i, bands)),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set_1", "set_2", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = B.string_bytes(batch.column(1))
        for i, j in B.row_chunks(offsets):
            values, counts = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[i:j], B.long_lists(values, counts)], names=["node", "shingles"]
            )


def _block_links(group: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links of a block's members outside the main component with the members of another block.

    Returns a spanning forest of the links between different components: at most one row a member.
    """
    sets = [np.asarray(x) for x in group.pop("shingles")]
    n, sizes = len(sets), np.array([len(x) for x in sets])
    values, row = np.concatenate(sets), np.repeat(np.arange(n, dtype=np.int32), sizes)
    del sets
    order = np.argsort(values)
    values, row = values[order], row[order]
    del order
    # equal shingles are one column of the incidence matrix, of which a slab is filled at a time
    column = np.zeros(len(values), np.int32)
    np.cumsum(values[1:] != values[:-1], out=column[1:], dtype=np.int32)
    del values
    left = np.flatnonzero(group["asks"].to_numpy())
    shared = np.zeros((len(left), n), np.float32)
    for start in range(0, int(column[-1]) + 1, SLAB):
        i, j = np.searchsorted(column, [start, start + SLAB])
        dense = np.zeros((n, SLAB), np.float32)
        dense[row[i:j], column[i:j] - start] = 1
        shared += dense[left] @ dense.T
    both = np.rint(shared).astype(np.int64)
    linked = den * both >= num * (sizes[left][:, None] + sizes[None, :] - both)
    root = {x: x for x in group["label"]}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    node, label, out = group["node"].to_numpy(), group["label"].to_numpy(), []
    for x, y in np.argwhere(linked & (label[left][:, None] != label[None, :])):
        p, q = find(label[left[x]]), find(label[y])
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((node[left[x]], node[y]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _linked(both: Column, a: Column, b: Column, num: int, den: int) -> Column:
    return F.lit(den) * both >= F.lit(num) * (a + b - both)


def near_duplicates(
    docs: DataFrame,
    stored: Stored,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    num: int = 80,
    den: int = 100,
    coords: int = COORDS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash`` (XXH64 of its text), ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when ``den * |intersection| >= num * |union|`` of their sets of ``width``-word
    shingles. ``component_id`` is the smallest id reachable by links, ``kept`` tells whether that is the
    document itself. Null and wordless texts have an empty set and are linked with nothing. A row
    without id takes no part: its component is null and it is kept. Rows that repeat an id are judged
    by their own texts, each as a document of that id. Columns besides id and text are not read.

    The bands are set so that a pair at the limit is missed with a chance of ``MISS`` at most. Memory: a
    task holds one chunk of rows, or one block pair of 256 sets.
    """
    bands, _ = band_shape(num / den, coords)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), F.xxhash64(text_col).alias("text_hash")
    )
    feats = stored.put(
        texts.mapInArrow(
            B.tidy(lambda it: _features(it, width, coords, bands)),
            "doc_id long, text_hash long, n_shingles long, set_1 long, set_2 long, bands array<long>",
        )
    )
    usable = feats.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "set_1", "set_2"]
    repeated = usable.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")).where("c > 1").drop("c")
    members = stored.put(
        usable.join(repeated, same, "left")
        .withColumn("node", F.coalesce("rep", "doc_id"))
        .select("doc_id", "text_hash", "n_shingles", "node", F.when(F.col("doc_id") == F.col("node"), F.col("bands")).alias("bands"))
    )
    banded = members.where("bands is not null").select("node", F.explode("bands").alias("bucket"))
    shared = (
        banded.groupBy("bucket")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count("*").alias("size"))
        .where("pivot < last")
    )
    met = stored.put(banded.join(shared, "bucket").select("bucket", "pivot", "size", "node"))
    wanted = stored.put(met.select("node").distinct())
    one_text = texts.join(small(wanted.withColumnRenamed("node", "doc_id")), "doc_id", "left_semi")
    sets = stored.put(one_text.mapInArrow(B.tidy(lambda it: _sets(it, width)), "node long, shingles array<long>"))

    pairs = met.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    both = F.size(F.array_intersect("s", "t")).cast("long")
    first = stored.put(
        pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("t")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a")
        .select("a", "b", both.alias("both"), F.size("s").cast("long").alias("na"), F.size("t").cast("long").alias("nb"))
        .where(_linked(F.col("both"), F.col("na"), F.col("nb"), num, den))
        .select("a", "b")
    )
    roots = components(first, stored)
    labelled = met.where("size > 2").join(roots, "node", "left").withColumn("label", F.coalesce("root", "node"))
    by_label = labelled.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    mixed = stored.put(  # stored, so that the join below can split a bucket with many members
        by_label.groupBy("bucket")
        .agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("all"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("bucket", "all", F.col("top.label").alias("main"), (F.col("all") - F.col("top.c")).alias("others"))
    )
    placed = stored.put(
        labelled.select("bucket", "node", "label")
        .join(mixed, "bucket")
        .withColumns(
            {
                "rows_in": F.ceil(F.col("others") / BLOCK).cast("int"),
                "cols_in": F.ceil(F.col("all") / BLOCK).cast("int"),
                "at": F.pmod(F.xxhash64("node"), F.lit(1 << 30)),
            }
        )
    )
    asking = placed.where("label <> main").select(
        "bucket", "node", "label", F.lit(True).alias("asks"), F.expr("at % rows_in").alias("i"),
        F.explode(F.expr("sequence(0, cols_in - 1)")).alias("j"),
    )
    asked = placed.select(
        "bucket", "node", "label", F.lit(False).alias("asks"),
        F.explode(F.expr("sequence(0, rows_in - 1)")).alias("i"), F.expr("at % cols_in").alias("j"),
    )
    cells = asking.select("bucket", "node", "label", "asks", F.col("i").cast("long"), F.col("j").cast("long")).unionByName(
        asked.select("bucket", "node", "label", "asks", F.col("i").cast("long"), F.col("j").cast("long"))
    )
    second = (
        cells.join(sets, "node")
        .groupBy("bucket", "i", "j")
        .applyInPandas(lambda g: _block_links(g, num, den), "a long, b long")
    )
    rooted = components(first.unionByName(second), stored)
    found = members.join(small(rooted), "node", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("root", "node").alias("component_id")
    )
    rest = feats.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return found.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(
    docs: DataFrame, stored: Stored, id_col: str = "doc_id", text_col: str = "text", **options: int
) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near-duplicates; ``options`` as above.

    The document with the smallest id stays; of rows that repeat that id, one. Rows without words or id stay.
    """
    groups = stored.put(near_duplicates(docs, stored, id_col, text_col, **options))
    kept = groups.where("kept and doc_id is not null and n_shingles > 0")
    repeated = stored.put(
        kept.groupBy("doc_id").agg(F.min("text_hash").alias("stays"), F.count("*").alias("c")).where("c > 1")
    )
    gone = groups.where(~F.col("kept")).select("doc_id", "text_hash")
    n = repeated.count()
    if n:
        others = kept.join(repeated, "doc_id").where("text_hash <> stays")
        gone = gone.unionByName(others.select("doc_id", "text_hash"))
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
    )
    rows = named.join(small(stored.put(gone.distinct())), ["doc_id", "text_hash"], "left_anti")
    if n:
        twice = small(repeated.select("doc_id", F.col("stays").alias("text_hash")), n)
        once = rows.join(twice, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
        rows = rows.join(twice, ["doc_id", "text_hash"], "left_anti").unionByName(once)
    return rows.select("row.*")
