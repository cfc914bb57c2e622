"""Fill-in-the-middle transformation by a pipeline of Arrow kernels.

Texts of a batch are split into units, here code points: an Arrow list of units per text, whose values are slices of the
text's own bytes. The lists are flattened with their parent indices, a unit's ordinal is its place less its parent's first,
and its role (prefix, middle, suffix) follows from the ordinal and the parent's two cuts. Units are filtered by role, lists of them
are rebuilt per parent and joined to three strings per text, and the sentinels are joined between these. Texts longer than
``SEGMENT`` units are several parents with ordinals that go on, so the units in memory are bounded; their pieces are joined once
more per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm import buffers as B

SEGMENT = 200_000  # units of one parent
PLAIN, PSM, SPM = "plain", "psm", "spm"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100


def unit_lists(data: np.ndarray, offsets: np.ndarray, segment: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lists of code points, the text of each list, and the ordinal of its first unit."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(starts, offsets)  # of each text, in units
    counts = np.diff(first)
    lists = np.maximum(-(-counts // segment), 1)
    text = np.repeat(np.arange(len(counts)), lists)
    base = (np.arange(len(text)) - np.repeat(np.cumsum(lists) - lists, lists)) * segment
    edges = np.concatenate((first[:-1][text] + base, first[-1:]))
    bounds = np.append(starts, len(data)).astype(np.int64)
    units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    return pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), units), text, base


def split_by_role(units: pa.Array, base: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each list, as strings: the units before ``low``, before ``high``, and the rest."""
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    begin = units.offsets.to_numpy()[:-1] - units.offsets[0].as_py()
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(pa.array(begin - base), parent))
    inside = [pc.less(ordinal, pc.take(pa.array(x), parent)) for x in (low, high)]
    roles = [inside[0], pc.and_not(inside[1], inside[0]), pc.invert(inside[1])]
    out = []
    for role in roles:
        kept, of = pc.filter(flat, role), pc.filter(parent, role)
        edges = np.searchsorted(of.to_numpy(), np.arange(len(units) + 1))
        rebuilt = pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), kept)
        out.append(pc.binary_join(rebuilt, pa.scalar("", pa.large_string())))
    return out


def pieces_of(data: np.ndarray, offsets: np.ndarray, low: np.ndarray, high: np.ndarray, segment: int = SEGMENT) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, one kernel run per bounded number of units."""
    units, text, base = unit_lists(data, offsets, segment)
    parts: list[list[pa.Array]] = [[], [], []]
    for i, j in B.row_chunks(units.offsets.to_numpy(), segment):
        for held, piece in zip(parts, split_by_role(units.slice(i, j - i), base[i:j], low[text[i:j]], high[text[i:j]]), strict=True):
            held.append(piece)
    edges = pa.array(np.searchsorted(text, np.arange(len(offsets))), pa.int64())
    joined = []
    for held in parts:
        strings = pa.concat_arrays(held) if held else pa.array([], pa.large_string())
        joined.append(pc.binary_join(pa.LargeListArray.from_arrays(edges, strings), pa.scalar("", pa.large_string())))
    return joined


def _transformed(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *carried, low, high, form, text = batch.columns
        data, offsets = B.string_bytes(text)
        for i, j in B.row_chunks(offsets):
            cuts = [c.slice(i, j - i).to_numpy() for c in (low, high)]
            prefix, middle, suffix = pieces_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], *cuts, segment)
            kind = form.slice(i, j - i)
            mark = lambda x: pa.scalar(x, pa.large_string())
            psm = pc.binary_join_element_wise(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle, mark(""))
            spm = pc.binary_join_element_wise(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle, mark(""))
            whole = text.slice(i, j - i).cast(pa.large_string())
            output = pc.if_else(pc.equal(kind, PSM), psm, pc.if_else(pc.equal(kind, SPM), spm, whole))
            length = lambda x: pc.if_else(pc.equal(kind, PLAIN), pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x), pa.int64()))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [*[c.slice(i, j - i) for c in carried], kind, length(prefix), length(middle), output.cast(pa.string())],
                names=[*batch.schema.names[:-4], "form", "prefix_chars", "middle_chars", "output"],
            )


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per document.

    The cuts and the form follow from four 32-bit numbers of the SHA-256 of ``seed:doc_id``, so reruns agree. ``plain`` texts stay as
    they are: a tenth of them, empty ones, and those that hold a sentinel. ``psm`` puts prefix, suffix, middle in this order, ``spm``
    suffix, prefix, middle. Lengths are in code points, null if plain. A null text is empty, a null id like an empty one;
    equal rows are rows of their own. Other columns are not read.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    text = F.coalesce(text_col, F.lit(""))
    marked = F.lit(False)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(sentinel))
    drawn = docs.select(
        F.col(id_col).alias("doc_id"), F.char_length(text).cast("long").alias("n"), text.alias("text"),
        *[h.alias(f"h{k + 1}") for k, h in enumerate(numbers)], marked.alias("marked"),
    )
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    form = (
        F.when((F.col("n") == 0) | F.col("marked") | (F.col("h3") % 100 >= PLAIN_FROM), PLAIN)
        .when(F.col("h4") % 100 < SPM_BELOW, SPM)
        .otherwise(PSM)
    )
    cut = drawn.select("doc_id", "n", F.least(one, two).alias("low"), F.greatest(one, two).alias("high"), form.alias("form"), "text")
    kind = dict(cut.dtypes)["doc_id"]
    return cut.mapInArrow(
        lambda it: _transformed(it, segment),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    head = lambda end: F.substring(F.substring_index(output, end, 1), 4, 2**31 - 1)
    middle = F.substring_index(output, MIDDLE, -1)
    between = lambda start: F.substring_index(F.substring_index(output, MIDDLE, 1), start, -1)
    psm = F.concat(head(SUFFIX), middle, between(SUFFIX))
    spm = F.concat(between(PREFIX), middle, head(PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
