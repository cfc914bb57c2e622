"""Language identification by prediction by partial matching (PPM) over bytes.

For each language a context tree holds how often each byte followed each context of up to ``ORDER`` bytes in
the labelled texts. Contexts seen fewer than ``LEAST`` times in a language are not in its tree, so the
order varies. A byte seen in the longest context costs its share there; a new one costs the escape probability
and is coded in the next shorter context, down to eight bits for a byte never seen (escape method C, without
exclusions). The statistics are frozen: the cost of a byte depends on it and the ``ORDER`` bytes before
it alone, so costs of whole (context, byte) strings are tabulated once for all languages and a
text's code length under each language is a sum of table rows, over the whole text. The shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.functions.order_stats import exact_percentile_of_table
from daygrain.functions.storage import reliable
from daygrain.llm import buffers as B
from daygrain.llm.tables import small

ORDER = 4
LEAST = 2
SAMPLE_ROWS, SAMPLE_BYTES = 400, 400_000  # of each language, where a sample is asked for
MOST_GRAMS = 1 << 18  # of the trees of all languages: the bound of what the driver collects and a task holds
HELD_GRAMS = 1 << 18  # counted in a task before they are added up
LONG = 20  # texts over this part of the bytes are used only where others do not fill the sample
UNKNOWN = "und"
#: The limit of code lengths: this quantile of bits per byte of labelled texts kept out of the trees, times the margin, and so many bits a text.
QUANTILE, MARGIN, SLACK_BITS = 0.999, 1.25, 256
BUCKETS = 1 << 16  # of the hash by which the sample is found
PAD = 10  # every text is preceded by ORDER line feeds


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ORDER bytes before each byte and the byte itself, as one integer."""
    code = data.astype(np.uint64)
    out = code.copy()
    for k in range(1, ORDER + 1):
        out[k:] |= code[:-k] << np.uint64(8 * k)
    for j in range(ORDER):
        at = offsets[:-1][np.diff(offsets) > j] + j
        held = np.uint64((1 << (8 * (j + 1))) - 1)
        pad = np.uint64(sum(PAD << (8 * k) for k in range(j + 1, ORDER + 1)))
        out[at] = (out[at] & held) | pad
    return out


class Lookup:
    """Row of each key of a sorted table, by open addressing."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slots, self.row = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        slot, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):
            free = open_[self.row[slot[open_]] < 0]
            self.row[slot[free]] = free
            self.slots[slot[free]] = keys[free]
            open_ = open_[self.row[slot[open_]] != open_]
            slot[open_] = (slot[open_] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(B.BASE)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """-1 where a key is not in the table."""
        slot = self._slot(keys)
        out = self.row[slot].astype(np.int64)
        open_ = np.flatnonzero((out >= 0) & (self.slots[slot] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            row = self.row[slot[open_]]
            out[open_] = row
            open_ = open_[(row >= 0) & (self.slots[slot[open_]] != keys[open_])]
        return out


@dataclass
class Level:
    """Contexts of one length: cost of each known (context, byte), and of the escape from each context."""

    grams: Lookup
    cost: np.ndarray
    contexts: Lookup
    escape: np.ndarray


class Trees:
    """The frozen context trees of all languages."""

    def __init__(self, languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray) -> None:
        self.languages, n = languages, len(languages)
        self.levels: list[Level] = []
        for order in range(ORDER + 1):
            keys, where = np.unique(gram & np.uint64((1 << (8 * (order + 1))) - 1), return_inverse=True)
            seen = np.zeros((len(keys), n))
            np.add.at(seen, (where, language), count)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            live = total >= (LEAST if order else 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(live, np.log2(total + kinds) - np.log2(kinds), 0.0)
                direct = np.log2(total + kinds)[of] - np.log2(seen)
            # a byte that no language has seen here is looked up in the next shorter context when a text is scored
            shorter = self.costs(keys, order - 1)
            cost = np.where(live[of] & (seen > 0), direct, escape[of] + shorter)
            self.levels.append(Level(Lookup(keys), cost.astype(np.float32), Lookup(contexts), escape.astype(np.float32)))

    def costs(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits for the last byte of each gram after the ``order`` bytes before it, per language."""
        if order < 0:
            return np.full((len(grams), len(self.languages)), 8.0, np.float32)
        level, keys = self.levels[order], grams & np.uint64((1 << (8 * (order + 1))) - 1)
        row = level.grams.find(keys)
        out = level.cost[row] if len(level.cost) else np.zeros((len(grams), len(self.languages)), np.float32)
        new = np.flatnonzero(row < 0)
        if len(new):
            context = level.contexts.find(keys[new] >> np.uint64(8))
            known = context >= 0
            out[new] = self.costs(keys[new], order - 1)
            out[new[known]] += level.escape[context[known]]
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each whole text under each language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            out[filled] = np.add.reduceat(self.costs(gram_codes(data, offsets)), offsets[filled], axis=0, dtype=np.float64)
        return out


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the grams of each language; those of many texts are added up before they leave the task."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def added(language: str) -> tuple[np.ndarray, np.ndarray]:
        gram, where = np.unique(np.concatenate([g for g, _ in held[language]]), return_inverse=True)
        count = np.zeros(len(gram), np.int64)
        np.add.at(count, where, np.concatenate([c for _, c in held[language]]))
        return gram, count

    def rows(language: str) -> pa.RecordBatch:
        gram, count = added(language)
        names = pa.DictionaryArray.from_arrays(np.zeros(len(gram), np.int32), [language]).cast(pa.string())
        return pa.RecordBatch.from_arrays([names, pa.array(gram.astype(np.int64)), pa.array(count)], names=["lang", "gram", "count"])

    for batch in batches:
        spoken = batch.column(0)
        for language in spoken.unique().to_pylist():
            data, offsets = B.string_bytes(batch.column(1).filter(pc.equal(spoken, language)))
            for i, j in B.row_chunks(offsets):
                codes = gram_codes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                parts = held.setdefault(language, [])
                parts.append(np.unique(codes, return_counts=True))
                if sum(len(g) for g, _ in parts) > HELD_GRAMS:
                    held[language] = [added(language)]
                    if len(held[language][0][0]) > HELD_GRAMS // 2:
                        yield rows(language)
                        del held[language]
    for language in held:
        yield rows(language)


def _fewer(counts: DataFrame, most: int) -> DataFrame:
    """``counts`` in at most about ``most`` rows: the rarest grams of the longest contexts lose their first byte and are added up.

    Every byte of every text stays counted, in a context as long as there is room for. Powers of two of the counts tell which go.
    """
    counts = reliable(counts)
    for order in range(ORDER, 0, -1):
        sizes = sorted(counts.groupBy(F.floor(F.log2("count")).alias("p")).count().collect(), reverse=True)
        if sum(r["count"] for r in sizes) <= most:
            break
        kept, least = 0, 1 << 62
        for r in sizes:
            kept += r["count"]
            if kept > most // 2:
                break
            least = 1 << r["p"]
        short = F.col("gram").bitwiseAND(F.lit((1 << (8 * order)) - 1))
        gram = F.when(F.col("count") < least, short).otherwise(F.col("gram")).alias("gram")
        counts = reliable(counts.select("lang", gram, "count").groupBy("lang", "gram").agg(F.sum("count").alias("count")))
    return counts


def sample(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = SAMPLE_ROWS,
    size: int = SAMPLE_BYTES,
) -> DataFrame:
    """(lang, text): at most ``rows`` documents of each language, whole, in the order of a hash of their id.

    It stops before ``size`` bytes are passed, but for its first document. Texts over ``1 / LONG`` of ``size`` come behind all
    others, shorter ones first, so where the sample stops all but that part of ``size`` is used, or no text left fits.
    Rows without language, text or id are not used. Counts per bucket of that order tell how far the sample reaches, so only
    rows of the buckets up to there are ranked, whatever the number of rows.
    """
    usable = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    texts = usable.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    long_ = F.col("_size") * LONG > size
    texts = texts.withColumn("_size", F.octet_length("text")).withColumns(
        {
            "_late": F.when(long_, F.col("_size")).otherwise(0),
            "_hash": F.xxhash64("doc_id"),
            "_bucket": F.when(long_, F.lit(BUCKETS) + F.floor(F.log2("_size") * 64)).otherwise(
                F.shiftright("_hash", 64 - BUCKETS.bit_length() + 1) + BUCKETS // 2
            ),
        }
    )
    counts = texts.groupBy("lang", "_bucket").agg(F.count("*").alias("c"))
    before = F.sum("c").over(W.partitionBy("lang").orderBy("_bucket")) - F.col("c")
    reach = counts.withColumn("_b", before).where(F.col("_b") < rows).groupBy("lang").agg(F.max("_bucket").alias("_reach"))
    near = texts.join(small(reach), "lang").where("_bucket <= _reach")
    order = W.partitionBy("lang").orderBy("_late", "_hash", "doc_id", "text")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= rows)
    taken = F.sum("_size").over(upto) - F.col("_size")
    return ranked.withColumn("_before", taken).where((F.col("_before") == 0) | (F.col("_before") + F.col("_size") <= size)).select("lang", "text")


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int | None = None,
    size: int | None = None,
    most: int = MOST_GRAMS,
) -> Trees:
    """Trees of every language with a labelled text, from all of them; from a ``sample`` where ``rows`` or ``size`` ask for one.

    Rows without language, text or id are not used. ``most`` bounds the trees, not the texts: see ``_fewer``.
    """
    if rows is None and size is None:
        usable = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
        texts = usable.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    else:
        texts = sample(labelled, id_col, text_col, lang_col, rows or SAMPLE_ROWS, size or SAMPLE_BYTES)
    counted = texts.mapInArrow(B.tidy(_gram_counts), "lang string, gram long, count long")
    counts = _fewer(counted.groupBy("lang", "gram").agg(F.sum("count").alias("count")), most).toArrow()
    languages = sorted(pc.unique(counts["lang"]).to_pylist())
    number = pc.index_in(counts["lang"], pa.array(languages, pa.string())).to_numpy().astype(np.int64)
    return Trees(languages, number, counts["gram"].to_numpy().astype(np.uint64), counts["count"].to_numpy().astype(float))


def most_bits(trees: Trees, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> float | None:
    """Bits a byte up to which a text is taken to be in a learned language: a high quantile over all labelled texts that the
    trees were not made of, with a margin. None if there is no such text."""
    texts = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    found = identify(texts, trees, text_col, keep=()).where(F.col("lang_pred") != UNKNOWN)
    top = exact_percentile_of_table(found, "bits_per_byte", {"top": QUANTILE}).first()["top"]
    return None if top is None else top * MARGIN


def _scores(batches: Iterator[tuple[pa.Array, pa.Array]], trees: Trees) -> Iterator[pa.StructArray]:
    names = np.array([*trees.languages, UNKNOWN], object)
    for text, letters in batches:
        data, offsets = B.string_bytes(text)
        lengths = np.concatenate(
            [
                trees.code_lengths(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for i, j in B.row_chunks(offsets)
            ]
            or [np.zeros((0, len(trees.languages)))]
        )
        known = letters.to_numpy(zero_copy_only=False).astype(bool)
        best = lengths.argmin(axis=1)
        least = lengths[np.arange(len(best)), best]
        share = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1)
        size = np.maximum(np.diff(offsets), 1)
        told = {
            "lang_pred": pa.array(names[np.where(known, best, len(trees.languages))], pa.string()),
            "score": pa.array(np.where(known, share, 0.0)),
            "bits_per_byte": pa.array(least / size),
            "n_bytes": pa.array(np.diff(offsets)),
        }
        yield pa.StructArray.from_arrays(list(told.values()), names=list(told))


def identify(docs: DataFrame, trees: Trees, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """(row: the columns ``keep`` of ``docs``, all unless given, as a struct, lang_pred, score, bits_per_byte, n_bytes), the text's language.

    ``und`` with score 0 for a null text, one without a letter, or if no language was learned. ``score`` is the
    language's share of the probability of the text; ``bits_per_byte`` the length of its shortest code, below 8
    for anything that some language explains better than no model. Ties go to the language first in order. Only the text goes to
    Python, and only the figures come back; the row stays with Spark.
    """
    keep = docs.columns if keep is None else list(keep)
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("_"))
    text = F.col(f"`{text_col}`")
    if not trees.languages:
        size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
        return docs.select(
            row.alias("row"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(8.0).alias("bits_per_byte"), size.alias("n_bytes")
        )
    held = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by ``train``

    def told(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return B.tidy(lambda it: _scores(it, held.value))(batches)

    scored = F.arrow_udf(told, "lang_pred string, score double, bits_per_byte double, n_bytes long")
    # not deterministic, so that a filter on the figures does not have them made a second time
    figures = scored.asNondeterministic()(F.coalesce(text, F.lit("")), F.coalesce(text.rlike("\\p{L}"), F.lit(False)))
    return docs.select(row.alias("row"), figures.alias("_told")).select("row", "_told.*")


def in_learned_language(docs: DataFrame, trees: Trees, text_col: str = "text", max_bits: float | None = None) -> DataFrame:
    """The rows of ``docs`` in a learned language: not ``und``, and with a code of at most ``max_bits`` a byte and ``SLACK_BITS`` more."""
    told = identify(docs, trees, text_col).where(F.col("lang_pred") != UNKNOWN)
    if max_bits is not None:
        told = told.where(F.col("bits_per_byte") * F.col("n_bytes") <= F.lit(max_bits) * F.col("n_bytes") + SLACK_BITS)
    return told.select("row.*")


def held_out(id_col: str = "doc_id"):
    """Whether CRC-32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
