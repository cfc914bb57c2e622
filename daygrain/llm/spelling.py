"""Grouping of spelling variants by permuterm rotations.

A word is closed by a terminator and turned: each rotation starts at another place, so the character before that place comes
last. Two words that differ in one replaced character have rotations that agree in all but this last character, and a word
without one character of another is, turned, that prefix itself. All rotations are dealt out and sorted by the prefix that skips the last
character, next to the whole rotations; equal keys are one group. A key fixes a word but for one character, so a group has as many
words as the alphabet has characters, at most, and one more, and all its words are neighbours.

Keys of over ``LONG`` characters are digests from prefix hashes, since the rotations of a word of a million characters would fill a
million million; pairs of such words are compared character by character afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm import buffers as B
from daygrain.llm.tables import Stored, parts_for, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-z\\u00C0-\\u00FF]+"
END, DIGEST = "$", "#"  # neither is a character of a word
LONG = 64
LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
CHANGED = 199  # one run in so many loses a character
ROTATIONS_EACH = 2_000_000  # of a sorted range
ROUNDS = 40
_powers = B.POWERS


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z as a-z, with their number; one run in ``CHANGED``, by the CRC-32 of id
    and run, without one of its characters. Null texts have none; a null id is an empty one."""
    run = F.explode(F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run")
    mark = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.where(F.col(text_col).isNotNull()).select(mark.alias("mark"), run)
    h = F.crc32(F.concat("mark", F.lit(":"), "run"))
    hashed = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return hashed.select(F.when(F.col("h") % CHANGED == 0, cut).otherwise(F.col("run")).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )


def _reference(word: Column) -> Column:
    return F.when(F.char_length(word) < LONG, word).otherwise(F.concat(F.lit(DIGEST), F.sha2(word, 256)))


def _turns() -> Column:
    """Keys of a word of less than ``LONG`` characters: whole rotations, and prefixes of rotations that skip the last character."""
    size = F.char_length("word")
    head = lambda k: F.substr("word", F.lit(1), k)
    tail = lambda k: F.substr("word", k + 1)
    whole = F.transform(F.sequence(F.lit(0), size), lambda k: F.struct(F.concat(tail(k), F.lit(END), head(k)).alias("key"), F.lit(True).alias("whole")))
    skipped = F.transform(
        F.sequence(F.lit(0), size - 1), lambda k: F.struct(F.concat(tail(k + 1), F.lit(END), head(k)).alias("key"), F.lit(False).alias("whole"))
    )
    return F.inline(F.concat(whole, skipped))


def _long_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same keys, as digests where they are over ``LONG`` characters, and the word by its digest. One word at a time."""
    codes = [np.random.default_rng(k).integers(0, 1 << 64, 256, dtype=np.uint64) for k in (13, 14)]
    for batch in batches:
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = np.frombuffer(word.encode("latin-1"), np.uint8)
            size, ref = len(data), DIGEST + hashlib.sha256(word.encode()).hexdigest()
            k = np.arange(size + 1)
            hashes = []
            for code in codes:
                prefix = B.PrefixHash(data, code, _powers)
                end = code[ord(END)]

                def key(start: np.ndarray, stop: np.ndarray, prefix=prefix, end=end) -> np.ndarray:
                    """Of word[start:], the terminator, word[:stop]."""
                    behind = np.full(len(start), size)
                    up = prefix.powers.up
                    tail = prefix.of(start, behind)
                    return B.mix(tail + end * up[size - start] + prefix.of(np.zeros(len(stop), np.int64), stop) * up[size - start + 1])

                prefix.powers.upto(size + 1)
                hashes.append(np.concatenate((key(k, k), key(k[1:], k[:-1]))))
            literal = size == LONG  # then the prefixes are short enough to stand for themselves
            for first in range(0, 2 * size + 1, 100_000):
                at = np.arange(first, min(first + 100_000, 2 * size + 1))
                keys = [
                    word[j - size :] + END + word[: j - size - 1] if literal and j > size else f"{DIGEST}{a:016x}{b:016x}"
                    for j, a, b in zip(at.tolist(), hashes[0][at].tolist(), hashes[1][at].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(at <= size), pa.array([ref] * len(at), pa.string()), pa.array(np.full(len(at), n))],
                    names=["key", "whole", "ref", "n"],
                )


def rotations(vocabulary: DataFrame) -> DataFrame:
    """(key, whole, ref, n): a row per rotation and per prefix. ``ref`` is the word, or the digest of one of ``LONG`` characters or more."""
    brief = vocabulary.where(F.char_length("word") < LONG).select(_turns(), F.col("word").alias("ref"), "n")
    long_ = vocabulary.where(F.char_length("word") >= LONG).select("word", "n")
    return brief.unionByName(long_.mapInArrow(_long_turns, "key string, whole boolean, ref string, n long"))


def neighbours(vocabulary: DataFrame, stored: Stored) -> DataFrame:
    """(ref, near, near_n), once per ordered pair of words of ``vocabulary`` (word, n) that differ by exactly one inserted, deleted
    or replaced character."""
    turned = stored.put(rotations(vocabulary))
    parts = parts_for(vocabulary.sparkSession, turned.count(), ROTATIONS_EACH)
    member = F.struct("ref", "n", "whole")
    groups = (
        turned.repartitionByRange(parts, "key").sortWithinPartitions("key").groupBy("key").agg(F.collect_list(member).alias("g")).where(F.size("g") > 1)
    )
    others = lambda x: F.filter("g", lambda y: y["ref"] != x["ref"])
    pairs = F.flatten(
        F.transform("g", lambda x: F.transform(others(x), lambda y: F.struct(x["ref"].alias("ref"), y["ref"].alias("near"), y["n"].alias("near_n"))))
    )
    return stored.swap(turned, groups.select(F.inline(pairs)).distinct())


def variants(
    docs: DataFrame,
    stored: Stored,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of at least ``least_chars`` characters and ``least_count`` occurrences.

    ``form`` is the word's neighbour with the most occurrences (ties: the first in code-point order) if it has at least ``times`` as
    many as the word; ``root`` the last word when forms are followed, the word itself if it has none. Each form has ``times`` the
    occurrences of what it stands for, so forms have no loops and the doubling of steps ends after the logarithm of a logarithm.
    No words, no rows. Other columns of ``docs`` are not read.
    """
    counted = words(docs, id_col, text_col).where((F.col("n") >= least_count) & (F.char_length("word") >= least_chars))
    vocabulary = stored.put(counted.withColumn("ref", _reference(F.col("word"))))
    pairs = neighbours(vocabulary.select("word", "n"), stored)
    brief = ~F.startswith("near", F.lit(DIGEST))
    spelled = pairs.where(brief).select("ref", F.col("near").alias("word"), "near_n")
    written = vocabulary.where(F.char_length("word") >= LONG).select(F.col("ref").alias("near"), "word")
    spelled = spelled.unionByName(pairs.where(~brief).join(written, "near").select("ref", "word", "near_n"))
    best = spelled.groupBy("ref").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("word").alias("form"))).alias("best")
    )
    has_form = -F.col("best.less") >= times * F.col("n")
    table = stored.put(
        vocabulary.join(best, "ref", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, -F.col("best.less")).alias("form_n"),
        )
    )
    return table.join(_roots(table, stored), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(table: DataFrame, stored: Stored) -> DataFrame:
    """(word, root) of the words with a form: every round follows twice as many steps."""
    steps = stored.put(table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    rows = steps.count()
    for _ in range(ROUNDS):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        taken = stored.put(
            steps.join(small(further, rows), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more"))
        )
        stored.drop(steps)
        steps = taken
        if not taken.where("more").limit(1).count():
            return steps.select("word", "root")
    raise RuntimeError("forms did not end")
