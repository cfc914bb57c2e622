"""From raw documents to packed training sequences: five stages over all documents.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and reread as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm.langid import held_out, in_learned_language, most_bits, train
from daygrain.llm.lines import remove_shared_lines
from daygrain.llm.mixing import curriculum
from daygrain.llm.near_text import one_of_each
from daygrain.llm.packing import pack, public_vocabulary, token_pieces
from daygrain.llm.tables import Stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the labelled ones; texts without letters or in no such language go."""
    trees = train(docs.where(~held_out()))
    return in_learned_language(docs, trees, max_bits=most_bits(trees, docs.where(held_out())))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share, their number of characters counted anew.

    A text without any other line stays whole: copies of a document on many sites look so, and one of them is to be kept.
    """
    reduced = remove_shared_lines(docs, Stored(spark), spare_whole=True).select("row.*")
    size = F.char_length("text").cast(dict(docs.dtypes).get("n_chars", "int"))
    return reduced.withColumn("n_chars", size).select(*docs.columns) if "n_chars" in docs.columns else reduced


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return one_of_each(docs, Stored(spark), width=5, num=80, den=100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks, in the order of the curriculum."""
    return curriculum(docs, Stored(spark))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences of 1024."""
    pieces = token_pieces(docs, public_vocabulary())
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), Stored(spark))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("mixture", mixture),
    ("packing", sequences),
]

#: SQL cannot state the language stage; tests hold the run against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    stored, docs = Stored(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = stored.put(stage(spark, docs, sf_dir))
        if before is not None:
            stored.drop(before)
        before = docs
    return docs
