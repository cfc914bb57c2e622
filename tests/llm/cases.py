"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession

from daygrain.llm.tables import Stored

WORDS = [a + b for a in "ba da ke lo mi nu po ra se ti".split() for b in "n r s t l m".split()]
DOCS = "doc_id long, text string, lang string, source string, n_chars int, k1 string, row string, size int, node int, copies int"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def edge_rows() -> list[tuple]:
    base, passage = prose(1, 300), prose(2, 120)
    texts = [
        None, "", "   \n\t ", "one", "one two", "One  TWO", "...", "日本語 テキスト", "a" * 3000, "ab " * 1500,
        base, base, base.upper(), edited(base, 3, 4), edited(base, 4, 40), edited(base, 5, 9), prose(6, 4000),
        prose(7, 90) + " " + passage + "\n" + prose(8, 60), passage + prose(9, 200), prose(10, 30) + passage,
        "\n".join(["shared line here", prose(11, 40), "shared line here ", prose(12, 50)]), "shared line here", "\n\n",
    ]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, ["en", "fr", None][i % 3], ["s0", "s1", None, "s3"][i % 4], 7, "x", "y", 1, 2, 3))
    rows += [rows[10], (None, base, "en", "s0", 1, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    rows.append((10, prose(13, 50), "en", "s1", 1, "x", "y", 1, 2, 3))  # an id again, with another text
    return rows


def edge_docs(spark: SparkSession):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


def empty_docs(spark: SparkSession):
    return spark.createDataFrame([], DOCS)


def stored(spark: SparkSession) -> Stored:
    return Stored(spark)
