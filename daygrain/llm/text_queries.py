"""Queries of decontamination, infilling and spelling variants over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm.decontaminate import WINDOW, contamination
from daygrain.llm.infill import fill_in_middle, restored
from daygrain.llm.spelling import variants
from daygrain.llm.tables import Stored


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    told = contamination(docs, items, Stored(spark))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return told.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"), Stored(spark))


QUERIES = {"op11_winnowing": op11_winnowing, "op12_infill": op12_infill, "op13_spelling": op13_spelling}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP11_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_WORDS} AS ws, least(len(ws), {WINDOW}) AS m FROM benchmark),
wins AS (
    SELECT DISTINCT item_id, m, array_to_string(list_slice(ws, pos, pos + m - 1), ' ') AS win
    FROM (SELECT *, unnest(range(1, len(ws) - m + 2)) AS pos FROM items WHERE m > 0)),
lengths AS (SELECT DISTINCT m FROM wins),
places AS (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS pos FROM docs, lengths WHERE len(ws) >= m),
hits AS (
    SELECT p.doc_id, p.pos, p.m, w.item_id
    FROM (SELECT doc_id, pos, m, array_to_string(list_slice(ws, pos, pos + m - 1), ' ') AS win FROM places) p JOIN wins w USING (m, win)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + m)) AS pos FROM hits) GROUP BY 1),
listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(t)::BIGINT AS n, sha256('1:' || doc_id) AS x FROM documents),
h AS (
    SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS c1, ('0x' || x[9:16])::BIGINT % (n + 1) AS c2,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || x[17:24])::BIGINT % 100 >= 90
                THEN 'plain' WHEN ('0x' || x[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d),
c AS (
    SELECT *, least(c1, c2) AS lo, greatest(c1, c2) AS hi, substring(t, 1, lo) AS prefix,
           substring(t, lo + 1, hi - lo) AS middle, substring(t, hi + 1) AS suffix
    FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""

#: CRC-32 is computed from its polynomial, byte by byte; characters from U+00C0 to U+00FF are two bytes of UTF-8.
OP13_SQL = f"""
WITH RECURSIVE poly AS (
    SELECT i AS byte, 0 AS step, i::BIGINT AS v FROM range(256) t(i)
    UNION ALL SELECT byte, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM poly WHERE step < 8),
crc AS (SELECT list(v ORDER BY byte) AS tab FROM poly WHERE step = 8),
runs AS (
    SELECT doc_id, run, count(*) AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2),
hashed AS (
    SELECT run, c, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, flatten([CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                   ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END
                   FOR x IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])),
               lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) AS h
    FROM runs, crc),
vocab AS (
    SELECT word, sum(c)::BIGINT AS n
    FROM (SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, c
          FROM hashed)
    WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM vocab),
holes AS (SELECT word, n, pos, substring(word, 1, pos - 1) AS a, substring(word, pos + 1) AS b FROM places),
near AS (
    SELECT x.word, y.word AS other, y.n AS other_n FROM holes x JOIN holes y USING (pos, a, b) WHERE x.word <> y.word
    UNION SELECT x.word, y.word, y.n FROM holes x JOIN vocab y ON y.word = x.a || x.b
    UNION SELECT y.word, x.word, x.n FROM holes x JOIN vocab y ON y.word = x.a || x.b),
best AS (
    SELECT word, count(*) AS n_near, min({{'less': -other_n, 'form': encode(other)}}) AS top FROM near GROUP BY 1),
formed AS (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, -top.less >= 5 * n AS yes,
           CASE WHEN yes THEN decode(top.form) END AS form, CASE WHEN yes THEN (-top.less)::BIGINT END AS form_n
    FROM vocab LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS last, 0 AS step FROM formed
    UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY 1)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

ORACLE = {"op11_winnowing": OP11_SQL, "op12_infill": OP12_SQL, "op13_spelling": OP13_SQL}
