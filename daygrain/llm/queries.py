"""The queries of the operators over their whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm import text_queries
from daygrain.llm.content import main_text
from daygrain.llm.langid import held_out, identify, train
from daygrain.llm.lines import MIN_SITES, remove_shared_lines
from daygrain.llm.mixing import PHASES, WEIGHTS, sorted_mix
from daygrain.llm.near_text import near_duplicates
from daygrain.llm.near_vectors import near_vectors
from daygrain.llm.neighbours import nearest
from daygrain.llm.packing import pack, public_vocabulary, token_pieces
from daygrain.llm.revisits import resolve_revisits
from daygrain.llm.suffixes import remove_repeats
from daygrain.llm.tables import Stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), Stored(spark), k=20)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), Stored(spark), least=0.9)


DAY = 86_400


def captures(pages: DataFrame) -> DataFrame:
    """Archive records made of ``pages``: for each page responses and revisits of its URL, in spellings of the URL.

    A page is captured in full at a second given by its id, and again two days later, changed, if its id is even. Revisits
    come a day before, a day after and three days after the first capture, with its entity tag (a weak one, none or another
    one for some ids) or its date of change.
    """
    text, n = F.coalesce("html", F.lit("")), F.col("page_id")
    tag = lambda x: F.concat(F.lit('"'), F.md5(x), F.lit('"'))
    other = F.concat(text, F.lit("<!-- changed -->"))
    moved = F.regexp_replace("url", "^https?://", "HTTPS://www.")
    first_tag = F.when(n % 5 == 0, F.lit('"other"')).when(n % 7 == 0, F.lit(None)).when(n % 3 == 0, F.concat(F.lit("W/"), tag(text))).otherwise(tag(text))
    kinds = F.array(
        _capture(0, "response", F.col("url"), 0, 200, tag(text), F.octet_length(text)),
        _capture(1, "revisit", moved, DAY, 304, first_tag, F.lit(0)),
        _capture(2, "response", F.concat("url", F.lit("#again")), 2 * DAY, F.when(n % 2 == 0, 200).otherwise(404), tag(other), F.octet_length(other)),
        _capture(3, "revisit", F.col("url"), 3 * DAY, 304, tag(text), F.lit(0)),
        _capture(4, "revisit", F.concat("url", F.lit("/")), -DAY, 304, tag(text), F.lit(0)),
    )
    return pages.select(F.explode(kinds).alias("r")).select("r.*")


def _capture(k, kind, url, shift, status, etag, length):  # noqa: PLR0913
    date = F.col("page_id") * 60 + shift
    changed = (F.col("page_id") * 60).cast("string")
    fields = {
        "Server": F.lit(kind), "Content-Length": length.cast("string"), "ETag": etag, "Date": date.cast("string"),
        "Cache-Control": F.concat(F.lit("max-age="), F.lit(str(60 + k))),
    }
    headers = F.map_from_entries(F.array(*[F.struct(F.lit(key), value) for key, value in fields.items()]))
    return F.struct(
        (F.col("page_id") * 5 + k).alias("record_id"), url.alias("url"), date.alias("date"), F.lit(kind).alias("kind"),
        (F.lit(status) if isinstance(status, int) else status).alias("status"), etag.alias("etag"), changed.alias("last_modified"),
        F.lit(None).cast("string").alias("digest"), headers.alias("headers"),
    )


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform("headers", lambda h: F.concat(h["key"], F.lit(": "), h["value"]))
    return resolve_revisits(captures(_table(spark, sf_dir, "pages")), Stored(spark)).select(
        "record_id", "canonical_url", "response_id", "outcome", F.array_join(lines, "\n").alias("headers")
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    trees = train(docs.where(~held_out()))
    return identify(docs, trees, keep=["doc_id"]).select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), Stored(spark), width=3, num=85, den=100).drop("text_hash")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return remove_shared_lines(docs, Stored(spark)).select("row.*", "lines_removed")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return remove_repeats(_table(spark, sf_dir, "documents"), Stored(spark), length=400).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # a character that a removal cuts through shows as a replacement character
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def op6_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.array_join("blocks", " ")
    return main_text(pages).select("row.*", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op7_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """``vocabulary``: file of a byte-level vocabulary; the public 50k one unless given."""
    pieces = token_pieces(_table(spark, sf_dir, "documents"), vocabulary or public_vocabulary())
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(digests, Stored(spark)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_mix(_table(spark, sf_dir, "documents"), Stored(spark)).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.floor(F.get("positions", F.lit(0)) * 1_000_000).alias("first_ppm"), "first_place", "last_place",
    )


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_revisits": op3_revisits,
    "op4_language": op4_language,
    "op5_minhash": op5_minhash,
    "op6_content": op6_content,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_suffix_array": op9_suffix_array,
    "op10_mixing": op10_mixing,
    **text_queries.QUERIES,
}

OP10_SQL = """
WITH sized AS (
    SELECT doc_id, source, coalesce(md5(doc_id::VARCHAR), '') AS k,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
    FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT AS turn,
           (turn + 1)::BIGINT AS w, source_size * 3 AS most
    FROM by_source),
-- the fuller a source is for its weight, the sooner it stops at its limit
lined AS (
    SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
           coalesce(sum(most) OVER o, 0) AS most_before, coalesce(sum(w) OVER o, 0) AS w_before
    FROM weighed
    WINDOW o AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, most * (all_w - w_before) <= w * (total - most_before) AS full_ FROM lined),
unit AS (
    SELECT (max(total) - coalesce(sum(most) FILTER (WHERE full_), 0))::DOUBLE
           / nullif(sum(w) FILTER (WHERE NOT full_), 0)::DOUBLE AS u
    FROM stopped),
targets AS (
    SELECT source, source_size, turn, CASE WHEN full_ THEN most::DOUBLE ELSE u * w END AS target FROM stopped, unit),
laid AS (
    SELECT s.doc_id, s.source, s.size, t.source_size, t.turn, t.target,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS b
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counted AS MATERIALIZED (
    SELECT *, row_number() OVER () AS r, CASE WHEN source_size > 0
        THEN greatest(ceil((2.0::DOUBLE * target - 2 * b - size) / (2 * source_size)::DOUBLE), 0)::BIGINT ELSE 0 END AS copies
    FROM laid),
turns AS (
    SELECT *, (pass * source_size + b)::DOUBLE / target AS share
    FROM (SELECT *, unnest(range(copies)) AS pass FROM counted)),
timed AS (SELECT r, source, doc_id, size, pass, {position} AS position FROM turns),
placed AS (
    SELECT r, pass, position, row_number() OVER (ORDER BY position, source NULLS FIRST, doc_id NULLS FIRST, size, pass, r) - 1 AS n
    FROM timed),
places AS (
    SELECT r, min(n) AS first_place, max(n) AS last_place, floor(1000000 * min(position))::BIGINT AS first_ppm
    FROM placed GROUP BY r)
SELECT doc_id, size, source_size, target, copies * size AS taken, first_ppm, first_place, last_place
FROM counted LEFT JOIN places USING (r)
"""


def _position_sql() -> str:
    """The inverted demand of the default phases, per place in the weight cycle."""
    cases = []
    for turn in range(len(WEIGHTS)):
        total, done, start, steps = sum((e - s) * m[turn] for s, e, m in _spans()), 0.0, 0.0, []
        for start, end, strengths in _spans():
            part = (end - start) * strengths[turn] / total
            low = done / total
            steps.append(f"WHEN share < {low + part!r}::DOUBLE THEN {start!r}::DOUBLE + (share - {low!r}::DOUBLE) / {part!r}::DOUBLE * {end - start!r}::DOUBLE")
            done += (end - start) * strengths[turn]
        cases.append(f"WHEN turn = {turn} THEN CASE {' '.join(steps)} ELSE 1.0 END")
    return f"CASE {' '.join(cases)} END"


def _spans() -> list[tuple[float, float, tuple[float, ...]]]:
    return [(PHASES[k - 1][0] if k else 0.0, end, m) for k, (end, m) in enumerate(PHASES)]


OP3_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
r AS (
    SELECT page_id * 5 AS record_id, page_id, url, page_id * 60 AS date, 'response' AS kind, 200 AS status,
           '"' || md5(html) || '"' AS etag, strlen(html) AS n, 60 AS age FROM p
    UNION ALL SELECT page_id * 5 + 1, page_id, regexp_replace(url, '^https?://', 'HTTPS://www.'), page_id * 60 + 86400, 'revisit', 304,
           CASE WHEN page_id % 5 = 0 THEN '"other"' WHEN page_id % 7 = 0 THEN NULL
                WHEN page_id % 3 = 0 THEN 'W/"' || md5(html) || '"' ELSE '"' || md5(html) || '"' END, 0, 61 FROM p
    UNION ALL SELECT page_id * 5 + 2, page_id, url || '#again', page_id * 60 + 172800, 'response',
           CASE WHEN page_id % 2 = 0 THEN 200 ELSE 404 END, '"' || md5(html || '<!-- changed -->') || '"',
           strlen(html || '<!-- changed -->'), 62 FROM p
    UNION ALL SELECT page_id * 5 + 3, page_id, url, page_id * 60 + 259200, 'revisit', 304, '"' || md5(html) || '"', 0, 63 FROM p
    UNION ALL SELECT page_id * 5 + 4, page_id, url || '/', page_id * 60 - 86400, 'revisit', 304, '"' || md5(html) || '"', 0, 64 FROM p),
bare AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS b FROM r),
cut AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace(
               lower(regexp_extract(b, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*[.]', '') AS host,
           regexp_replace(b, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?]*', '') AS rest
    FROM bare),
named AS (
    SELECT *, regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', '') AS path,
           list_sort([x FOR x IN string_split(regexp_extract(rest, '[?](.*)$', 1), '&')
               IF x <> '' AND NOT regexp_matches(x, '^(?:utm_[a-z]+|fbclid|gclid|ref|sessionid|sid)(?:=|$)')]) AS args
    FROM cut),
rec AS (
    SELECT *, host || path || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS canonical_url
    FROM named),
latest AS (
    SELECT v.*, (SELECT max({'date': f.date, 'id': f.record_id, 'etag': f.etag, 'changed': f.page_id * 60, 'n': f.n, 'age': f.age})
                 FROM rec f WHERE f.kind = 'response' AND f.status = 200 AND f.canonical_url = v.canonical_url AND f.date < v.date) AS f
    FROM rec v WHERE v.kind = 'revisit'),
judged AS (
    SELECT *, f.id AS response_id,
           CASE WHEN f IS NULL THEN 'missing'
                WHEN CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^[Ww]/', '') = f.etag ELSE page_id * 60 = f.changed END
                THEN 'resolved' ELSE 'changed' END AS outcome
    FROM latest)
SELECT record_id, canonical_url, response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=' || age || chr(10) || 'content-length: ' || f.n || chr(10)
           || 'date: ' || date || chr(10) || 'etag: ' || coalesce(etag, f.etag) || chr(10) || 'server: response' END AS headers
FROM judged
"""

OP8_SQL = f"""
WITH lines AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM documents),
shared AS (
    SELECT trim(line, ' ' || chr(9) || chr(13)) AS t FROM lines
    WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
    GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
listed AS (SELECT coalesce(list(t), []) AS gone FROM shared),
cut AS (
    SELECT doc_id, source, text, string_split(text, chr(10)) AS parts,
           [x FOR x IN string_split(text, chr(10)) IF NOT list_contains(gone, trim(x, ' ' || chr(9) || chr(13)))] AS kept
    FROM documents, listed)
SELECT doc_id, source, coalesce(array_to_string(kept, chr(10)), text) AS text, coalesce(len(parts) - len(kept), 0) AS lines_removed
FROM cut
"""


ORACLE = {
    "op3_revisits": OP3_SQL,
    "op8_line_dedup": OP8_SQL,
    "op10_mixing": OP10_SQL.replace("{position}", _position_sql()),
    **text_queries.ORACLE,
}
