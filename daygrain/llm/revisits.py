"""Resolving not-modified revisits of a web archive to the full response they stand for.

A revisit is joined as of its date to the latest earlier full response of the same canonical URL. Records are dealt to
sorted ranges of (canonical URL, date), so a URL with a third of all captures spans many tasks; a range takes the
last response of the ranges before it for the one URL that it continues.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.llm.tables import Stored, parts_for, ranged, small

RANGE_ROWS = 20_000
CARRIED_ROWS = 20_000  # with headers; up to so many are broadcast
# The header fields that a 304 response may update (RFC 9110, 15.4.5, with Last-Modified),
# and the query parameters that only track visitors.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "utm_[a-z]+|fbclid|gclid|ref|sessionid|sid"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www, user and default port; path without closing slashes; query sorted, without tracking.

    Scheme and fragment are dropped. Null for a null URL.
    """
    bare = F.regexp_replace(F.btrim(url), "#[\\s\\S]*$", "")
    host = F.lower(F.regexp_extract(bare, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", "")
    host = F.regexp_replace(host, "^www[0-9]*\\.", "")
    rest = F.regexp_replace(bare, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^([^?]*)", 1), "/+$", "")
    pairs = F.split(F.regexp_extract(rest, "\\?([\\s\\S]*)$", 1), "&")
    kept = F.sort_array(F.filter(pairs, lambda x: (x != "") & ~x.rlike(f"^(?:{TRACKING})(?:=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _bare_tag(tag: Column) -> Column:
    return F.regexp_replace(F.btrim(tag), "^[Ww]/", "")


def _named(headers: Column) -> Column:
    """Header entries with a value, by lower-case name, in order of name."""
    present = F.filter(F.map_entries(headers), lambda e: e["value"].isNotNull())
    lower = F.transform(present, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.sort_array(F.coalesce(lower, F.array().cast("array<struct<key:string,value:string>>")))


def resolve_revisits(records: DataFrame, stored: Stored) -> DataFrame:
    """One row per revisit: record_id, canonical_url, response_id, outcome, headers.

    ``records``: record_id (long), url, date (timestamp or number), kind (``response`` or ``revisit``), status, etag,
    last_modified, digest (strings), headers (map of strings); other columns are not read. Responses of status 200 are
    full. ``outcome``: ``resolved`` if a validator agrees, ``changed`` if it differs, ``unverified`` if no validator stands on
    both sides, ``missing`` without earlier full response, null URL or null date. The entity tags are compared first, weakly,
    then Last-Modified, then the digest. A response of the same date is not earlier; of responses of one date the greatest
    id counts. ``headers`` of resolved revisits, as entries in order of name: the response's, updated by the revisit's
    where ``PERMITTED``. Records of other kinds are passed over; repeated records give repeated rows.
    """
    fields = ["etag", "last_modified", "digest"]
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    # NULL status or kind is no full response
    base = stored.put(
        records.where(F.coalesce((F.col("kind") == "revisit") | full, F.lit(False))).select(
            F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("canonical_url"),
            F.col("date").alias("date"), (F.col("kind") != "revisit").alias("full"), *fields, _named(F.col("headers")).alias("headers"),
        )
    )
    usable = F.col("canonical_url").isNotNull() & F.col("date").isNotNull()
    none = base.where(~usable & ~F.col("full")).select("record_id", "canonical_url")
    parts = parts_for(records.sparkSession, base.count(), RANGE_ROWS)
    dealt = ranged(base.where(usable), ["canonical_url", "date", F.col("full").cast("int"), "record_id"], stored, parts)
    one = F.when(F.col("full"), F.struct("date", "record_id", *fields, "headers"))
    # within a range: revisits come before the responses of their date, so what is above them is earlier
    by_date = W.partitionBy("_part", "canonical_url").orderBy("date", F.col("full").cast("int"), "record_id")
    latest = F.max(one).over(by_date.rowsBetween(W.unboundedPreceding, -1))
    lasts = dealt.groupBy("_part", "canonical_url").agg(F.max(one).alias("last"))
    spans = dealt.groupBy("canonical_url").agg(F.min("_part").alias("a"), F.max("_part").alias("b")).where("a < b").select("canonical_url")
    order = W.partitionBy("canonical_url").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # at most one URL goes on into each range: no more rows than ranges, but each with its headers
    spans = stored.put(spans)
    carried = stored.put(lasts.join(small(spans), "canonical_url").withColumn("carry", F.max("last").over(order)).drop("last"))
    found = (
        dealt.withColumn("_latest", latest)
        .where(~F.col("full"))
        .join(small(carried, limit=CARRIED_ROWS), ["_part", "canonical_url"], "left")
        .withColumn("r", F.coalesce("_latest", "carry"))
    )
    same = lambda a, b: F.when(a.isNotNull() & b.isNotNull(), a == b)
    agrees = F.coalesce(
        same(_bare_tag(F.col("etag")), _bare_tag(F.col("r.etag"))),
        same(F.col("last_modified"), F.col("r.last_modified")),
        same(F.col("digest"), F.col("r.digest")),
    )
    outcome = (
        F.when(F.col("r").isNull(), "missing").when(agrees.isNull(), "unverified").when(agrees, "resolved").otherwise("changed")
    )
    news = F.filter("headers", lambda h: h["key"].isin(*PERMITTED))
    kept = F.filter("r.headers", lambda h: ~F.exists(news, lambda n: n["key"] == h["key"]))
    joined = found.select(
        "record_id", "canonical_url", F.col("r.record_id").alias("response_id"), outcome.alias("outcome"),
        F.sort_array(F.concat(kept, news)).alias("headers"),
    )
    result = joined.withColumn("headers", F.when(F.col("outcome") == "resolved", F.col("headers")))
    empty = none.select(
        "record_id", "canonical_url", F.lit(None).cast("long").alias("response_id"), F.lit("missing").alias("outcome"),
        F.lit(None).cast("array<struct<key:string,value:string>>").alias("headers"),
    )
    return result.unionByName(empty)
