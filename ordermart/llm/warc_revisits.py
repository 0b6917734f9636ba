"""WARC: resolution of not-modified revisits.

A revisit record of the server-not-modified profile (HTTP 304) has no payload.
It is resolved by an as-of join on the canonical URL to the latest full response
captured before it; the validators of both must agree, and the header fields a
304 may carry replace those of the response.

The as-of join works on slices of time: the latest response of every (URL,
slice) is carried over the slices of the URL, and only inside a slice is it
looked for record by record. A URL that holds a third of all records is thus
spread over its slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import stored

# The fields a 304 response may update (RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """One spelling for addresses of the same resource; null stays null.

    Scheme, fragment, default port, ``www.``, ``utm_*`` parameters and a trailing
    slash are dropped and the host is lower-cased; path and other parameters stay.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^(?i)[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.|:(80|443)$", "")
    rest = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*(.*)$", 1), r"(?<=[?&])utm_[^&]*(&|$)", "")
    return F.concat(host, F.regexp_replace(rest, r"/?[?&]*$", ""))


def header(headers: Column, name: str) -> Column:
    """First value of a header field, whatever its case; null where absent."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == F.lit(name)), F.lit(0))["value"]


def _etag(headers: Column) -> Column:
    return F.regexp_replace(F.trim(header(headers, "etag")), "^W/", "")


def merge_headers(stored_headers: Column, fresh: Column) -> Column:
    """``stored_headers`` with the permitted fields of ``fresh`` in place of its own."""
    updates = F.filter(fresh, lambda h: F.lower(h["name"]).isin(*PERMITTED))
    names = F.transform(updates, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored_headers, lambda h: ~F.array_contains(names, F.lower(h["name"]))), updates)


def resolve_revisits(records: DataFrame, *, slice_seconds: int = 3600) -> DataFrame:
    """One row per revisit: record_id, canonical_url, response_id, outcome, headers.

    ``records`` has record_id, kind ('response' or 'revisit'), url, at (long,
    seconds) and headers (array of name/value structs). Outcomes:

    * ``resolved``: ``response_id`` names the response whose payload holds, and
      ``headers`` are its headers updated by the permitted fields of the revisit;
    * ``changed``: the latest earlier response has another validator (entity
      tags are compared without the weak mark; dates of last modification where
      one side has no tag);
    * ``unvalidated``: no validator that both sides carry;
    * ``orphan``: no earlier response of that URL.

    Only in the first case are ``headers`` merged; else they are the revisit's
    own. "Earlier" is strict; of responses at the same second the largest
    record_id counts. A null URL or time never matches. Null headers count as
    none, null kinds and other kinds are ignored, repeated rows are resolved
    each, and other columns are ignored.
    """
    none = F.array().cast("array<struct<name:string,value:string>>")
    narrow = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), F.col("at").cast("long").alias("at"),
        F.coalesce(F.col("headers").cast("array<struct<name:string,value:string>>"), none).alias("headers"),
    )
    narrow = stored(narrow.withColumn("slice", F.floor(F.col("at") / F.lit(slice_seconds)).cast("long")), "records")
    responses = narrow.where("kind = 'response'")
    revisits = narrow.where("kind = 'revisit'")

    found = F.when(F.col("kind") == "response", F.struct("at", "record_id"))
    placed = narrow.where("canonical_url is not null and at is not null").select(
        "record_id", "kind", "canonical_url", "slice", "at", found.alias("response")
    )
    earlier_slices = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = stored(
        placed.groupBy("canonical_url", "slice").agg(F.max("response").alias("newest"))
        .select("canonical_url", "slice", F.max("newest").over(earlier_slices).alias("carried")),
        "slices",
    )
    same_slice = Window.partitionBy("canonical_url", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    asof = (
        placed.withColumn("inside", F.max("response").over(same_slice))
        .where("kind = 'revisit'")
        .join(carried, ["canonical_url", "slice"])
        .select("record_id", "at", "canonical_url", F.coalesce("inside", "carried")["record_id"].alias("response_id"))
        .distinct()
    )
    latest = responses.groupBy("record_id").agg(F.max(F.struct("at", "headers")).alias("kept")).select(
        F.col("record_id").alias("response_id"), F.col("kept")["headers"].alias("full")
    )
    joined = (
        revisits.join(stored(asof, "asof"), ["record_id", "at", "canonical_url"], "left")
        .join(stored(latest, "responses"), "response_id", "left")
    )
    tag, full_tag = _etag(F.col("headers")), _etag(F.col("full"))
    since, full_since = header(F.col("headers"), "last-modified"), header(F.col("full"), "last-modified")
    by_tag, by_date = tag.isNotNull() & full_tag.isNotNull(), since.isNotNull() & full_since.isNotNull()
    outcome = (
        F.when(F.col("response_id").isNull(), "orphan")
        .when(by_tag, F.when(tag == full_tag, "resolved").otherwise("changed"))
        .when(by_date, F.when(since == full_since, "resolved").otherwise("changed"))
        .otherwise("unvalidated")
    )
    return joined.withColumn("outcome", outcome).select(
        "record_id", "canonical_url", "response_id", "outcome",
        F.when(F.col("outcome") == "resolved", merge_headers(F.col("full"), F.col("headers")))
        .otherwise(F.col("headers")).alias("headers"),
    )


# The second at which page 0 is captured, and the seconds between pages.
EPOCH, STEP = 1_600_000_000, 60


def captures(pages: DataFrame) -> DataFrame:
    """The capture log of a crawl over ``pages``, as records for ``resolve_revisits``.

    Every page is a full response. Every second page is asked for again later
    and answered with 304: mostly with the same entity tag, sometimes weak,
    sometimes with another one or with the date of last modification only; every
    eleventh page also has a revisit from before its capture.
    """
    p, at = F.col("page_id"), F.lit(EPOCH) + F.col("page_id") * F.lit(STEP)
    digest = F.md5(F.coalesce(F.col("html"), F.lit("")))
    tag = F.concat(F.lit('"'), digest, F.lit('"'))
    modified = F.concat(F.lit("day "), (p % 365).cast("string"))

    def field(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    def number(value: Column) -> Column:
        return value.cast("string")

    size = number(F.octet_length(F.coalesce(F.col("html"), F.lit(""))))
    full = F.array(
        field("Content-Type", F.lit("text/html")), field("Content-Length", size), field("ETag", tag),
        field("Last-Modified", modified), field("Date", number(at)),
    )
    again = at + F.lit(86400) + (p % 1000) * F.lit(37)
    shown = (
        F.when(p % 14 == 0, F.concat(F.lit('"'), F.md5(digest), F.lit('"')))
        .when(p % 6 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    )
    fresh = F.array(field("etag", shown), field("Date", number(again)), field("Content-Length", F.lit("0")))
    dated = F.array(
        field("Last-Modified", modified), field("Date", number(again)), field("Expires", number(again + F.lit(600)))
    )
    before = at - F.lit(30)
    kept = F.filter(
        F.array(
            F.struct((p * 3).alias("record_id"), F.lit("response").alias("kind"), at.alias("at"), full.alias("headers")),
            F.when(p % 2 == 0, F.struct(
                (p * 3 + 1).alias("record_id"), F.lit("revisit").alias("kind"), again.alias("at"),
                F.when(p % 10 == 0, dated).otherwise(fresh).alias("headers"),
            )),
            F.when(p % 11 == 0, F.struct(
                (p * 3 + 2).alias("record_id"), F.lit("revisit").alias("kind"), before.alias("at"),
                F.array(field("ETag", tag), field("Date", number(before))).alias("headers"),
            )),
        ),
        lambda r: r.isNotNull(),
    )
    return pages.select("url", F.explode(kept).alias("r")).select("url", "r.*")
