"""Not-modified revisit records resolved against earlier full responses.

A revisit says that a page has not changed and carries no body.  Its source is
the latest earlier full response (type ``response``, status 200, with a body)
of the same canonical URL: an as-of join.  The source's validators must agree
with the revisit's: the ETag (weak comparison) where both have one, else
Last-Modified, else the payload digest.  A resolved revisit takes the source's body and headers, with
its own headers merged over them except those that describe the stored body.

The as-of join splits each URL by time slices, cut at approximate quantiles of all
times (at most ``slices`` numbers on the driver): the latest response inside the
slice by a window over (URL, slice), and the one carried into it by a window
over a table of one row for each (URL, slice).  So a URL that holds a large
part of all records is never ordered in one task.  Bodies don't take part.

Defined cases: records are ordered by (captured_at, record_id); a revisit
without a URL, time or any earlier response gets ``no_response``; one
without common validators gets ``unverified``; disagreeing ones give
``mismatch``; only ``resolved`` rows carry headers and body.  Repeated
revisits are each resolved; of responses repeated with one id and time the one with
the greater ETag, then digest, counts as later.  Null headers count as none.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Header fields that a not-modified answer doesn't update, as HTTP caching states them.
KEPT_FROM_BODY = ("content-encoding", "content-length", "content-range", "content-type", "transfer-encoding")
#: Query parameters that don't tell pages apart.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.``, default port or user, path without closing
    slashes, sorted query without tracking parameters; no scheme, no fragment."""
    prefix = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(host, "^.*@", "")), ":(80|443)?$", ""), r"^www\.", "")
    rest = F.regexp_replace(F.regexp_replace(url, prefix, ""), "#[^\n]*$", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"\?[^\n]*$", ""), "/+$", "")
    query = F.regexp_extract(rest, r"\?([^\n]*)$", 1)
    wanted = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))))
    query = F.array_join(wanted, "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names equal then, the last value."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    latest = F.filter(entries, lambda e, i: F.size(F.filter(entries, lambda o, j: (j > i) & (o["key"] == e["key"]))) == 0)
    return F.coalesce(F.map_from_entries(latest), F.create_map().cast("map<string,string>"))


def merged_headers(stored: Column, new: Column) -> Column:
    """``stored`` updated by the permitted fields of ``new``."""
    allowed = F.map_filter(new, lambda k, v: ~k.isin(*KEPT_FROM_BODY))
    untouched = F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_concat(untouched, allowed)


def header_text(headers: Column) -> Column:
    """Sorted ``name: value`` lines."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)),
                                    lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n")


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def sources(records: DataFrame, slices: int | None = None) -> DataFrame:
    """Every revisit of ``records`` (record_id, url, captured_at, type,
    status, headers, digest, body) with its source: record_id, url_key,
    captured_at, outcome, source_id, headers (merged)."""
    slices = slices or 4 * int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    headers = lower_keys(F.col("headers"))
    rows = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "captured_at", "type", headers.alias("h"),
                          "digest", ((F.col("type") == "response") & (F.col("status") == 200)
                                     & F.col("body").isNotNull()).alias("full"))
    rows = rows.filter("full or type = 'revisit'")
    # cuts at quantiles of the times, so that no stray time makes one slice of all others
    steps = [k / slices for k in range(1, slices)]
    when = F.col("captured_at").cast("double")
    cuts = rows.agg(F.percentile_approx(when, steps, 20 * slices)).first()[0] if steps else None
    splits = [-math.inf, *sorted({c for c in cuts or [] if math.isfinite(c)}), math.inf]
    rows = Bucketizer(splits=splits if len(splits) > 2 else [-math.inf, 0.0, math.inf], inputCol="__when", outputCol="slice",
                      handleInvalid="keep").transform(rows.withColumn("__when", F.coalesce(when, F.lit(math.nan)))).drop("__when")
    answer = F.when(F.col("full"), F.struct("captured_at", "record_id", F.col("h")["etag"].alias("etag"), "digest",
                                     F.col("h")["last-modified"].alias("modified"), header_text(F.col("h")).alias("order")))
    rows = rows.withColumn("answer", answer)

    order = [F.col("captured_at"), F.col("record_id"), F.col("answer.etag"), F.col("answer.digest")]
    here = Window.partitionBy("url_key", "slice").orderBy(*order)
    same = F.last(F.when(F.col("full"), F.struct("answer", "h")), ignorenulls=True).over(
        here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = rows.withColumn("same", same).filter("type = 'revisit'")
    latest = rows.filter("full").groupBy("url_key", "slice").agg(F.max_by(F.struct("answer", "h"), "answer").alias("latest"))
    known = rows.select("url_key", "slice").distinct().join(latest, ["url_key", "slice"], "left")
    carried = known.withColumn("carried", F.last("latest", ignorenulls=True).over(
        Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))).drop("latest")
    on = [found["url_key"] == carried["url_key"], found["slice"].eqNullSafe(carried["slice"])]
    source = F.when(found["url_key"].isNotNull() & found["captured_at"].isNotNull(), F.coalesce("same", "carried"))
    joined = found.join(carried, on, "left").select("record_id", found["url_key"], "captured_at", "h", "digest", source.alias("s"))

    etag, modified = F.col("h")["etag"], F.col("h")["last-modified"]
    agrees = (F.when(etag.isNotNull() & F.col("s.answer.etag").isNotNull(), _weak(etag) == _weak(F.col("s.answer.etag")))
              .when(modified.isNotNull() & F.col("s.answer.modified").isNotNull(), modified == F.col("s.answer.modified"))
              .otherwise(F.col("digest") == F.col("s.answer.digest")))
    outcome = (F.when(F.col("s").isNull(), "no_response").when(agrees.isNull(), "unverified")
               .when(agrees, "resolved").otherwise("mismatch"))
    return joined.select("record_id", "url_key", "captured_at", outcome.alias("outcome"), F.col("s.answer.record_id").alias("source_id"),
                         F.when(outcome == "resolved", merged_headers(F.col("s.h"), F.col("h"))).alias("headers"))


def resolve(records: DataFrame, slices: int | None = None) -> DataFrame:
    """``sources`` with the body of each resolved revisit, joined by the
    source's id.  Ids of full responses are unique here, or one of the equal ids' bodies is
    taken (the greatest)."""
    found = sources(records, slices)
    bodies = (records.filter("type = 'response' and status = 200 and body is not null")
              .groupBy(F.col("record_id").alias("body_id")).agg(F.max("body").alias("body")))
    resolved = found["outcome"] == "resolved"
    wanted = F.when(resolved, found["source_id"]).otherwise(found["record_id"])  # spreads the others, which take no body
    return found.join(bodies, (wanted == bodies["body_id"]) & resolved, "left").drop("body_id")


DAY = 86_400


def captures(pages: DataFrame) -> DataFrame:
    """Crawl records of ``pages``: a first response of every page, later
    revisits under variants of its URL, and for some pages a changed second
    response, a stale validator, or a revisit before the first response."""
    page = F.col("page_id")
    at = page * 60
    html, changed = F.coalesce("html", F.lit("")), F.concat(F.coalesce("html", F.lit("")), F.lit("<!-- second -->"))
    second = (page % 5 == 0)

    def headers(etag: Column, date: Column, **more: Column) -> Column:
        fields = {"ETag": etag, "Date": date.cast("string"), **{k.replace("_", "-"): v for k, v in more.items()}}
        return F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*fields.values()))

    def record(k: int, url: Column, when: Column, kind: str, head: Column, body: Column | None, wanted: Column) -> Column:
        return F.when(wanted, F.struct(
            (page * 8 + k).alias("record_id"), url.alias("url"), when.alias("captured_at"), F.lit(kind).alias("type"),
            F.lit(200 if kind == "response" else 304).alias("status"), head.alias("headers"),
            (F.sha2(body, 256) if body is not None else F.lit(None).cast("string")).alias("digest"),
            (body if body is not None else F.lit(None).cast("string")).alias("body")))

    def full(body: Column, when: Column) -> Column:
        return headers(F.md5(body), when, Content_Type=F.lit("text/html"), Content_Length=F.char_length(body).cast("string"))

    def light(tag: Column, when: Column) -> Column:
        return headers(F.concat(F.lit("W/"), tag), when, Content_Length=F.lit("0"), Cache_Control=F.lit("max-age=60"))

    url = F.col("url")
    marked = F.concat(url, F.when(F.contains(url, F.lit("?")), F.lit("&utm_medium=x")).otherwise(F.lit("?utm_medium=x")))
    plain = ~F.contains(url, F.lit("#"))
    after = F.when(second & (page % 7 != 0), F.md5(changed)).otherwise(F.md5(html))
    every = F.lit(True)
    return pages.select(F.inline(F.filter(F.array(
        record(0, url, at - DAY, "revisit", light(F.md5(html), at - DAY), None, page % 11 == 0),
        record(1, url, at, "response", full(html, at), html, every),
        record(2, F.when(plain, marked).otherwise(url), at + DAY, "revisit", light(F.md5(html), at + DAY), None, every),
        record(3, url, at + 2 * DAY, "response", full(changed, at + 2 * DAY), changed, second),
        record(4, url, at + 3 * DAY, "revisit", light(after, at + 3 * DAY), None, every)), lambda r: r.isNotNull())))
