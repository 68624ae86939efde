"""Resolution of not-modified revisits in web archives.

A revisit record of profile "server not modified" has no payload.  It resolves to
the latest earlier full response of its canonical URL, if the validators agree, and
takes that response's headers, updated by those that a 304 may update.

The as-of join works in time slices: inside a slice of a URL a window carries the
last response forward; across slices only one row per URL and slice is looked at.  A
URL with a third of all records is spread over its slices, and a slice is streamed
in order, never collected.

Defined results: a record without a canonical URL or a time neither resolves nor is
resolved to (``no_url``, ``no_time``); of records at the same time the smaller id
counts as earlier; a validator that one side lacks is not checked, and a pair without
any common validator resolves as ``unchecked``; null header maps count as empty;
repeated records resolve each; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: width of a time slice in seconds
SLICE = 86_400

# fixed values: headers that a not-modified answer must not update
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
# fixed values: query parameters that do not name a resource
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a final
    slash, sorted query without tracking parameters, no scheme, user or fragment."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*@)?([^/?]*)([^?]*)(\?.*)?$", 2)
    path = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*@)?([^/?]*)([^?]*)(\?.*)?$", 3)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(rest), r":(80|443)$", ""), r"^www\.", "")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))
    tail = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(F.lit("")))
    return F.when(host != "", whole)


def _strong(tag: Column) -> Column:
    """An entity tag without its weakness mark: the weak comparison."""
    return F.regexp_replace(tag, "^W/", "")


def lower_keys(headers: Column) -> Column:
    """Headers with keys in lower case; of keys that then clash the last stays."""
    pairs = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    keys = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    last = lambda k: F.element_at(F.filter(pairs, lambda e: e["key"] == k), -1)["value"]
    return F.map_from_arrays(keys, F.transform(keys, last))


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers updated by those of a not-modified answer that may update them."""
    allowed = F.map_filter(update, lambda k, v: ~k.isin(*NOT_UPDATED))
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def resolve(records: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """Resolve the revisits of ``records(record_id, record_type, url, ts, digest, headers)``,
    ``ts`` in seconds: ``(record_id, url, status, refers_to, digest, headers)``."""
    url = canonical_url(F.col("url"))
    r = records.where(F.col("record_type").isin("response", "revisit")).select(
        "record_id", (F.col("record_type") == "response").alias("full"), url.alias("url"), F.col("ts").cast("bigint").alias("ts"), "digest",
        lower_keys(F.col("headers")).alias("headers"),
    )
    r = r.withColumn("slice", F.floor(F.col("ts") / slice_seconds))
    at_place = r.where("url IS NOT NULL AND ts IS NOT NULL")
    answer = F.struct("ts", "record_id", "digest", "headers")
    order = Window.partitionBy("url", "slice").orderBy("ts", "record_id", F.desc("full"))
    seen = at_place.withColumn("before", F.last(F.when(F.col("full"), answer), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    revisits = seen.where("NOT full")
    # the last response of each slice, and of all slices before
    newest = lambda: F.max_by(F.struct("digest", "headers"), F.struct("ts", "record_id"))
    last = at_place.where("full").groupBy("url", "slice").agg(F.max(F.struct("ts", "record_id")).alias("at"), newest().alias("what"))
    last = last.select("url", "slice", F.struct("at.ts", "at.record_id", "what.digest", "what.headers").alias("response"))
    wanted = revisits.where("before IS NULL").select("url", "slice").distinct()
    slices = last.unionByName(wanted.withColumn("response", F.lit(None).cast(last.schema["response"].dataType)))
    slices = slices.groupBy("url", "slice").agg(F.first("response", ignorenulls=True).alias("response"))
    chain = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = slices.select("url", "slice", F.last("response", ignorenulls=True).over(chain).alias("earlier")).where("earlier IS NOT NULL")
    found = revisits.join(earlier, ["url", "slice"], "left").withColumn("to", F.coalesce("before", "earlier")).drop("before", "earlier")
    lost = r.where("NOT full AND (url IS NULL OR ts IS NULL)").withColumn("to", F.lit(None).cast(found.schema["to"].dataType))
    return _judged(found.unionByName(lost.select(*found.columns)))


def _judged(found: DataFrame) -> DataFrame:
    both = lambda a, b: a.isNotNull() & b.isNotNull()
    mine, its = (lambda name: F.element_at("headers", name)), (lambda name: F.element_at("to.headers", name))
    checks = [
        (F.col("digest"), F.col("to.digest")),
        (_strong(mine("etag")), _strong(its("etag"))),
        (mine("last-modified"), its("last-modified")),
    ]
    differs, agrees = F.lit(False), F.lit(False)
    for a, b in checks:
        differs = differs | (both(a, b) & (a != b))
        agrees = agrees | (both(a, b) & (a == b))
    status = (
        F.when(F.col("url").isNull(), "no_url")
        .when(F.col("ts").isNull(), "no_time")
        .when(F.col("to").isNull(), "no_earlier_response")
        .when(F.coalesce(differs, F.lit(False)), "validator_mismatch")
        .when(F.coalesce(agrees, F.lit(False)), "resolved")
        .otherwise("unchecked")
    )
    ok = F.col("status").isin("resolved", "unchecked")
    return found.withColumn("status", status).select(
        "record_id", "url", "status", F.when(ok, F.col("to.record_id")).alias("refers_to"), F.when(ok, F.col("to.digest")).alias("digest"),
        F.when(ok, merged_headers(F.col("to.headers"), F.col("headers"))).alias("headers"),
    )


def records_of(pages: DataFrame) -> DataFrame:
    """Capture records that follow from ``pages(page_id, url, html)``: every page's first
    full answer, a changed second one for each fifth page, and not-modified revisits
    under other spellings of the URL, some before any answer and some with stale
    validators."""
    i = F.col("page_id")
    start = F.lit(1_700_000_000) + F.pmod(i * 7919, F.lit(30)) * 86_400 + F.pmod(i * 104_729, F.lit(86_400))
    body = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    pages = cut_columns(pages.select("page_id", "url", start.alias("start"), body.alias("body")))
    second = F.md5(F.concat("body", F.lit("2")).cast("binary"))
    tag = lambda d: F.concat(F.lit('"'), F.left(d, F.lit(16)), F.lit('"'))
    day = lambda t: F.from_unixtime(t, "yyyy-MM-dd")
    join = F.when(F.col("url").contains("?"), "&").otherwise("?")
    plain = F.regexp_replace("url", "#.*$", "")

    def full(n: int, after: int, digest: Column, when: Column) -> Column:
        headers = F.create_map(F.lit("ETag"), tag(digest), F.lit("Last-Modified"), day(F.col("start") + after), F.lit("Content-Type"), F.lit("text/html"), F.lit("Cache-Control"), F.lit("max-age=60"))
        return F.when(when, _record(i * 8 + n, "response", F.col("url"), F.col("start") + after, digest, headers))

    def again(n: int, after: int, url: Column, etag: Column, when: Column) -> Column:
        headers = F.create_map(F.lit("etag"), etag, F.lit("Content-Length"), F.lit("0"), F.lit("cache-control"), F.concat(F.lit("max-age="), F.lit(str(60 * n))), F.lit("X-Cache"), F.lit("HIT"))
        return F.when(when, _record(i * 8 + n, "revisit", url, F.col("start") + after, F.lit(None).cast("string"), headers))

    yes = F.lit(True)
    rows = F.array(
        again(0, -3600, F.col("url"), tag(F.col("body")), F.pmod(i, F.lit(7)) == 0),
        full(1, 0, F.col("body"), yes),
        again(2, 90_000, F.concat(plain, join, F.lit("utm_source=feed")), F.concat(F.lit("W/"), tag(F.col("body"))), yes),
        full(3, 180_000, second, F.pmod(i, F.lit(5)) == 0),
        again(4, 270_000, F.concat(F.col("url"), F.lit("#top")), F.when(F.pmod(i, F.lit(5)) == 0, tag(second)).otherwise(tag(F.col("body"))), yes),
        again(5, 300_000, F.regexp_replace("url", "^https?", "HTTP"), tag(F.col("body")), F.pmod(i, F.lit(3)) == 0),
    )
    return pages.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select("x.*")


def cut_columns(df: DataFrame) -> DataFrame:
    """Keep later expressions from repeating the ones so far."""
    return df.where(F.coalesce(F.length("body"), F.lit(0)) >= 0)


def _record(record_id: Column, kind: str, url: Column, ts: Column, digest: Column, headers: Column) -> Column:
    return F.struct(record_id.alias("record_id"), F.lit(kind).alias("record_type"), url.alias("url"), ts.cast("bigint").alias("ts"), digest.alias("digest"), headers.alias("headers"))
