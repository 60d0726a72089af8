"""WARC revisits: a not-modified record stands for the latest earlier full response of its canonical URL.

An as-of join by URL and date. Records are cut into blocks at approximate quantiles of the date; the latest response is
a running maximum within a URL's block, and what earlier blocks hand on is a running maximum over the URL's blocks, of
which there are few. So a URL with a third of all records is spread over all blocks. Only digests and headers take part:
payloads stay where they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import saved, small

#: Records of a block, about, and the most blocks (borders are a literal of the plan).
BLOCK_RECORDS, MAX_BLOCKS = 50_000, 512
#: Header fields that a 304 may update; all others stay as stored.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that name no resource.
TRACKING = ("fbclid", "gclid", "ref")


def canonical_url(url: Column) -> Column:
    """Lower-case host without www., scheme, user, default port and fragment; the path without a closing slash; query
    parameters sorted, without utm_* and TRACKING. Null stays null; what has no host is kept, lower-cased."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    part = lambda k: F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?@]*@)?([^/?:]*)(?::(\d*))?([^?]*)(?:\?(.*))?$", k)
    host = F.regexp_replace(F.lower(part(1)), r"^www\.", "")
    port = F.when(part(2).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), part(2)))
    path = F.regexp_replace(part(3), "/+$", "")
    named = F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).rlike("^(utm_.*|" + "|".join(TRACKING) + ")$"))
    query = F.array_join(F.array_sort(named), "&")
    return F.when(host == "", F.lower(u)).otherwise(F.concat(host, port, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def same_validator(revisit: Column, response: Column) -> Column:
    """Entity tags decide if both have one (weakly compared), else dates of last modification, else payload digests; false
    if there is nothing to compare."""
    tag = lambda c: F.regexp_replace(c["etag"], "^W/", "")
    return F.coalesce(tag(revisit) == tag(response), revisit["last_modified"] == response["last_modified"], revisit["digest"] == response["digest"], F.lit(False))


def merged_headers(stored: Column, update: Column, permitted=PERMITTED) -> Column:
    """stored and update: arrays of (name, value), names in lower case. Permitted fields of the update replace stored ones
    of their name. Sorted; null counts as empty."""
    empty = F.array().cast("array<struct<name:string,value:string>>")
    new = F.filter(F.coalesce(update, empty), lambda h: h["name"].isin(*permitted))
    kept = F.filter(F.coalesce(stored, empty), lambda h: ~F.exists(new, lambda n: n["name"] == h["name"]))
    return F.array_sort(F.concat(kept, new))


def resolve(records: DataFrame, permitted=PERMITTED) -> DataFrame:
    """records: record_id long, url, date long, kind ('response' for a full one, 'revisit', others are left
    out), etag, last_modified, digest (strings), headers array<struct<name, value>>.

    A row per revisit: record_id, url (canonical), date, status, refers_to, digest, headers. The latest response of the
    URL with an earlier date counts, of equal dates the one with the largest id. status: resolved if the validators
    agree, mismatch if not, orphan if there is none; only resolved ones have refers_to, digest and merged headers.
    Null URLs equal nothing and revisits without one are orphans, as are those without a date; responses without either
    aren't seen. Repeated records give repeated rows, a null id is the smallest, an empty table gives no rows; extra
    columns aren't read."""
    slim = records.where(F.col("kind").isin("response", "revisit")).select("record_id", canonical_url(F.col("url")).alias("url"), F.col("date").cast("long").alias("date"), "kind", "etag", "last_modified", "digest", "headers")
    slim = saved(slim, "warc-records")
    n = slim.count()
    k = min(MAX_BLOCKS, max(1, -(-n // BLOCK_RECORDS)))
    cuts = sorted({int(x) for x in slim.select(F.col("date").cast("double").alias("x")).approxQuantile("x", [i / k for i in range(1, k)], 1 / (4 * k))}) if k > 1 else []
    block = F.size(F.filter(F.array(*(F.lit(c) for c in cuts)).cast("array<bigint>"), lambda c: c <= F.col("date"))) if cuts else F.lit(0)
    response = F.when(F.col("kind") == "response", F.struct("date", "record_id", "etag", "last_modified", "digest", "headers"))
    placed = F.col("url").isNotNull() & F.col("date").isNotNull()
    df = slim.where(placed).withColumns({"block": block, "response": response})
    handed = df.where("response is not null").groupBy("url", "block").agg(F.max("response").alias("last"))
    # Blocks that hold a record of the URL, each with the latest response of those before.
    places = df.select("url", "block").distinct().join(handed, ["url", "block"], "left")
    carried = saved(places.withColumn("carried", F.max("last").over(W.partitionBy("url").orderBy("block").rowsBetween(W.unboundedPreceding, -1))).where("carried is not null").select("url", "block", "carried"), "warc-carried")
    inside = W.partitionBy("url", "block").orderBy("date").rangeBetween(W.unboundedPreceding, -1)
    df = df.withColumn("found", F.max("response").over(inside)).where("kind = 'revisit'")
    df = df.join(small(carried), ["url", "block"], "left").withColumn("found", F.coalesce("found", "carried")).drop("carried", "block", "response")
    df = df.unionByName(slim.where(~placed & (F.col("kind") == "revisit")).withColumn("found", F.lit(None).cast(df.schema["found"].dataType)))
    ok = F.col("found").isNotNull() & same_validator(F.struct("etag", "last_modified", "digest"), F.col("found"))
    status = F.when(F.col("found").isNull(), "orphan").when(ok, "resolved").otherwise("mismatch")
    found = lambda c: F.when(ok, c)
    return df.select("record_id", "url", "date", status.alias("status"), found(F.col("found.record_id")).alias("refers_to"), found(F.col("found.digest")).alias("digest"), found(merged_headers(F.col("found.headers"), F.col("headers"), permitted)).alias("headers"))


def payloads(resolved: DataFrame, responses: DataFrame, id_col: str = "record_id", payload_col: str = "payload") -> DataFrame:
    """resolved with the payload of the response that each revisit refers to."""
    bodies = responses.select(F.col(id_col).alias("refers_to"), F.col(payload_col))
    return resolved.join(bodies, "refers_to", "left")


def captures(pages: DataFrame) -> DataFrame:
    """A crawl log made of pages: each page is fetched in full at 10 * page_id and asked for again at another time with
    the validators that the crawler then has: those of the page, of a newer version (page_id % 5 = 0), or only a date
    (page_id % 3 = 0); some before any full response (page_id % 7 = 0)."""
    head = lambda *h: F.array(*(F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in h))
    p, tag, body = F.col("page_id"), F.md5(F.coalesce("html", F.lit(""))), F.sha2(F.coalesce("html", F.lit("")), 256)
    day = F.concat(F.lit("day "), p.cast("string"))
    kind = lambda k: F.lit(k).alias("kind")
    full = pages.select(
        (2 * p).alias("record_id"), "url", (10 * p).alias("date"), kind("response"), tag.alias("etag"), day.alias("last_modified"), body.alias("digest"),
        head(("content-type", F.lit("text/html")), ("date", day), ("etag", tag), ("content-length", F.length(F.coalesce("html", F.lit(""))).cast("string"))).alias("headers"),
    )
    sent = F.when(p % 3 == 0, F.lit(None).cast("string")).when(p % 5 == 0, F.md5(F.concat(F.lit("newer"), F.coalesce("html", F.lit(""))))).otherwise(F.concat(F.lit("W/"), tag))
    again = pages.select(
        (2 * p + 1).alias("record_id"), "url", F.when(p % 7 == 0, 10 * p - 5).otherwise(10 * p + 10 * (p % 1000) + 5).alias("date"), kind("revisit"), sent.alias("etag"), day.alias("last_modified"), F.lit(None).cast("string").alias("digest"),
        head(("date", F.concat(F.lit("later than "), day)), ("content-length", F.lit("0")), ("cache-control", F.lit("max-age=60"))).alias("headers"),
    )
    return full.unionByName(again)
