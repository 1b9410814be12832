"""Operator 3: resolving not-modified WARC revisits. DataFrame functions only.

A revisit record (a server's "304 Not Modified") has headers but no content. It is resolved against the latest full
response of the same canonical URL captured strictly earlier: an as-of join. The validators must agree (entity tags by weak comparison; the modification
date where the revisit has no entity tag), and the result's headers are the response's, updated by those
of the revisit that a 304 may update.

As-of join: records are range-partitioned by (URL, time) and stored with their partition's number, so a URL that holds most
records is cut into consecutive time slices. Within each (slice, URL) a running maximum finds the latest earlier response;
what came before the slice is carried in from the URL's earlier slices, one row for each slice and URL. Contents aren't moved:
a result names its response and carries the payload digest.

Defined results (status): "resolved"; "no_earlier_response" (also for a null URL or time); "no_validator" (the revisit has
neither an entity tag nor a modification date); "validator_mismatch". Unresolved revisits keep their own headers. Of responses tied on time the one
of the largest record id counts. Repeated records are repeated in the result; header names are compared in lower case, the last of equal names counts;
null headers count as none; records of other types are ignored; extra columns are ignored; no records, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geofleet.llm.common import cut

#: Fields that a 304 may not update: the connection's own, and those that describe the stored content.
NOT_UPDATED = ("connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer",
               "transfer-encoding", "upgrade", "content-length", "content-encoding", "content-type", "content-range")
#: Query parameters that don't change what is served.
TRACKING = "utm_[a-z]+|gclid|fbclid|msclkid|ref|sessionid|sid|phpsessid"
URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, user, www, default port, fragment, tracking parameters and trailing slash; sorted parameters.

    Null for null; a text that isn't an absolute URL stays as it is, without its fragment.
    """
    part = lambda n: F.regexp_extract(url, URL, n)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(1)), r"^www[0-9]*\.", ""), r"\.$", "")
    port = F.when(part(2).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), part(2)))
    path = F.regexp_replace(part(3), "/+$", "")
    kept = F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~F.lower(p).rlike(f"^(?:{TRACKING})(?:=|$)"))
    query = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, port, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(url.rlike(URL), whole).otherwise(F.regexp_replace(url, "#.*$", ""))


def _lowered(headers: Column) -> Column:
    """Headers as array<struct<name, value>>, names in lower case and once each, in order of name."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("name"), e["value"].alias("value")))
    last = F.aggregate(entries, F.array().cast("array<struct<name:string,value:string>>"), lambda s, e: F.concat(
        F.filter(s, lambda x: x["name"] != e["name"]), F.array(e)))
    return F.coalesce(F.array_sort(last), F.array().cast("array<struct<name:string,value:string>>"))


def _header(headers: Column, name: str) -> Column:
    value = F.trim(F.get(F.filter(headers, lambda e: e["name"] == name), F.lit(0))["value"])
    return F.when(value != "", value)


def merged_headers(response: Column, revisit: Column) -> Column:
    """Both array<struct<name, value>>: the response's headers, updated by those that the revisit may update."""
    named = F.split(F.lower(F.coalesce(_header(revisit, "connection"), F.lit(""))), r"\s*,\s*")
    new = F.filter(revisit, lambda e: ~e["name"].isin(*NOT_UPDATED) & ~F.array_contains(named, e["name"]))
    old = F.filter(response, lambda e: ~F.exists(new, lambda x: x["name"] == e["name"]))
    return F.array_sort(F.concat(old, new))


def latest_earlier_response(records: DataFrame) -> DataFrame:
    """records(url, at, record_id, warc_type, headers, payload_digest) -> its revisits, each with ``response``: the struct (at, record_id, headers,
    payload_digest) of the latest earlier response of its URL, or null. ``at`` is a bigint; url and at aren't null."""
    placed = cut(records.repartitionByRange("url", "at").withColumn("slice", F.spark_partition_id()))
    own = F.when(F.col("warc_type") == "response", F.struct("at", "record_id", "headers", "payload_digest"))
    before = Window.partitionBy("slice", "url").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("response", F.max(own).over(before)).where("warc_type = 'revisit'")
    earlier = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (placed.groupBy("url", "slice").agg(F.max(own).alias("latest"))
               .select("url", "slice", F.max("latest").over(earlier).alias("carried")).where("carried is not null"))
    return inside.join(carried, ["url", "slice"], "left").withColumn("response", F.coalesce("response", "carried")).drop("carried", "slice")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit of records(record_id long, warc_type, target_uri, warc_date timestamp, headers map, payload_digest):

    record_id, canonical_url, response_id, status, validator, payload_digest, headers map<string, string>.
    """
    named = records.where(F.col("warc_type").isin("response", "revisit")).select(
        "record_id", "warc_type", canonical_url(F.col("target_uri")).alias("url"), F.unix_micros(F.col("warc_date").cast("timestamp")).alias("at"),
        _lowered(F.col("headers")).alias("headers"), "payload_digest")
    placed = "url is not null and at is not null"
    lost = named.where(f"warc_type = 'revisit' and not ({placed})")
    found = latest_earlier_response(named.where(placed)).unionByName(lost, allowMissingColumns=True)

    weak = lambda tag: F.regexp_replace(tag, r"^[Ww]/", "")
    tag, date, r = _header(F.col("headers"), "etag"), _header(F.col("headers"), "last-modified"), F.col("response")
    agrees = F.when(tag.isNotNull(), weak(tag) == weak(_header(r["headers"], "etag"))).otherwise(date == _header(r["headers"], "last-modified"))
    status = (F.when(r.isNull(), "no_earlier_response").when(tag.isNull() & date.isNull(), "no_validator")
              .when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("validator_mismatch"))
    judged = found.withColumn("status", status).withColumn("validator", F.when(tag.isNotNull(), "etag").when(date.isNotNull(), "last-modified"))
    resolved = F.col("status") == "resolved"
    headers = F.when(resolved, merged_headers(r["headers"], F.col("headers"))).otherwise(F.col("headers"))
    return judged.select("record_id", F.col("url").alias("canonical_url"), r["record_id"].alias("response_id"), "status", "validator",
                         F.when(resolved, r["payload_digest"]).alias("payload_digest"), F.map_from_entries(headers).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """WARC records derived from pages(page_id, url, html): each page is a response and, some days later, a revisit.

    Times and the headers present follow from the page's id, validators from its content.
    """
    hours = lambda h: F.timestamp_seconds(F.lit(1_704_067_200) + h * 3600)
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    page = F.col("page_id")
    at, later = page % 5003, page % 5003 + 1 + page * 31 % 1009
    modified = F.concat(F.lit("day "), F.floor(at / 24).cast("string"))
    response = F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), modified, F.lit("Content-Type"), F.lit("text/html"),
                            F.lit("Content-Length"), F.octet_length("html").cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"))
    tagged = F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("Cache-Control"), F.lit("max-age=3600"), F.lit("Content-Length"), F.lit("0"))
    dated = F.create_map(F.lit("last-modified"), modified, F.lit("Age"), F.lit("5"), F.lit("Connection"), F.lit("Age"))
    bare = F.create_map(F.lit("Date"), modified)
    kinds = F.array(
        F.struct((page * 2).alias("record_id"), F.lit("response").alias("warc_type"), hours(at).alias("warc_date"), response.alias("headers"), F.md5("html").alias("payload_digest")),
        F.struct((page * 2 + 1).alias("record_id"), F.lit("revisit").alias("warc_type"), hours(later).alias("warc_date"),
                 F.when(page % 10 < 6, tagged).when(page % 10 < 9, dated).otherwise(bare).alias("headers"), F.lit(None).cast("string").alias("payload_digest")))
    return pages.select(F.col("url").alias("target_uri"), F.explode(kinds).alias("r")).select("target_uri", "r.*")
