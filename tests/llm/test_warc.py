from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from geofleet.llm import warc
from tests.llm.helpers import by_id

SCHEMA = "record_id long, warc_type string, target_uri string, warc_date timestamp, headers map<string,string>, payload_digest string, url string, at string"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def records(spark, rows):
    """rows: (id, type, uri, second, headers, digest)."""
    made = [(i, kind, uri, None if at is None else T0 + dt.timedelta(seconds=at), headers, digest, "clash", "clash") for i, kind, uri, at, headers, digest in rows]
    return spark.createDataFrame(made, SCHEMA)


def test_canonical_url(spark):
    cases = {
        "https://WWW.Example.com:443/a/?b=2&a=1&utm_source=x#frag": "example.com/a?a=1&b=2", "http://example.com": "example.com", "http://example.com/": "example.com",
        "http://u:p@www2.example.com:8080/x/": "example.com:8080/x", "//example.com./p?ref=z": "example.com/p", "not a url#x": "not a url", "": "", None: None,
        "https://example.com/A?Q=1&q=": "example.com/A?Q=1&q=", "ftp://h:21/é?x#": "h:21/é?x",
    }
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "i int, u string").select("i", warc.canonical_url(F.col("u")).alias("c"))
    assert [r.c for r in df.orderBy("i").collect()] == list(cases.values())


def test_statuses_and_header_merge(spark):
    full = {"ETag": '"a"', "Last-Modified": "d1", "Content-Type": "text/html", "Content-Length": "9", "X-Old": "1"}
    out = by_id(warc.resolve_revisits(records(spark, [
        (1, "response", "http://x.org/p", 10, full, "D1"),
        (2, "response", "http://x.org/p", 20, {"etag": 'W/"b"'}, "D2"),
        (3, "revisit", "https://www.x.org/p/", 15, {"etag": 'W/"a"', "content-length": "0", "content-type": "x", "Connection": "X-Hop", "x-hop": "1", "x-new": "2", "X-OLD": "3"}, None),
        (4, "revisit", "http://x.org/p", 10, {"etag": '"a"'}, None),       # not strictly earlier
        (5, "revisit", "http://x.org/p", 30, {"ETag": '"b"'}, None),
        (6, "revisit", "http://x.org/p", 30, {"ETag": '"a"'}, None),       # of an older response
        (7, "revisit", "http://x.org/p", 16, {"last-modified": "d1"}, None),
        (8, "revisit", "http://x.org/p", 16, {"last-modified": "d2"}, None),
        (9, "revisit", "http://x.org/p", 16, {"etag": "", "date": "now"}, None),
        (10, "revisit", "http://other.org/", 16, {"etag": '"a"'}, None),
        (11, "revisit", None, 16, {"etag": '"a"'}, None),
        (12, "revisit", "http://x.org/p", None, {"etag": '"a"'}, None),
        (13, "revisit", "http://x.org/p", 16, None, None),
        (14, "request", "http://x.org/p", 16, {"etag": '"a"'}, None),
        (15, "response", None, None, None, None),
    ])), "record_id")
    assert sorted(out) == list(range(3, 14))
    assert {i: r["status"] for i, r in out.items()} == {
        3: "resolved", 4: "no_earlier_response", 5: "resolved", 6: "validator_mismatch", 7: "resolved", 8: "validator_mismatch", 9: "no_validator",
        10: "no_earlier_response", 11: "no_earlier_response", 12: "no_earlier_response", 13: "no_validator"}
    assert out[3]["headers"] == {"etag": 'W/"a"', "last-modified": "d1", "content-type": "text/html", "content-length": "9", "x-old": "3", "x-new": "2"}
    assert out[3]["response_id"] == 1 and out[3]["payload_digest"] == "D1" and out[5]["payload_digest"] == "D2" and out[6]["payload_digest"] is None
    assert out[9]["headers"] == {"etag": "", "date": "now"} and out[13]["headers"] == {}


def test_hot_url_matches_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        url = "http://hot.org/" if rng.random() < 0.6 else f"http://h{rng.randint(0, 20)}.org/"
        kind = rng.choice(["response", "revisit", "revisit"])
        rows.append((i, kind, url, rng.randint(0, 300), {"etag": str(rng.randint(0, 2))}, f"d{i}"))
    out = by_id(warc.resolve_revisits(records(spark, rows).repartition(7)), "record_id")
    for i, kind, url, at, headers, _ in rows:
        if kind == "revisit":
            earlier = max(((t, j, h, d) for j, k, u, t, h, d in rows if k == "response" and u == url and t < at), default=None, key=lambda x: x[:2])
            assert out[i]["response_id"] == (earlier and earlier[1])
            assert out[i]["payload_digest"] == (earlier[3] if earlier and earlier[2] == headers else None)


def test_repeated_records_and_empty_input(spark):
    row = (1, "revisit", "http://x.org", 5, {"etag": "1"}, None)
    first = (0, "response", "http://x.org", 1, {"etag": "1"}, "D")
    assert [r.status for r in warc.resolve_revisits(records(spark, [first, row, row, first])).collect()] == ["resolved"] * 2
    assert warc.resolve_revisits(records(spark, [])).count() == 0


def test_captures_have_two_records_of_each_page(spark):
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, None, None), (19, "http://a", "")], "page_id long, url string, html string")
    out = warc.captures(pages)
    assert out.count() == 6 and warc.resolve_revisits(out).count() == 3
