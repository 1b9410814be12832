"""Property tests: helpers against brute-force Python on generated inputs.

Each property draws a whole list of cases and checks them in one Spark job.
"""

from __future__ import annotations

import datetime as dt
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from geofleet.functions.time import (
    MICROS_PER_HOUR,
    epoch_millis_to_ntz,
    floor_ntz,
    iso_text,
    minute_boundaries_between,
    ntz_epoch_millis,
    reading_time_to_millis,
)
from geofleet.functions.topics import topic_filter_regex
from geofleet.operators.ranking import ordinal, sorted_position

EPOCH = dt.datetime(1970, 1, 1)
times = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2040, 1, 1))
SETTINGS = settings(max_examples=5, deadline=None)


def minute_index(t: dt.datetime) -> int:
    return (t - EPOCH) // dt.timedelta(minutes=1)


@SETTINGS
@given(st.lists(st.tuples(times, times), min_size=1, max_size=200))
def test_minute_boundaries(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(minute_boundaries_between("a", "b")).collect()]
    assert got == [minute_index(b) - minute_index(a) for a, b in pairs]


@SETTINGS
@given(st.lists(times, min_size=1, max_size=200))
def test_epoch_iso_floor(spark, ts):
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    rows = df.select(ntz_epoch_millis("t").alias("ms"), iso_text("t").alias("iso"),
                     floor_ntz("t", MICROS_PER_HOUR).alias("h"),
                     epoch_millis_to_ntz(ntz_epoch_millis("t")).alias("back")).collect()
    for t, r in zip(ts, rows):
        assert r.ms == (t - EPOCH) // dt.timedelta(milliseconds=1)
        assert r.iso == t.isoformat()
        assert r.h == t.replace(minute=0, second=0, microsecond=0)
        assert r.back == t.replace(microsecond=t.microsecond // 1000 * 1000)


offsets = st.integers(min_value=-12 * 60, max_value=14 * 60).map(lambda m: dt.timedelta(minutes=m))


@SETTINGS
@given(st.lists(st.tuples(times, offsets, st.booleans(), st.booleans()), min_size=1, max_size=200),
       st.sampled_from(["UTC", "America/New_York", "Asia/Kolkata"]))
def test_reading_time_matches_python(spark, cases, zone):
    texts, want = [], []
    for t, off, as_number, basic in cases:
        utc_ms = (t - EPOCH) // dt.timedelta(milliseconds=1)
        if as_number:
            texts.append((str(utc_ms), True))
        else:
            aware = (t + off).replace(tzinfo=dt.timezone(off))
            texts.append((aware.strftime("%Y%m%dT%H%M%S.%f%z") if basic and t.year > 999 else aware.isoformat(), False))
            assert int(aware.timestamp() * 1000) in (utc_ms, utc_ms - 1, utc_ms + 1)  # float path of the original
        want.append(utc_ms)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [r[0] for r in spark.createDataFrame(texts, "t string, n boolean").select(reading_time_to_millis("t", F.col("n"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def mqtt_match(flt: str, topic: str) -> bool:
    f, t = flt.split("/"), topic.split("/")
    for i, level in enumerate(f):
        if level == "#":
            return True
        if i >= len(t) or (level != "+" and level != t[i]):
            return False
    return len(f) == len(t)


levels = st.sampled_from(["iot", "a", "b", "geolocation", ""])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["iot", "a", "+", "geolocation"]), min_size=1, max_size=4),
       st.booleans(), st.lists(levels, min_size=1, max_size=5))
def test_topic_filter_regex(parts, hash_tail, topic_levels):
    flt = "/".join(parts + (["#"] if hash_tail else []))
    topic = "/".join(topic_levels)
    assert bool(re.match(topic_filter_regex(flt), topic)) == mqtt_match(flt, topic)


@SETTINGS
@given(st.lists(st.text(alphabet="abcdefgh-0123", min_size=0, max_size=6), min_size=1, max_size=300, unique=True),
       st.integers(min_value=1, max_value=9))
def test_sorted_position(spark, keys, partitions):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.position for r in sorted_position(df, "k", partitions=partitions).collect()}
    # Spark orders strings by UTF-8 bytes; the alphabet is ASCII so Python's order agrees.
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    assert not any(math.isnan(v) for v in got.values())


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=3), st.integers(min_value=-5, max_value=5)),
                min_size=1, max_size=300),
       st.integers(min_value=1, max_value=9))
def test_ordinal_within_group(spark, rows, partitions):
    """Position inside each group in (k, id) order equals a brute-force per-group ranking."""
    data = [(i, g, k) for i, (g, k) in enumerate(rows)]
    df = spark.createDataFrame(data, "id bigint, g int, k int")
    got = {r.id: r.pos for r in ordinal(df, ["k"], "id", out="pos", group="g", partitions=partitions).collect()}
    want = {}
    for g in {g for _, g, _ in data}:
        members = sorted((k, i) for i, gg, k in data if gg == g)
        want.update({i: n for n, (_, i) in enumerate(members)})
    assert got == want
