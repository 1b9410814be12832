"""Routing, normalising, envelope and sink rows on hand-written messages."""

from __future__ import annotations

from geofleet.operators import ingest as I
from tests.conftest import ntz

MSG = "msg_id bigint, topic string, payload string"
GOOD_TS = "2024-01-01T00:00:07.179575+00:00"


def normalised(spark, rows):
    return I.normalise_readings(I.route_topic(spark.createDataFrame(rows, MSG)))


def test_routing_and_normalising(spark):
    rows = [
        (1, "iot/d1/geolocation", f'{{"device_id": "d1", "latitude": 51.5, "longitude": 0.1, "timestamp": "{GOOD_TS}"}}'),
        (2, "iot/d1/geolocation", f'{{"latitude": "51.5", "longitude": 0.1, "timestamp": 1704067207179}}'),
        (3, "iot/d1/geolocation", '{"device_id": "d1", "latitude": 51.5, "longitude": 0.1, '
                                  '"timestamp": "2024-01-01T02:00:07.179+02:00"}'),
        (4, "iot/d1/geolocation", '{"device_id": "d1", "latitude": null, "longitude": 0.1, "timestamp": 1}'),
        (5, "iot/d1/geolocation", '{"device_id": "d1", "latitude": 1, "longitude": 0.1, "timestamp": "soon"}'),
        (6, "iot/d1/geolocation", 'not json'),
        (7, "iot/d1/status", f'{{"device_id": "d1", "latitude": 1, "longitude": 1, "timestamp": 1}}'),
        (8, "iot/d1/geolocation", f'{{"device_id": null, "latitude": 1, "longitude": "x", "timestamp": 1}}'),
    ]
    n = normalised(spark, rows)
    acc = {r.msg_id: r for r in I.accepted_readings(n).collect()}
    rej = {r.msg_id: r.reject_reason for r in I.rejected_readings(n).collect()}
    assert set(acc) == {1, 2, 3} and rej == {4: "latitude", 5: "timestamp", 6: "latitude", 8: "longitude"}
    assert acc[1].device_id == "d1" and acc[1].timestamp == 1704067207179
    assert acc[2].device_id == "unknown" and acc[2].latitude == 51.5 and acc[2].timestamp == 1704067207179
    assert acc[3].timestamp == 1704067207179


def test_envelope_round_trip_and_keyed_layout(spark):
    rows = [(i, f"iot/d{i % 3}/geolocation",
             f'{{"device_id": "d{i % 3}", "latitude": {i}.25, "longitude": -0.5, "timestamp": {1000 + (50 - i)}}}')
            for i in range(40)]
    acc = I.accepted_readings(normalised(spark, rows))
    env = I.envelope(acc)
    first = env.first().value
    assert first.startswith('{"schema":{"type":"struct"') and '"payload":{"device_id":' in first
    back = I.decode_envelope(env).orderBy("msg_id").collect()
    assert [(r.msg_id, r.device_id, r.latitude, r.timestamp) for r in back] == \
        [(r.msg_id, r.device_id, r.latitude, r.timestamp) for r in acc.orderBy("msg_id").collect()]
    # each key in one partition; offsets dense per partition, in order of arrival
    by_part: dict[int, list] = {}
    for r in I.keyed_publish(env, partitions=3).collect():
        by_part.setdefault(r.partition, []).append(r)
    assert sum(len({r.key for r in rows}) for rows in by_part.values()) == 3
    for part_rows in by_part.values():
        by_offset = sorted(part_rows, key=lambda r: r.offset)
        assert [r.offset for r in by_offset] == list(range(len(part_rows)))
        assert [r.msg_id for r in by_offset] == sorted(r.msg_id for r in part_rows)


def test_the_json_type_of_a_timestamp_decides(spark):
    payload = '{"device_id": "d", "latitude": 1, "longitude": 1, "timestamp": %s}'
    rows = [(i, "iot/d/geolocation", payload % t) for i, t in enumerate(
        ["20240115", '"20240115"', '"2024-01-15"', '"1705276800000"', "1705276800000", ' "20240115T100000Z"'])]
    n = normalised(spark, rows)
    assert {r.msg_id: r.timestamp for r in I.accepted_readings(n).collect()} == {
        0: 20240115, 1: 1705276800000, 2: 1705276800000, 4: 1705276800000, 5: 1705312800000}
    assert {r.msg_id: r.reject_reason for r in I.rejected_readings(n).collect()} == {3: "timestamp"}


def test_the_payloads_own_timestamp_counts(spark):
    """Not a nested one, nor its spelling: members are found by parsing."""
    rows = [(1, "iot/d/geolocation", '{"latitude":1,"longitude":2,"timestamp":1705312800000,"meta":{"timestamp":"x"}}'),
            (2, "iot/d/geolocation", '{"latitude":1,"longitude":2,"\\u0074imestamp":"20240115"}'),
            (3, "iot/d/geolocation", '{"meta":{"timestamp":7},"latitude":"1e1","longitude":-2.5,"timestamp":1705312800000.75}'),
            (4, "iot/d/geolocation", '{"device_id":5,"latitude":1,"longitude":2,"timestamp":1.7053128E12,"note":"\\"timestamp\\": \\"x"}'),
            (5, "iot/d/geolocation", '{"meta":{"timestamp":7},"latitude":1,"longitude":2}'),
            (6, "iot/d/geolocation", None), (7, "iot/d/geolocation", "[1]"), (8, "iot/d/geolocation", "")]
    n = normalised(spark, rows)
    assert {r.msg_id: (r.device_id, r.latitude, r.timestamp) for r in I.accepted_readings(n).collect()} == {
        1: ("unknown", 1.0, 1705312800000), 2: ("unknown", 1.0, 1705276800000), 3: ("unknown", 10.0, 1705312800000), 4: ("5", 1.0, 1705312800000)}
    assert {r.msg_id: r.reject_reason for r in I.rejected_readings(n).collect()} == {5: "timestamp", 6: "latitude", 7: "latitude", 8: "latitude"}


def test_a_payload_is_parsed_once(spark):
    n = normalised(spark, [(1, "iot/d/geolocation", "{}")])
    plan = I.accepted_readings(n)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") + plan.count("parse_json") == 1


def test_sink_rows(spark):
    acc = spark.createDataFrame([(5, "d1", 1.0, 2.0, 1704067207179)],
                                "msg_id bigint, device_id string, latitude double, longitude double, timestamp bigint")
    r = I.sink_rows(acc, ntz("2024-01-30 00:00:00"), id_base=1000).first()
    assert r.id == 1005 and r.event_ts == ntz("2024-01-01 00:00:07.179") and r.ingested_at == ntz("2024-01-30 00:00:00")
    assert I.sink_rows(acc, ntz("2024-01-30 00:00:00")).columns == I.SOURCE_ROW_COLUMNS
