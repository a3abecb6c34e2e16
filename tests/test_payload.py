from __future__ import annotations

import json

from pyspark.sql import functions as F

from helpers import body, plan_of, records, utc
from lakestream.functions import payload as p
from lakestream.operators.quality import drop_malformed
from lakestream.schemas import READING_V1, READING_V2


def test_a_reading_with_its_lineage(spark):
    row = p.parse_readings(records(spark, [("temperature", body("temperature", 28.5))], 2, 7)).first()
    assert row.message_key == "temperature" and row.sensor == "temperature" and row.value == 28.5
    assert (row.partition, row.offset) == (2, 7)
    assert row.event_time == utc("2024-01-01T10:00:00").replace(tzinfo=None)


def test_malformed_payloads_keep_their_row_until_they_are_filtered(spark):
    payloads = ["nonsense", "", "{}", "[1]", body("a", "28.5"), body("a", True), body("a", 1.0, None), body("a", 1.0)]
    parsed = p.parse_readings(records(spark, payloads))
    assert parsed.count() == len(payloads)
    assert drop_malformed(parsed).count() == 1


def test_a_record_without_a_value(spark):
    parsed = p.parse_readings(records(spark, [("k", None), (None, body("a", 1.0))]))
    assert parsed.count() == 2
    assert [r.message_key for r in drop_malformed(parsed).collect()] == [None]


def test_unknown_fields_are_ignored_and_new_ones_read(spark):
    log = records(spark, [body("a", 1.0, source="lab", firmware="2")])
    assert "source" not in p.parse_readings(log, READING_V1).columns
    assert p.parse_readings(log, READING_V2).first().source == "lab"


def test_the_payload_is_parsed_once(spark):
    log = records(spark, [body("a", 1.0)])
    clean = drop_malformed(p.parse_readings(log)).filter(F.col("value") > 0)
    assert plan_of(clean).count("from_json") == 1


def test_user_events_with_and_without_a_purchase(spark):
    login = {"event": "login", "user_id": "user1", "ts": "2024-01-01T00:00:00.5+00:00", "session_id": "s"}
    buy = {**login, "event": "purchase", "item": "phone", "amount": 9.5, "ts": "yesterday"}
    rows = p.parse_user_events(records(spark, [json.dumps(login), json.dumps(buy)])).orderBy("offset").collect()
    assert (rows[0].item, rows[0].amount) == (None, None)
    assert rows[0].event_ts == utc("2024-01-01T00:00:00.500000").replace(tzinfo=None)
    assert (rows[1].item, rows[1].amount, rows[1].event_ts) == ("phone", 9.5, None)


def test_json_or_raw(spark):
    payloads = ['{"a": 1}', "plain text", b"\xff\xfebad", "[1, 2]", "{broken"]
    rows = p.json_or_raw(records(spark, payloads)).orderBy("offset").collect()
    assert [r.is_raw for r in rows] == [False, True, True, False, True]
    assert rows[0].payload == '{"a": 1}'
    assert json.loads(rows[1].payload) == {"raw": "plain text"}
    assert json.loads(rows[2].payload) == {"raw": b"\xff\xfebad".decode("utf-8", errors="replace")}


def test_published_records_have_the_sink_columns(spark):
    readings = spark.createDataFrame([("humidity", 60.5, None)], "sensor string, value double, unit string")
    out = p.to_log_records(readings, "sensor", "sensor-events")
    assert out.dtypes == [("key", "binary"), ("value", "binary"), ("topic", "string")]
    row = out.first()
    assert bytes(row.key) == b"humidity" and json.loads(bytes(row.value)) == {"sensor": "humidity", "value": 60.5}


def test_defaults(spark):
    rows = spark.createDataFrame([(None, None), ("C", "d")], "unit string, device_id string")
    got = [tuple(r) for r in p.with_defaults(rows, "api", "api-v1", F.lit(5)).collect()]
    assert got == [("", "api", "api-v1", 5), ("C", "d", "api-v1", 5)]
    assert [tuple(r) for r in p.with_defaults(rows).collect()][0] == ("", "")
