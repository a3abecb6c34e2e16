from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from helpers import body, records
from lakestream.functions.payload import parse_readings
from lakestream.operators import quality as q
from lakestream.plans.etl import flagged_readings
from lakestream.plans.lake import curated_readings
from lakestream.schemas import DEFAULT_RULES, SensorRule, SensorRules
from lakestream.session import prepare

# name, body, kept by the typed parse, kept by the curated gate, API status
CASES = [
    ("valid", '{"sensor":"temperature","value":28.5,"unit":"C","timestamp":1700000000155}', True, True, 201),
    ("not json", "sensor=temperature&value=29.3", False, False, 400),
    ("missing value", '{"sensor":"temperature"}', False, False, 400),
    ("missing sensor", '{"value":29.3}', False, False, 400),
    ("null value", '{"sensor":"temperature","value":null}', False, False, 422),
    ("unknown sensor", '{"sensor":"radar","value":29.3,"timestamp":1}', True, True, 422),
    ("non-numeric", '{"sensor":"temperature","value":"hot"}', False, False, 422),
    ("numeric string", '{"sensor":"temperature","value":"28.5","timestamp":1}', False, False, 201),
    ("out of range", '{"sensor":"temperature","value":999.9,"timestamp":1}', True, True, 422),
    ("corrupt", '{"sensor":"temperature","value":-100.5,"timestamp":1}', True, False, 422),
    ("nan", '{"sensor":"humidity","value":"NaN","timestamp":1}', True, False, 422),
    ("missing timestamp", '{"sensor":"humidity","value":91}', False, False, 201),
    ("extra field", '{"sensor":"humidity","value":9,"timestamp":1,"source":"x"}', True, True, 201),
    ("array", "[1]", False, False, 400),
    ("json null", "null", False, False, 400),
    ("null sensor", '{"sensor":null,"value":1}', False, False, 422),
    ("boolean", '{"sensor":"humidity","value":true,"timestamp":1}', False, False, 201),
]


@pytest.fixture(scope="module")
def judged(spark):
    log = records(spark, [c[1] for c in CASES])
    offsets = lambda df: {r.offset for r in df.select("offset").collect()}
    return (
        offsets(q.drop_malformed(parse_readings(log))),
        offsets(curated_readings(log)),
        {r.offset: r for r in q.validate_payloads(log).collect()},
    )


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_each_kind_of_payload(judged, i):
    parsed, gated, validated = judged
    _, _, keeps, passes, status = CASES[i]
    assert (i in parsed) == keeps
    assert (i in gated) == passes
    assert validated[i].status_code == status


def test_errors_are_ordered(judged):
    by_name = {c[0]: judged[2][i] for i, c in enumerate(CASES)}
    assert by_name["missing sensor"].error == "missing_fields" and by_name["missing sensor"].missing == ["sensor"]
    assert by_name["not json"].error == "not_json"
    assert by_name["unknown sensor"].error == "unknown_sensor"
    assert by_name["null value"].error == "not_numeric"
    assert by_name["nan"].error == "out_of_range"
    assert by_name["valid"].error is None


TEXTS = [
    "28.5", " 28.5 ", "1_000", "1__0", "_1", "1e2", "1E+2", ".5", "5.", "inf", "-Infinity", "nan", "+3",
    "0x10", "1f", "1d", "", " ", "1,5", "--1", "1e", "true", "९",
]


def test_numeric_text_is_read_as_python_reads_it(spark):
    def expected(text):
        try:
            return float(text)
        except ValueError:
            return None

    ascii_texts = TEXTS[:-1]
    log = records(spark, [json.dumps({"sensor": "humidity", "value": t}) for t in ascii_texts])
    got = [r.submitted for r in q.validate_payloads(log).orderBy("offset").collect()]
    for text, a, b in zip(ascii_texts, got, map(expected, ascii_texts)):
        assert (a is None) == (b is None), text
        assert a is None or a == b or (math.isnan(a) and math.isnan(b)), text


@pytest.mark.parametrize("value,expected", [(5, 5.0), (True, 1.0), (False, 0.0), ([1], None), ({"a": 1}, None)])
def test_json_values_as_numbers(spark, value, expected):
    log = records(spark, [json.dumps({"sensor": "humidity", "value": value})])
    assert q.validate_payloads(log).first().submitted == expected


def test_of_a_repeated_key_the_last_counts(spark):
    prepare(spark)
    log = records(spark, ['{"sensor":"humidity","value":"hot","value":5}'])
    row = q.validate_payloads(log).first()
    assert (row.status_code, row.submitted) == (201, 5.0)


def test_accepted_bodies_get_defaults_and_the_clock(spark):
    log = records(spark, ['{"sensor":"humidity","value":"50"}', '{"sensor":"humidity","value":50,"unit":"%","device_id":"h"}'])
    rows = q.accepted_readings(q.validate_payloads(log), now_ms=F.lit(7)).collect()
    assert [tuple(r) for r in rows] == [
        ("humidity", 50.0, "", 7, "api-v1", "api"),
        ("humidity", 50.0, "%", 7, "api-v1", "h"),
    ]


def test_a_rejected_body_stays_cheap_to_filter(spark):
    log = records(spark, ["{}"])
    plan = q.accepted_readings(q.validate_payloads(log))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_thresholds_are_strict_and_nothing_is_dropped(spark):
    values = [("temperature", 35.0), ("temperature", 35.01), ("humidity", 90.0), ("humidity", 90.1), ("pressure", 5000.0)]
    rows = flagged_readings(records(spark, [body(s, v) for s, v in values])).orderBy("offset").collect()
    assert [r.is_anomaly for r in rows] == [False, True, False, True, False]


def test_nan_is_an_anomaly_until_the_gate_drops_it(spark):
    log = records(spark, ['{"sensor":"humidity","value":"NaN","timestamp":1}'])
    assert flagged_readings(log).first().is_anomaly is True
    assert curated_readings(log).isEmpty()


def test_gate_and_physical_range_include_their_bounds(spark):
    rows = spark.createDataFrame(
        [("temperature", v) for v in (-100.0, 2000.0, -100.1, 2000.1, -50.0, 80.0)], "sensor string, value double"
    )
    assert {r.value for r in q.in_range(rows, -100, 2000).collect()} == {-100.0, 2000.0, -50.0, 80.0}
    assert {r.value for r in q.in_physical_range(rows).collect()} == {-50.0, 80.0}


def test_split_loses_nothing_and_names_every_reason(spark):
    log = records(spark, [c[1] for c in CASES])
    valid, rejected = q.split_valid(parse_readings(log))
    assert valid.count() + rejected.count() == len(CASES)
    reasons = {r.offset: r.reasons for r in rejected.collect()}
    names = {c[0]: i for i, c in enumerate(CASES)}
    assert reasons[names["not json"]] == ["missing_sensor", "missing_value", "missing_event_time"]
    assert reasons[names["nan"]] == ["not_a_number"]
    assert reasons[names["corrupt"]] == ["out_of_range"]


def test_alerts_go_by_key(spark):
    log = records(spark, [("temperature", body("x", 36.0)), ("pressure", body("temperature", 99.0))])
    rows = q.alerts(parse_readings(log)).collect()
    assert [(r.offset, r.message) for r in rows] == [(0, "ALERT: HIGH TEMPERATURE 36.00 C")]


def test_known_sensors(spark):
    rows = spark.createDataFrame([("radar",), ("humidity",), (None,)], "sensor string")
    assert [r.sensor for r in q.in_domain(rows).collect()] == ["humidity"]


def test_rules_as_a_table(spark):
    frame = DEFAULT_RULES.to_frame(spark)
    rows = spark.createDataFrame([("humidity", 95.0), ("radar", 1.0)], "sensor string, value double")
    got = {r.sensor: r.anomaly_above for r in q.attach_rules(rows, frame).collect()}
    assert got == {"humidity": 90.0, "radar": None}


def test_rules_in_code_and_in_a_table_mean_the_same(spark):
    values = [None, float("nan"), -60.0, 0.0, 35.0, 35.5, 95.0, 900.0]
    sensors = [None, "radar", "temperature", "humidity", "pressure"]
    rows = spark.createDataFrame([(s, v, i) for i, (s, v) in enumerate((s, v) for s in sensors for v in values)],
                                 "sensor string, value double, i int")
    table = DEFAULT_RULES.to_frame(spark)
    spare = spark.range(2000).selectExpr("concat('spare', id) sensor", "'' unit", "0D a", "0D b", "0D c")
    for rules in (table, table.union(spare)):
        flags = {r.i: r.is_anomaly for r in q.flag_anomalies(rows, rules).collect()}
        assert flags == {r.i: r.is_anomaly for r in q.flag_anomalies(rows, DEFAULT_RULES).collect()}
        for keep in (q.in_domain, q.in_physical_range):
            assert sorted(r.i for r in keep(rows, rules).collect()) == sorted(r.i for r in keep(rows).collect())
    log = parse_readings(records(spark, [("temperature", body("x", 36.0)), (b"", body("temperature", 99.0))]))
    assert q.alerts(log, table).collect() == q.alerts(log).collect()


@pytest.mark.parametrize(
    ("sent", "status"),
    [
        ('{"sensor":"temperature","value":20}', 201),
        ('{"sensor":"temperature","value":20} x', 400),
        ('{"sensor":"temperature","value":20}{"a":1}', 400),
        ('{"sensor":"temperature","value":20}],[1', 400),
        ('{"sensor":"temperature","value":20},1', 400),
        (' \n{"sensor":"temperature","value":20}\t', 201),
        ('{"sensor":"temperature","value":"\\t20"}', 201),
        ('{"sensor":"temperature","value":"\u00a020\u2003"}', 201),
        ('{"sensor":"temperature","value":"\u0662\u0660"}', 201),
        ('{"sensor":"temperature","value":"2 0"}', 422),
        ('{"sensor":"temperature","value":NaN}', 400),
        ('{"sensor":"temperature","value":Infinity}', 400),
        ("", 400),
        (" ", 400),
        ("null", 400),
    ],
)
def test_bodies_must_be_one_document(spark, sent, status):
    judged = q.validate_payloads(records(spark, [sent])).first()
    assert judged.status_code == status, judged


def test_a_sensor_without_a_threshold_is_never_flagged(spark):
    rules = SensorRules((SensorRule("a"),))
    rows = spark.createDataFrame([("a", 1e9), (None, None)], "sensor string, value double")
    assert [r.is_anomaly for r in q.flag_anomalies(rows, rules).collect()] == [False, False]
