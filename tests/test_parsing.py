import json

import pytest

from airmill.functions import parsing

FLAT = {"temperature": 31.0, "humidity": 65, "pressure": 1004.5, "gas_resistance": "50000"}


def parse(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, body string")
    return parsing.parse_messages(df).orderBy("i").collect()


@pytest.mark.parametrize(
    "body, envelope, reason",
    [
        (FLAT, "plain", None),
        ({"device_id": "d", "timestamp": "2024-01-01T00:00:00", "sensors": FLAT}, "plain", None),
        ({"Type": "Notification", "Message": json.dumps(FLAT)}, "notification", None),
        ({"Type": "Notification", "Message": "oops"}, "notification", "bad_json"),
        ({"Type": "Notification", "Message": FLAT}, "notification", "bad_json"),
        ({"Type": "Notification", "Message": None}, "notification", "bad_json"),
        ({"Type": "Notification", **FLAT}, "plain", None),
        ({"Type": "Other", "Message": json.dumps(FLAT)}, "message", None),
        ({"Message": "hello", **FLAT}, "plain", None),
        ({"Message": FLAT, **FLAT}, "plain", None),
        ({"Message": json.dumps(json.dumps(FLAT))}, "message", "not_object"),
        (json.dumps(json.dumps(FLAT)), "text", None),
        ('"no json inside"', "text", "bad_json"),
        ("not json", "unreadable", "bad_json"),
        ("[1, 2]", "plain", "not_object"),
        ("17", "plain", "not_object"),
        ("null", "plain", "not_object"),
        ({"sensors": None, **FLAT}, "plain", "bad_sensors"),
        ({"sensors": [1], **FLAT}, "plain", "bad_sensors"),
        ({"sensors": {"temperature": 1}, **FLAT}, "plain", "missing_fields"),
        ({**FLAT, "humidity": None}, "plain", "missing_fields"),
        ({**FLAT, "humidity": "damp"}, "plain", "bad_number"),
        ({**FLAT, "humidity": "65.0d"}, "plain", "bad_number"),
        ({**FLAT, "humidity": {"v": 1}}, "plain", "bad_number"),
        ({**FLAT, "humidity": " 65.5 "}, "plain", None),
        ({**FLAT, "humidity": True}, "plain", None),
        ({**FLAT, "humidity": "inf"}, "plain", None),
        ({**FLAT, "humidity": "nan"}, "plain", None),
        ({**FLAT, "humidity": float("nan")}, "plain", None),
        ({"Message": json.dumps({**FLAT, "humidity": float("-inf")})}, "message", None),
        ('{"a": NaN', "unreadable", "bad_json"),
    ],
)
def test_forms(spark, body, envelope, reason):
    row = parse(spark, body)[0]
    assert (row.envelope, row.invalid_reason) == (envelope, reason)


def test_values(spark):
    flat, nested, text, flag, nan = parse(
        spark, FLAT, {"device_id": "d", "version": 3, "timestamp": "t", "sensors": FLAT, "temperature": 1},
        {**FLAT, "humidity": " 65.5 "}, {**FLAT, "humidity": True}, {**FLAT, "humidity": "nan"},
    )
    assert (flat.temperature, flat.humidity, flat.pressure, flat.gas_resistance) == (31.0, 65.0, 1004.5, 50000.0)
    assert (nested.layout, nested.device_id, nested.version, nested.timestamp, nested.temperature) == ("nested", "d", "3", "t", 31.0)
    assert (text.humidity, flag.humidity, nan.humidity) == (65.5, 1.0, None)


def test_lenient_numbers(spark):
    twice = '{"temperature":1,"temperature":2,"humidity":NaN,"pressure":-Infinity,"gas_resistance":4}'
    row = parse(spark, twice)[0]
    assert (row.invalid_reason, row.temperature, row.humidity, row.pressure) == (None, 2.0, None, float("-inf"))


def test_missing_names(spark):
    row = parse(spark, {"temperature": 1, "pressure": None})[0]
    assert row.missing == ["humidity", "pressure", "gas_resistance"]


@pytest.mark.parametrize(
    "body, status, humidity",
    [
        ({"temperature": 1, "humidity": 2, "pressure": 3, "gas_resistance": 4}, 200, 2.0),
        ({"T": 1, "H": "2.5", "P": 3, "G": True}, 200, 2.5),
        ({"T": 1, "H": 9, "humidity": 2, "P": 3, "G": 4}, 200, 2.0),
        ({"t": 1, "H": 2, "P": 3, "G": 4}, 400, 2.0),
        ({"T": 1, "humidity": None, "H": 2, "P": 3, "G": 4}, 500, None),
        ({"T": 1, "H": "wet", "P": 3, "G": 4}, 400, None),
        ({"T": 1, "H": "2f", "P": 3, "G": 4}, 400, None),
        ({"T": 1, "H": [2], "P": 3, "G": 4}, 500, None),
        ({"T": 1, "H": None, "P": 3}, 500, None),
        ({"T": 1, "P": 3, "G": None}, 400, None),
        ({"body": {"T": 1, "H": 2, "P": 3, "G": 4}}, 200, 2.0),
        ({"body": '{"T": 1, "H": 2, "P": 3, "G": 4}'}, 200, 2.0),
        ({"body": "nope"}, 400, None),
        ({"body": None}, 500, None),
        ({"body": [1]}, 400, None),
        ({"body": 5}, 500, None),
    ],
)
def test_aliases(spark, body, status, humidity):
    df = spark.createDataFrame([(json.dumps(body),)], "body string")
    row = parsing.parse_aliases(df).first()
    assert (row.status, row.humidity) == (status, humidity)
