from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallycast import schemas
from tallycast.functions import text, timeparts
from tallycast.operators import clean
from tallycast.sources.landing import records_to_frame


def value(spark, column, **inputs):
    frame = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} string" for k in inputs))
    return frame.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "function, raw, expected",
    [
        (text.percent_to_ratio, "87%", 0.87),
        (text.percent_to_ratio, "n/a", None),
        (text.first_integer, "745 mm", 745),
        (text.first_integer, "", None),
        (text.first_integer, "99999999999999", None),
        (text.signed_integer, "−5", -5),
        (text.signed_integer, "+5", 5),
        (text.signed_integer, "-5°", None),
        (text.comma_decimal, "3,5", 3.5),
        (text.comma_decimal, "calm", None),
    ],
)
def test_text_readings(spark, function, raw, expected):
    assert value(spark, function("x"), x=raw) == expected


@pytest.mark.parametrize(
    "raw, tz, expected",
    [
        ("2022-12-25T10:15:30.123456+03:00", "UTC", datetime(2022, 12, 25, 7, 15, 30, 123456)),
        ("2022-12-25T10:15:30+03:00", "UTC", datetime(2022, 12, 25, 7, 15, 30)),
        ("2022-12-25T10:15:30.5", "UTC", datetime(2022, 12, 25, 10, 15, 30, 500000)),
        ("2022-12-25T10:15:30.5", "Europe/Moscow", datetime(2022, 12, 25, 7, 15, 30, 500000)),
        ("2022-12-25T10:15:30Z", "Europe/Moscow", datetime(2022, 12, 25, 10, 15, 30)),
        ("2022-12-25", "UTC", datetime(2022, 12, 25)),
        ("2022-12-25", "Europe/Moscow", datetime(2022, 12, 24, 21)),
        ("2022-12-25T10:15", "UTC", datetime(2022, 12, 25, 10, 15)),
        ("2022-12-25T10:15:30+03", "UTC", datetime(2022, 12, 25, 7, 15, 30)),
        ("2022-12-25 10:15:30 Europe/Moscow", "UTC", datetime(2022, 12, 25, 7, 15, 30)),
        ("10:15:30", "UTC", None),
        ("2022-13-25", "UTC", None),
        ("yesterday", "UTC", None),
    ],
)
def test_iso_time(spark, raw, tz, expected):
    found = value(spark, F.date_format(text.iso_time("x", tz), "yyyy-MM-dd HH:mm:ss.SSSSSS"), x=raw)
    assert found == (None if expected is None else expected.strftime("%Y-%m-%d %H:%M:%S.%f"))


@pytest.mark.parametrize("raw", ["1671955200.25", "2022-12-25T08:00:00.25Z"])
def test_event_time_from_number_or_text(spark, raw):
    assert value(spark, F.unix_micros(text.epoch_or_iso_time("x")), x=raw) == 1671955200250000


def test_midnight_is_hour_24(spark):
    row = spark.sql("select timestamp'2024-03-04 00:30:00' t").select(
        *[c.alias(n) for n, c in timeparts.calendar_parts("t").items()]
    )
    assert row.first().asDict() == {"hour": 24, "month": 3, "weekday": "Mon", "year": 2024, "day_of_year": 64}


def test_bucket_is_a_floor_before_1970(spark):
    row = spark.sql("select timestamp'1969-12-31 23:59:00' a, timestamp'1970-01-01 00:15:00' b")
    assert tuple(row.select(timeparts.time_bucket("a", 900), timeparts.time_bucket("b", 900)).first()) == (-1, 1)


EVENT = {
    "id": "e1",
    "type": "crash",
    "location": {"coordinates": [30.3, 59.9]},
    "feedbacks": {"likes": 2, "dislikes": 0},
    "timestamp": "1671955200",
    "city_name": "spb",
    "scheduler_id": "r1",
}


def test_flatten_events(spark):
    short = {**EVENT, "id": "e2", "location": {"coordinates": [30.3]}, "feedbacks": None}
    bare = {"id": "e3"}
    flat = clean.flatten_events(records_to_frame(spark, [EVENT, short, bare], schemas.RUN_EVENT))
    assert flat.schema.names == schemas.CLEAN_EVENT.names
    rows = {r["id"]: r for r in flat.collect()}
    assert (rows["e1"]["latitude"], rows["e1"]["longitude"], rows["e1"]["likes"]) == (59.9, 30.3, 2)
    assert (rows["e2"]["latitude"], rows["e2"]["longitude"], rows["e2"]["likes"]) == (None, 30.3, None)
    assert rows["e3"]["date"] is None


def test_empty_and_full_input_have_one_schema(spark):
    for schema, function in [(schemas.RUN_EVENT, clean.clean_events), (schemas.RUN_WEATHER, clean.clean_weather)]:
        full = function(records_to_frame(spark, [{"city_name": "spb"}], schema))
        none = function(schemas.empty(spark, schema))
        assert none.count() == 0 and none.schema == full.schema


def test_missing_columns_become_null(spark):
    frame = spark.createDataFrame([("spb", "85%", 1)], "city_name string, humidity string, extra int")
    row = clean.type_weather(frame).first()
    assert row["humidity"] == 0.85 and row["pressure"] is None and "extra" not in row.asDict()


def test_earliest_reading_of_a_run_is_kept(spark):
    readings = [
        {"city_name": "spb", "scheduler_id": "r1", "datetime": f"2022-12-25T10:{m}:00+03:00", "temperature": m}
        for m in ("20", "05", "40")
    ]
    readings.append({"city_name": "spb", "scheduler_id": "r1", "datetime": "broken", "temperature": "1"})
    kept = clean.clean_weather(records_to_frame(spark, readings, schemas.RUN_WEATHER)).collect()
    assert [r["temperature"] for r in kept] == [5]
