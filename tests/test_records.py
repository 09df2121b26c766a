"""What a parser makes of good and bad records, and how results look as JSON."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from hackney.functions.clock import event_text, flat_window
from hackney.functions.records import parse, serialise, wire_text
from hackney.operators.daily import day_totals
from hackney.operators.ingest import to_wire
from hackney.operators.windows import community_hot_spots, fare_totals, location_hot_spots
from hackney.schemas import TRIP, WIRE, narrow


def parsed(spark, text, **options):
    records = spark.createDataFrame([(text, dt.datetime(2024, 4, 13))], "value STRING, timestamp TIMESTAMP")
    return parse(records, **options).first()


@pytest.mark.parametrize(
    "text, field, expected",
    [
        ('{"pickup_community_area": 8, "fare": 1.5}', "pickup_community_area", 8),
        ('{"pickup_community_area": 8.0, "fare": 1.5}', "pickup_community_area", None),
        ('{"pickup_community_area": 8.0, "fare": 1.5}', "fare", 1.5),
        ('{"trip_seconds": 905.0}', "trip_seconds", None),
        ('{"fare": 10}', "fare", 10.0),
        ('{"trip_start_timestamp": "01/22/2024 01:45:00 PM", "fare": 1}', "trip_start_timestamp", None),
        ('{"trip_start_timestamp": "01/22/2024 01:45:00 PM", "fare": 1}', "fare", 1.0),
        (
            '{"event_timestamp": "2024-04-13 19:48:15.123456"}',
            "event_timestamp",
            dt.datetime(2024, 4, 13, 19, 48, 15, 123456),
        ),
        ('{"pickup_centroid_location": NaN}', "pickup_centroid_location", '"NaN"'),
        ('{"pickup_community_area": NaN}', "pickup_community_area", None),
        ('{"fare": null}', "fare", None),
    ],
)
def test_field(spark, text, field, expected):
    assert parsed(spark, text)[field] == expected


def test_nan_stays_nan_and_is_written_as_text(spark):
    row = parsed(spark, '{"fare": NaN}')
    assert math.isnan(row["fare"])
    text = serialise(spark.createDataFrame([(float("nan"),)], "fare DOUBLE")).first()["value"]
    assert json.loads(text) == {"fare": "NaN"}


@pytest.mark.parametrize("text", ['{"trip_id":"a", fare', "[1]", '{"x": 1}', "", None])
def test_bad_record_is_a_row_of_nulls(spark, text):
    row = parsed(spark, text)
    assert row["timestamp"] is not None
    assert all(row[name] is None for name in TRIP.names)


@pytest.mark.parametrize("text, expected", [("28.0", 28), ("28", 28), ("2.5", None), ("NaN", None), ("null", None)])
def test_lenient_integers(spark, text, expected):
    row = parsed(spark, f'{{"pickup_community_area": {text}}}', lenient_ints=True)
    assert row["pickup_community_area"] == expected


@pytest.mark.parametrize("text", ["03/05/2024 07:30:00 AM", "2024-03-05 07:30:00"])
def test_trip_times_in_the_format_of_the_file(spark, text):
    row = parsed(spark, f'{{"trip_start_timestamp": "{text}"}}', trip_times=True)
    assert row["trip_start_timestamp"] == dt.datetime(2024, 3, 5, 7, 30)
    assert parsed(spark, '{"trip_start_timestamp": "soon"}', trip_times=True)["trip_start_timestamp"] is None


def test_a_record_is_parsed_once_whatever_is_filtered(spark, folder):
    to_wire(trips(spark)).write.parquet(str(folder / "w"))
    wire = spark.read.parquet(str(folder / "w"))
    spots = community_hot_spots(parse(wire, ["event_timestamp", "pickup_community_area"], keep=()))
    plan = spots._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "ReadSchema: struct<value:binary>" in plan


def test_all_24_fields_in_order(spark):
    assert len(TRIP) == 24
    records = spark.createDataFrame([], "value STRING, timestamp TIMESTAMP")
    assert parse(records).columns == [*TRIP.names, "timestamp"]
    assert parse(records, ["fare"], keep=()).columns == ["fare"]
    assert narrow(["fare", "tips"]).names == ["fare", "tips"]


def test_wire_columns_become_text(spark):
    record = (bytearray(b"k"), bytearray('{"company":"Čab"}'.encode()), dt.datetime(2024, 1, 1))
    row = wire_text(spark.createDataFrame([record], WIRE)).first()
    assert (row["key"], row["value"]) == ("k", '{"company":"Čab"}')


def test_null_fields_are_left_out(spark):
    row = serialise(spark.createDataFrame([(1, None)], "a INT, b STRING")).first()
    assert row["value"] == '{"a":1}'


def test_event_time_goes_out_without_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 4, 13, 19, 48, 15, 120),)], "t TIMESTAMP")
    assert df.select(event_text("t")).first()[0] == "2024-04-13 19:48:15.000120"


def test_trip_survives_the_wire(spark):
    trip = {name: None for name in TRIP.names} | {
        "trip_id": "trip-0001",
        "trip_start_timestamp": dt.datetime(2024, 3, 5, 7, 30),
        "trip_seconds": 905,
        "fare": 18.5,
        "pickup_centroid_location": "POINT (8.25 47.5)",
        "event_timestamp": dt.datetime(2024, 4, 13, 19, 48, 15, 123456),
    }
    trips = spark.createDataFrame([tuple(trip[name] for name in TRIP.names)], TRIP)
    record = to_wire(trips, key="trip_id")
    assert bytes(record.first()["key"]) == b"trip-0001"
    assert parse(record, keep=()).first().asDict() == trip


def trips(spark):
    rows = [
        (dt.datetime(2024, 5, 2, 9, 15, 21), 87.3, 12.5, 101.9, 7, "POINT (10.5 50.25)"),
        (dt.datetime(2024, 5, 2, 9, 15, 22), 0.7, None, None, None, None),
    ]
    schema = (
        "event_timestamp TIMESTAMP, fare DOUBLE, tips DOUBLE, trip_total DOUBLE, "
        "pickup_community_area INT, pickup_centroid_location STRING"
    )
    return spark.createDataFrame(rows, schema)


def results(df):
    return sorted((json.loads(row["value"]) for row in serialise(df).collect()), key=str)


def test_shape_of_result_records(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "+03:00")
    try:
        rows = trips(spark).withColumn("event_timestamp", F.lit("2024-05-02 12:15:21").cast("timestamp"))
        window = {"start": "2024-05-02T12:15:20.000+03:00", "end": "2024-05-02T12:15:25.000+03:00"}
        assert results(fare_totals(rows, scale=2)) == [
            {"window": window, "total_fare": 88.0, "tips_fare": 12.5, "total_trip_total": 101.9}
        ]
        early = {"start": "2024-05-02T12:14:30.000+03:00", "end": "2024-05-02T12:15:30.000+03:00"}
        late = {"start": "2024-05-02T12:15:00.000+03:00", "end": "2024-05-02T12:16:00.000+03:00"}
        assert results(community_hot_spots(rows)) == [
            {"window": w, "pickup_community_area": 7, "count": 1} for w in (early, late)
        ]
        places = results(location_hot_spots(rows))
        assert {"window": late, "count": 1} in places and len(places) == 4
        day = day_totals(rows, as_of="2024-05-02", scale=2)
        assert results(day) == [
            {"trips_total": 2, "fare_total": 88.0, "tips_avg": 12.5, "trip_total_avg": 101.9}
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_flat_window_has_no_zone(spark):
    flat = flat_window(fare_totals(trips(spark)))
    assert dict(flat.dtypes)["window_start"] == "timestamp_ntz"
