"""Validation, drift, duplicates, preparation, alerts and scores."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hackney.operators import quality, scoring
from hackney.operators.alerts import Rule, alerts
from hackney.operators.metrics import error_rate, input_health, throughput
from hackney.operators.quality import (
    _combine_copies,
    compatible,
    dedupe,
    drift_report,
    preprocess,
    quarantined,
    valid,
    validate,
)
from hackney.operators.scoring import LinearModel, score, score_batches
from hackney.schemas import DOUBLE, INT, TEXT, narrow, schema_of

FIELDS = narrow(["trip_id", "fare", "pickup_community_area", "event_timestamp"])
TIME = '"event_timestamp":"2024-04-13 10:00:00"'
CASES = {
    f'{{"trip_id":"a","fare":1,"pickup_community_area":8,{TIME}}}': [],
    f'{{"trip_id":"a",{TIME}}}': [],
    f'{{"fare":1,{TIME}}}': ["missing:trip_id"],
    f'{{"trip_id":null,{TIME}}}': ["missing:trip_id"],
    '{"trip_id":"a","fare":1}': ["missing:event_timestamp"],
    f'{{"trip_id":"a","fare":NaN,{TIME}}}': ["not a number:fare"],
    f'{{"trip_id":"a","pickup_community_area":8.0,{TIME}}}': ["wrong type:pickup_community_area"],
    f'{{"trip_id":"a","pickup_community_area":NaN,"fare":NaN,{TIME}}}': [
        "not a number:fare",
        "wrong type:pickup_community_area",
    ],
    f'{{"trip_id":"a","fare":"free",{TIME}}}': ["wrong type:fare"],
    '{"trip_id":"a","event_timestamp":"soon"}': ["wrong type:event_timestamp"],
    '{"trip_id":"a", fare': ["unreadable"],
    "[1]": ["unreadable"],
    '{"x":1}': ["unreadable"],
    "": ["unreadable"],
    None: ["unreadable"],
}


def records(spark, *texts):
    rows = [(text, dt.datetime(2024, 4, 13, 10, 30)) for text in texts]
    return spark.createDataFrame(rows, "value STRING, timestamp TIMESTAMP")


def test_reasons(spark):
    checked = validate(records(spark, *CASES), FIELDS).collect()
    assert {row["value"]: row["reasons"] for row in checked} == CASES


def test_split_loses_nothing(spark):
    checked = validate(records(spark, *CASES), FIELDS)
    good, bad = valid(checked), quarantined(checked, "timestamp")
    assert good.count() == 2 and bad.count() == len(CASES) - 2
    assert good.columns == [*FIELDS.names, "timestamp"]
    assert bad.columns == ["timestamp", "value", "reasons"]


def test_sound_records_are_parsed_once(spark):
    checked = valid(validate(records(spark, *CASES), FIELDS))
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 2  # typed for all, as text for corrupt records


def test_drift(spark):
    texts = [
        '{"trip_id":"a","fare":1,"new":1}',
        '{"trip_id":"b","fare":"free"}',
        '{"trip_id":"c","fare":NaN,"pickup_community_area":NaN}',
        "{broken",
        None,
    ]
    report = {r["field"]: (r["present"], r["unusable"], r["declared"]) for r in drift_report(records(spark, *texts), FIELDS).collect()}
    assert report == {
        "trip_id": (3, 0, True),
        "fare": (3, 1, True),
        "pickup_community_area": (1, 1, True),
        "event_timestamp": (0, 0, True),
        "new": (1, 0, False),
    }


def test_compatible():
    old = schema_of(a=TEXT, b=INT)
    assert compatible(old, schema_of(a=TEXT, b=INT, c=TEXT)) == []
    assert compatible(old, schema_of(b=DOUBLE)) == ["removed:a", "retyped:b"]


def test_dedupe_keeps_the_earliest_whatever_the_order(spark):
    rows = [("a", dt.datetime(2024, 1, day), day) for day in (3, 1, 2)] + [("b", None, 9), (None, None, 1), (None, None, 1)]
    schema = "trip_id STRING, event_timestamp TIMESTAMP, fare INT"
    for order in (rows, rows[::-1]):
        got = {tuple(r) for r in dedupe(spark.createDataFrame(order, schema)).select("trip_id", "fare").collect()}
        assert got == {("a", 1), ("b", 9), (None, 1)}
        assert dedupe(spark.createDataFrame(order, schema)).count() == 4  # trips without an id all stay


def test_dedupe_combines_copies_before_the_shuffle(spark):
    copies = spark.range(0, 100_000, 1, 8).select(
        F.lit("hot").alias("trip_id"), F.lit(dt.datetime(2024, 1, 1)).alias("event_timestamp"), "id"
    )
    unique = dedupe(copies)
    assert unique.first()["id"] == 0
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_dedupe_of_heavy_and_light_keys_is_the_same(spark, monkeypatch):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 5000)).alias("trip_id"),
        F.timestamp_seconds(F.col("id") * 7919 % 1009).alias("event_timestamp"), "id",
    )
    found = []
    for share in (0.001, 2.0):
        monkeypatch.setattr(quality, "HEAVY", share)
        found.append(sorted(dedupe(rows).collect(), key=str))
    assert found[0] == found[1]
    keys = rows.filter("trip_id IS NOT NULL").select("trip_id").distinct().count()
    assert len(found[0]) == keys + rows.filter("trip_id IS NULL").count()


@pytest.mark.parametrize("zone", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_copies_in_a_task_are_combined_and_the_latest_stays(spark, zone):
    day = [dt.datetime(2024, 1, n) for n in range(1, 5)]
    rows = [("a", day[0], 1, [1.0]), ("a", day[2], 3, None), ("a", day[1], 2, []), ("b", None, 9, None), (None, day[3], 4, None)]
    schema = f"trip_id STRING, event_timestamp {zone}, n INT, more ARRAY<DOUBLE>"
    trips = spark.createDataFrame(rows * 50, schema).coalesce(1)
    combined = _combine_copies(trips, ["trip_id"], "event_timestamp")
    assert combined.schema == trips.schema
    assert {(r["trip_id"], r["n"]) for r in combined.collect()} == {("a", 3), ("b", 9), (None, 4)}
    assert combined.count() == 3


def test_preprocess(spark):
    time = dt.datetime(2024, 1, 1)
    rows = [
        ("a", time, 1.0, None, 1.0),
        ("b", time, -1.0, 0.0, 1.0),
        ("c", time, 1.0, float("nan"), 1.0),
        ("d", time, float("inf"), 0.0, 1.0),
        ("e", None, 1.0, 0.0, 1.0),
        (None, time, 1.0, 0.0, 1.0),
        ("g", time, None, 0.0, 1.0),
    ]
    schema = "trip_id STRING, event_timestamp TIMESTAMP, fare DOUBLE, tips DOUBLE, trip_total DOUBLE"
    ready = preprocess(spark.createDataFrame(rows, schema), fill={"tips": 0.0}).collect()
    assert [(r["trip_id"], r["fare"], r["tips"]) for r in ready] == [("a", 1.0, 0.0), ("c", 1.0, 0.0), ("g", None, 0.0)]


def test_error_rate_health_and_throughput(spark):
    wire = records(spark, f'{{"trip_id":"a",{TIME}}}', "bad", '{"trip_id":"b"}', None).withColumn("topic", F.lit("t"))
    rate = error_rate(wire).first()
    assert (rate["records"], rate["malformed"], rate["error_rate"]) == (4, 3, 0.75)
    assert error_rate(wire, fields=["trip_id"]).first()["malformed"] == 2
    health = input_health(wire, by=["topic"]).first()
    assert (health["records"], health["valid"], health["unusable"], health["silent"]) == (4, 1, 3, False)
    silent = input_health(wire.filter("value = 'bad'"), by=["topic"]).first()
    assert silent["silent"] is True
    messages = throughput(wire.filter("value = 'bad'")).first()
    assert (messages["messages"], messages["bytes"]) == (1, 3)


def test_alerts(spark):
    rows = spark.createDataFrame([("w1", 10.0, 1), ("w2", 1.0, 9), ("w3", None, None)], "window STRING, total DOUBLE, n INT")
    rules = [Rule("high", "total", 10), Rule("low", "total", 2, below=True), Rule("many", "n", 9)]
    got = {(r["window"], r["rule"], r["value"]) for r in alerts(rows, rules, keep=["window"]).collect()}
    assert got == {("w1", "high", 10.0), ("w2", "low", 1.0), ("w2", "many", 9.0)}
    assert alerts(rows, rules, keep=["window"]).columns == ["window", "rule", "value", "threshold"]


MODEL = LinearModel(1.0, {"a": 2.0, "b": -1.0})


def test_scores(spark):
    rows = spark.createDataFrame([(1.0, 2), (None, 1), (3.0, 1)], "a DOUBLE, b INT")
    expected = [1.0, None, 6.0]
    assert [r["score"] for r in score(rows, MODEL).collect()] == expected
    assert [r["score"] for r in score_batches(rows, MODEL.predictor(), ["a", "b"]).collect()] == expected
    mean = score_batches(rows, lambda matrix: np.mean(matrix, axis=1), ["a", "b"], output="mean")
    assert [r["mean"] for r in mean.collect()] == [1.5, None, 2.0]


def test_a_large_model_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MODEL_BYTES", 1000)
    weights = np.zeros(1000)
    with pytest.raises(ValueError, match="too large to broadcast"):
        score_batches(spark.range(1), lambda matrix: matrix @ weights, ["id"])
