"""Windows, days, sums and rounding; also against brute force."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hackney.functions.amounts import rounded
from hackney.operators.daily import day_report, day_totals, totals_by_day
from hackney.operators.history import GRAINS, accumulated_revenue, persistent_hot_spots, rollup_periods, trend
from hackney.operators.windows import community_hot_spots, fare_totals, location_hot_spots

SCHEMA = (
    "event_timestamp TIMESTAMP_NTZ, fare DOUBLE, tips DOUBLE, trip_total DOUBLE, "
    "pickup_community_area INT, pickup_centroid_location STRING"
)
DAY = dt.datetime(2024, 1, 15)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def trip(time, fare=1.0, tips=0.0, area=1, place="a"):
    total = None if fare is None or tips is None else fare + tips
    return (time, fare, tips, total, area, place)


@pytest.mark.parametrize("exact", [False, True])
def test_sums_skip_nulls_and_are_null_without_values(spark, exact):
    second = dt.timedelta(seconds=1)
    rows = [trip(DAY, 1.0, None), trip(DAY + second, None, None), trip(DAY + 5 * second, None, None)]
    totals = fare_totals(frame(spark, rows), exact=exact).orderBy("window").collect()
    assert [(r["total_fare"], r["tips_fare"]) for r in totals] == [(1.0, None), (None, None)]


def test_nan_spreads_in_plain_sums_and_is_skipped_in_exact_ones(spark):
    rows = frame(spark, [trip(DAY, float("nan")), trip(DAY, 2.0)])
    assert math.isnan(fare_totals(rows).first()["total_fare"])
    assert fare_totals(rows, exact=True).first()["total_fare"] == 2.0


def test_amounts_that_do_not_fit_end_nothing(spark):
    minute = dt.timedelta(minutes=1)
    rows = frame(spark, [trip(DAY, 1e17), trip(DAY, 2.0), trip(DAY + minute, 9e16), trip(DAY + minute, 9e16)])
    totals = fare_totals(rows, exact=True).orderBy("window").collect()
    assert [r["total_fare"] for r in totals] == [2.0, None]


def test_means_leave_out_what_the_sums_leave_out(spark):
    rows = frame(spark, [trip(DAY, 1.0, float("nan")), trip(DAY, 1.0, 3.0), trip(DAY, 1.0, None)])
    assert day_totals(rows, as_of="2024-01-15", exact=True, inclusive_start=True).first()["tips_avg"] == 3.0
    assert day_report(totals_by_day(rows)).first()["tips_avg"] == 3.0


def test_exact_sum_has_no_rounding_error(spark):
    rows = frame(spark, [trip(DAY, 0.1) for _ in range(10)])
    assert fare_totals(rows, scale=None, exact=True).first()["total_fare"] == 1.0


@pytest.mark.parametrize("value, expected", [(2.5, 3.0), (-2.5, -3.0), (2.4, 2.0), (None, None)])
def test_rounding_is_half_up(spark, value, expected):
    row = spark.createDataFrame([(value,)], "x DOUBLE").select(rounded(F.col("x"), 0).alias("x")).first()
    assert row["x"] == expected


def test_day_bounds_are_open(spark):
    end = DAY + dt.timedelta(days=1)
    micro = dt.timedelta(microseconds=1)
    rows = frame(spark, [trip(t) for t in (DAY - micro, DAY, DAY + micro, end - micro, end)] + [trip(None)])
    assert day_totals(rows, as_of="2024-01-15").first()["trips_total"] == 2
    assert day_totals(rows, as_of=DAY.date(), inclusive_start=True).first()["trips_total"] == 3


def test_day_without_trips_has_a_row(spark):
    row = day_totals(frame(spark, [trip(DAY)]), as_of="2020-01-01").first()
    assert row.asDict() == {"trips_total": 0, "fare_total": None, "tips_avg": None, "trip_total_avg": None}


def test_today_is_the_default(spark):
    now = frame(spark, [trip(DAY)]).withColumn("event_timestamp", F.current_timestamp())
    assert day_totals(now).first()["trips_total"] == 1


def test_day_filter_reaches_the_scan(spark, folder):
    frame(spark, [trip(DAY)]).write.parquet(str(folder / "t"))
    plan = day_totals(spark.read.parquet(str(folder / "t")), as_of="2024-01-15")._jdf.queryExecution().toString()
    pushed = plan[plan.rindex("PushedFilters") :]
    assert "GreaterThan(event_timestamp" in pushed and "LessThan(event_timestamp" in pushed
    schema = pushed[pushed.index("ReadSchema") :]
    assert "pickup" not in schema


def test_aggregations_combine_before_the_shuffle(spark):
    rows = frame(spark, [trip(DAY)])
    for df in (fare_totals(rows, exact=True), community_hot_spots(rows), totals_by_day(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
        assert "partial_" in plan[plan.index("Exchange") :] and "SortAggregate" not in plan


def test_null_place_counts_only_for_locations(spark):
    rows = frame(spark, [trip(DAY, area=None, place=None), trip(DAY)])
    assert {r["pickup_community_area"] for r in community_hot_spots(rows).collect()} == {1}
    assert {r["pickup_centroid_location"] for r in location_hot_spots(rows).collect()} == {None, "a"}
    kept = community_hot_spots(rows, drop_null_place=False).collect()
    assert {r["pickup_community_area"] for r in kept} == {None, 1}


def test_tenants_do_not_mix(spark):
    rows = frame(spark, [trip(DAY, 1.0), trip(DAY, 2.0)]).withColumn("tenant_id", F.format_string("t%d", F.col("fare").cast("int")))
    totals = {r["tenant_id"]: r["total_fare"] for r in fare_totals(rows, by=["tenant_id"]).collect()}
    assert totals == {"t1": 1.0, "t2": 2.0}


times = st.datetimes(dt.datetime(2023, 12, 31, 23, 50), dt.datetime(2024, 1, 1, 0, 10))
amounts = st.integers(0, 100_000).map(lambda cents: cents / 100)
rows_of_trips = st.lists(
    st.tuples(times, amounts, amounts, st.sampled_from([None, 1, 2])).map(lambda t: trip(t[0], t[1], t[2], t[3])),
    min_size=1,
    max_size=40,
)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
EPOCH = dt.datetime(1970, 1, 1)


def bucket(time, seconds):
    return EPOCH + dt.timedelta(seconds=(time - EPOCH) // dt.timedelta(seconds=seconds) * seconds)


@few
@given(rows_of_trips)
def test_fare_totals_against_brute_force(spark, rows):
    expected = defaultdict(Decimal)
    for time, fare, *_ in rows:
        expected[bucket(time, 5)] += Decimal(str(fare))
    wanted = {start: float(total.quantize(Decimal(1), ROUND_HALF_UP)) for start, total in expected.items()}
    got = {r["window"]["start"]: r["total_fare"] for r in fare_totals(frame(spark, rows), exact=True).collect()}
    assert got == wanted


@few
@given(rows_of_trips)
def test_hot_spots_against_brute_force(spark, rows):
    wanted = Counter()
    for time, _, _, _, area, _ in rows:
        if area is not None:
            start = bucket(time, 30)
            wanted[start, area] += 1
            wanted[start - dt.timedelta(seconds=30), area] += 1
    spots = community_hot_spots(frame(spark, rows)).collect()
    assert {(r["window"]["start"], r["pickup_community_area"]): r["count"] for r in spots} == wanted


def test_means_over_periods_come_from_sums_and_counts(spark):
    day = dt.timedelta(days=1)
    rows = frame(spark, [trip(DAY, 1.0, 1.0), trip(DAY, 1.0, 1.0), trip(DAY + day, 10.0, 7.0), trip(DAY + day, 2.0, None)])
    daily = totals_by_day(rows)
    month = accumulated_revenue(daily, "month").first()
    assert (month["trips_total"], month["tips_avg"], month["revenue"]) == (4, 3.0, 21.0)
    assert trend(daily, "year").first()["fare_per_day"] == 7.0
    assert [r["tips_avg"] for r in day_report(daily).orderBy("day").collect()] == [1.0, 7.0]
    assert rollup_periods(daily).count() == 4
    for wrong in (trend, accumulated_revenue):
        with pytest.raises(ValueError):
            wrong(daily, "week")
    assert GRAINS == ("month", "quarter", "year")


def test_fare_per_trip_leaves_out_trips_without_a_fare(spark):
    rows = [trip(DAY, fare=10.0), trip(DAY, fare=None), trip(DAY, fare=5.0)]
    row = trend(totals_by_day(frame(spark, rows)), "month").first()
    assert (row["trips"], row["fare_total"], row["fare_per_trip"]) == (3, 15.0, 7.5)


def test_persistent_hot_spots(spark):
    spots = community_hot_spots(frame(spark, [trip(DAY), trip(DAY), trip(DAY + dt.timedelta(minutes=9))]))
    row = persistent_hot_spots(spots, "pickup_community_area").first()
    assert (row["windows"], row["window_pickups"], row["peak"], row["mean_per_window"]) == (4, 6, 2, 1.5)
