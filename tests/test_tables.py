"""Declared tables: types, conforming rows, mapping, identities."""

from __future__ import annotations

import pytest

from hackney import session
from hackney.operators.conform import conform, create_table, mapped, row_identity
from hackney.schemas import (
    ANALYTICS,
    HOTSPOT_COMMUNITY_WINDOW,
    RESULT_TABLES,
    TRIP_FILE_COLUMNS,
    TRIPS_TOTAL,
    Table,
    declared_type,
    schema_from_fields,
)


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("int", "int"),
        ("long", "bigint"),
        ("double", "double"),
        ("float", "float"),
        ("string", "string"),
        ("uuid", "string"),
        (["null", "long"], "bigint"),
    ],
)
def test_declared_types(declared, expected):
    assert declared_type(declared).simpleString() == expected


@pytest.mark.parametrize("declared", ["decimal", "timestamp", ["null", "map"]])
def test_unknown_type(declared):
    with pytest.raises(ValueError):
        schema_from_fields([("x", declared)])


def test_declared_tables():
    assert set(RESULT_TABLES) == {"analytics", "tripstotal", "sumfarewindow", "hotspotwindow", "hotspotcommunitywindow"}
    assert ANALYTICS.schema.names == TRIP_FILE_COLUMNS
    assert ANALYTICS.key == ("taxi_id", "trip_id")
    assert all(field.nullable for field in ANALYTICS.schema)


def test_conform(spark):
    table = Table("t", (("a", "int"), ("b", "string"), ("c", "long"), ("d", "float")), ("a",))
    rows = spark.createDataFrame([("7", 1, "x", 2.5)], "a STRING, extra INT, c STRING, d DOUBLE")
    shaped = conform(rows, table)
    assert shaped.schema == table.schema
    assert tuple(shaped.first()) == (7, None, None, 2.5)


def test_create_table_once(spark, folder):
    for _ in range(2):
        name = create_table(spark, TRIPS_TOTAL, str(folder / "tripstotal"))
    totals = spark.createDataFrame([(3, 1.5, 0.5, 2.0)], "trips_total BIGINT, fare_total DOUBLE, tips_avg DOUBLE, trip_total_avg DOUBLE")
    mapped(totals, TRIPS_TOTAL).write.insertInto(name)
    row = spark.table(name).first()
    assert row["trips_total"] == 3 and len(row["id"]) == 36
    assert spark.table(name).schema.names == TRIPS_TOTAL.schema.names
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["key"] == "id"


def test_mapping_renames_and_types_columns(spark):
    rows = spark.createDataFrame([("w", 28, 7)], "w STRING, area INT, n BIGINT")
    mapping = {"window": "w", "pickup_community_area": "area", "count": "n"}
    row = mapped(rows, HOTSPOT_COMMUNITY_WINDOW, mapping).first()
    assert tuple(row)[1:] == ("w", "28", 7)
    part = mapped(rows, HOTSPOT_COMMUNITY_WINDOW, {"count": "n"}).first()
    assert part["window"] is None and part["count"] == 7


def test_random_and_repeatable_identities(spark):
    rows = spark.createDataFrame([("w", 1), ("w", 2)], "w STRING, n BIGINT")
    ids = rows.select(row_identity("w", "n").alias("id"))
    assert ids.collect() == ids.collect() and ids.distinct().count() == 2
    empty = {"count": "n"}
    assert mapped(rows, HOTSPOT_COMMUNITY_WINDOW, empty).select("id").distinct().count() == 2


def test_what_a_run_has_written_on_the_way_can_go(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "_named", {})
    monkeypatch.setattr(session, "_local_root", lambda: str(folder))
    others = folder / "of-others"
    others.mkdir()
    paths = [session.scratch(spark, "rows") for _ in range(3)]
    for path in paths[:2]:
        spark.range(3).write.parquet(path)
    assert session.discard_scratch(spark) == 2
    assert sorted(p.name for p in folder.iterdir()) == ["of-others"]
    assert session.discard_scratch(spark) == 0
