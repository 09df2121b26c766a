"""Schemas of the trip stream, the trip file and the result tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

TEXT, INT, DOUBLE, TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def schema_of(**fields: T.DataType) -> T.StructType:
    """A schema of nullable fields."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The 24 fields of a trip record on the wire and their types.
TRIP = schema_of(
    trip_id=TEXT,
    taxi_id=TEXT,
    trip_start_timestamp=TIME,
    trip_end_timestamp=TIME,
    trip_seconds=INT,
    trip_miles=DOUBLE,
    pickup_census_tract=DOUBLE,
    dropoff_census_tract=DOUBLE,
    pickup_community_area=INT,
    dropoff_community_area=DOUBLE,
    fare=DOUBLE,
    tips=DOUBLE,
    tolls=DOUBLE,
    extras=DOUBLE,
    trip_total=DOUBLE,
    payment_type=TEXT,
    company=TEXT,
    pickup_centroid_latitude=DOUBLE,
    pickup_centroid_longitude=DOUBLE,
    pickup_centroid_location=TEXT,
    dropoff_centroid_latitude=DOUBLE,
    dropoff_centroid_longitude=DOUBLE,
    dropoff_centroid_location=TEXT,
    event_timestamp=TIME,
)

# The trip file has the same columns by position, without the ingest time.
TRIP_FILE_COLUMNS = [name for name in TRIP.names if name != "event_timestamp"]

# Cell texts of a trip file that mean "no value" besides a blank cell.
NULL_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Time formats of the trip file and of the wire.
TRIP_TIME_FORMAT = "MM/dd/yyyy hh:mm:ss a"
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# A record as a broker hands it over.
WIRE = schema_of(key=T.BinaryType(), value=T.BinaryType(), timestamp=TIME)

# Types a declared table may use.
DECLARED_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "string": T.StringType(),
    "uuid": T.StringType(),
}

Field = tuple[str, str | Sequence[str]]


@dataclass(frozen=True)
class Table:
    """A declared table: its fields in order and its key columns."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return schema_from_fields(self.fields)

    def with_emission(self, *more: Field) -> Table:
        """The table with further fields, and the run and batch that have emitted each row."""
        return replace(self, fields=(*self.fields, *more, ("run", "long"), ("batch_id", "long")))


def declared_type(declared: str | Sequence[str]) -> T.DataType:
    """Spark type of a declared type; of a union ``["null", x]`` it is that of ``x``."""
    name = declared if isinstance(declared, str) else declared[1]
    if name not in DECLARED_TYPES:
        raise ValueError(f"Unsupported declared type: {name}")
    return DECLARED_TYPES[name]


def schema_from_fields(fields: Iterable[Field]) -> T.StructType:
    """All fields are nullable, whether or not they are declared as a union with null."""
    return schema_of(**{name: declared_type(kind) for name, kind in fields})


def narrow(names: Iterable[str], schema: T.StructType = TRIP) -> T.StructType:
    """The named fields only. A query that parses two fields should not pay for 24."""
    return T.StructType([schema[name] for name in names])


# Declared result tables.
ANALYTICS = Table(
    "analytics",
    (
        ("trip_id", "string"),
        ("taxi_id", "string"),
        ("trip_start_timestamp", "string"),
        ("trip_end_timestamp", "string"),
        ("trip_seconds", "int"),
        ("trip_miles", "float"),
        ("pickup_census_tract", ("null", "long")),
        ("dropoff_census_tract", ("null", "long")),
        ("pickup_community_area", ("null", "int")),
        ("dropoff_community_area", ("null", "int")),
        ("fare", "int"),
        ("tips", "float"),
        ("tolls", "int"),
        ("extras", "int"),
        ("trip_total", "float"),
        ("payment_type", "string"),
        ("company", "string"),
        ("pickup_centroid_latitude", "float"),
        ("pickup_centroid_longitude", "float"),
        ("pickup_centroid_location", "string"),
        ("dropoff_centroid_latitude", "float"),
        ("dropoff_centroid_longitude", "float"),
        ("dropoff_centroid_location", "string"),
    ),
    ("taxi_id", "trip_id"),
)
TRIPS_TOTAL = Table(
    "tripstotal",
    (
        ("id", "uuid"),
        ("trips_total", "int"),
        ("fare_total", "float"),
        ("tips_avg", "float"),
        ("trip_total_avg", "float"),
    ),
    ("id",),
)
SUM_FARE_WINDOW = Table(
    "sumfarewindow",
    (
        ("id", "uuid"),
        ("window", "string"),
        ("total_fare", "float"),
        ("tips_fare", "float"),
        ("total_trip_total", "float"),
    ),
    ("id",),
)
HOTSPOT_WINDOW = Table(
    "hotspotwindow",
    (
        ("id", "uuid"),
        ("window", "string"),
        ("pickup_centroid_location", "string"),
        ("count", "int"),
    ),
    ("id",),
)
HOTSPOT_COMMUNITY_WINDOW = Table(
    "hotspotcommunitywindow",
    (
        ("id", "uuid"),
        ("window", "string"),
        ("pickup_community_area", "string"),
        ("count", "int"),
    ),
    ("id",),
)
RESULT_TABLES = {
    table.name: table
    for table in (ANALYTICS, TRIPS_TOTAL, SUM_FARE_WINDOW, HOTSPOT_WINDOW, HOTSPOT_COMMUNITY_WINDOW)
}

# The names of the result topics.
TRIPS_TOTAL_TOPIC = "tripsTotalStream"
SUM_FARE_TOPIC = "sumFareWindowStream"
HOTSPOT_TOPIC = "hotspotWindowStream"
HOTSPOT_COMMUNITY_TOPIC = "hotspotCommunityPickupWindowStream"
# The table that each topic feeds, as it is stored, and what tells its results apart.
RESULT_TOPICS = {
    TRIPS_TOTAL_TOPIC: TRIPS_TOTAL.with_emission(("day", "string")),
    SUM_FARE_TOPIC: SUM_FARE_WINDOW.with_emission(),
    HOTSPOT_TOPIC: HOTSPOT_WINDOW.with_emission(),
    HOTSPOT_COMMUNITY_TOPIC: HOTSPOT_COMMUNITY_WINDOW.with_emission(),
}
RESULT_KEYS = {
    TRIPS_TOTAL_TOPIC: ("day",),
    SUM_FARE_TOPIC: ("window",),
    HOTSPOT_TOPIC: ("window", "pickup_centroid_location"),
    HOTSPOT_COMMUNITY_TOPIC: ("window", "pickup_community_area"),
}
INGEST_TOPIC = "ingestData"


def topic_name(tenant: str, topic: str) -> str:
    """Topics of a tenant carry its name in front."""
    return f"{tenant}_{topic}"
