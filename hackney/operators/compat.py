"""What types the fields of records really have, and which declared versions can read them.

Every value falls into a class, and a field's classes join to the least one that can hold them all:

    nothing < small whole < whole < number < text,  and  boolean, time, object, list < text

A record's classes are bits, so the merged type of a field is an OR over its values, per task and over loads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Classes and their bits.
CLASSES = ("nothing", "small whole", "whole", "number", "boolean", "time", "object", "list", "text")
_BIT = {name: 1 << i for i, name in enumerate(CLASSES)}
_CHAIN = ("nothing", "small whole", "whole", "number")
FIELD, MASK, PRESENT, NULLS = "field", "mask", "present", "nulls"

#: How a time begins; Spark takes four digits alone for a year.
_DATED = r"\A\d{4}-\d{2}-\d{2}"

_DECLARED = {
    T.ByteType: "small whole", T.ShortType: "small whole", T.IntegerType: "small whole", T.LongType: "whole",
    T.FloatType: "number", T.DoubleType: "number", T.DecimalType: "number", T.BooleanType: "boolean",
    T.TimestampType: "time", T.TimestampNTZType: "time", T.DateType: "time", T.StringType: "text",
    T.StructType: "object", T.MapType: "object", T.ArrayType: "list",
}


def declared_class(kind: T.DataType) -> str:
    """The class that a declared type can hold, with all below it."""
    return _DECLARED[type(kind)]


def _below(name: str) -> int:
    """Bits of the classes that a class can hold."""
    if name == "text":
        return (1 << len(CLASSES)) - 1
    if name in _CHAIN:
        return sum(_BIT[c] for c in _CHAIN[: _CHAIN.index(name) + 1])
    return _BIT["nothing"] | _BIT[name]


def _value_class(value: Column) -> Column:
    """The bit of a variant's class."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    whole = F.try_variant_get(value, "$", "bigint")
    small = whole.between(-(2**31), 2**31 - 1)
    bit = {name: F.lit(b) for name, b in _BIT.items()}
    return (
        F.when(kind == "VOID", bit["nothing"])
        .when(kind == "BIGINT", F.when(small, bit["small whole"]).otherwise(bit["whole"]))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), bit["number"])
        .when(kind == "BOOLEAN", bit["boolean"])
        .when(kind.startswith("OBJECT"), bit["object"])
        .when(kind.startswith("ARRAY"), bit["list"])
        .when(F.regexp_like(text, F.lit(_DATED)) & F.try_to_timestamp(text).isNotNull(), bit["time"])
        .otherwise(bit["text"])
    )


def field_types(records: DataFrame, value: str = "value") -> DataFrame:
    """Per field of the JSON objects: ``present`` values, of which ``nulls``, and the ``mask`` of their classes.

    Reports of several loads are put together by ``merge_types``. What is no JSON object is left out. The shuffle
    carries a row per task and field.
    """
    parsed = records.select(F.try_parse_json(F.col(value).cast("string")).alias("__v"))
    objects = parsed.filter(F.schema_of_variant("__v").startswith("OBJECT"))
    fields = objects.lateralJoin(records.sparkSession.tvf.variant_explode(F.col("__v").outer()))
    each = fields.select(F.col("key").alias(FIELD), _value_class(F.col("value")).alias(MASK))
    nulls = F.count_if(F.col(MASK) == _BIT["nothing"]).alias(NULLS)
    return each.groupBy(FIELD).agg(F.count("*").alias(PRESENT), nulls, F.bit_or(MASK).alias(MASK))


def merge_types(reports: DataFrame) -> DataFrame:
    """One report of several in a union."""
    return reports.groupBy(FIELD).agg(F.sum(PRESENT).alias(PRESENT), F.sum(NULLS).alias(NULLS), F.bit_or(MASK).alias(MASK))


def _holds(mask: Column, name: Column) -> Column:
    """Whether a class can hold all classes of a mask."""
    cases = F.lit(None).cast("boolean")
    for known in CLASSES:
        cases = F.when(name == known, mask.bitwiseAND(F.lit(~_below(known) & (1 << len(CLASSES)) - 1)) == 0).otherwise(cases)
    return cases


def merged_class(mask: Column) -> Column:
    """The least class that holds all of a mask."""
    out = F.lit("text")
    for name in reversed(CLASSES[:-1]):
        out = F.when(mask.bitwiseAND(F.lit(~_below(name) & (1 << len(CLASSES)) - 1)) == 0, F.lit(name)).otherwise(out)
    return out


def compatibility(types: DataFrame, versions: Mapping[str, T.StructType]) -> DataFrame:
    """Per declared version and field: the declared and the found class, a ``status``, and both directions.

    ``status``: ``same``; ``narrowed``, the declared type holds more than was found; ``widened``, it cannot hold all
    values; ``added``, found but not declared; ``lost``, declared but never there, or always null.
    ``old_reads_new``: a reader of the version gets every value. ``new_reads_old``: a reader of the found types
    gets every value that the version may hold.
    """
    spark = types.sparkSession
    rows = [(v, f.name, declared_class(f.dataType)) for v, schema in versions.items() for f in schema]
    declared = spark.createDataFrame(rows, "version STRING, field STRING, declared STRING")
    # A row per version, and per version and declared field.
    names = spark.createDataFrame([(v,) for v in versions], "version STRING")
    found = types.select(F.col(FIELD), MASK, merged_class(F.col(MASK)).alias("found")).filter(F.col("found") != "nothing")
    wanted = found.select(F.explode(F.array(*map(F.lit, versions))).alias("version"), FIELD, MASK, "found") if versions else names.limit(0)
    both = wanted.join(declared, ["version", FIELD], "full")
    holds = _holds(F.col(MASK), F.col("declared"))
    below = F.lit(None).cast("boolean")
    for known in CLASSES:
        able = [c for c in CLASSES if _below(known) & ~_below(c) == 0]
        below = F.when(F.col("declared") == known, F.col("found").isin(able)).otherwise(below)
    status = (
        F.when(F.col("declared").isNull(), "added")
        .when(F.col("found").isNull(), "lost")
        .when(F.col("declared") == F.col("found"), "same")
        .when(holds, "narrowed")
        .otherwise("widened")
    )
    return both.select(
        "version",
        FIELD,
        "declared",
        "found",
        status.alias("status"),
        F.coalesce(holds, F.lit(True)).alias("old_reads_new"),
        F.when(F.col("declared").isNull(), F.lit(True)).when(F.col("found").isNull(), F.lit(False)).otherwise(below).alias("new_reads_old"),
    )
