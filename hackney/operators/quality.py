"""Checks on records and trips: valid or not and why, drift of the schema, duplicates, gaps."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.amounts import cents
from hackney.functions.clock import EVENT_TIME, watermarked
from hackney.functions.records import CORRUPT
from hackney.operators.sketch import BITS, quantiles, sketch
from hackney.operators.windows import DELAY
from hackney.schemas import TRIP

REQUIRED = ("trip_id", EVENT_TIME)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _check(records: DataFrame, schema: T.StructType, keep: Sequence[str]) -> DataFrame:
    """Parsed fields plus, for the records Spark calls corrupt, the text ``_raw`` of every field.

    Sound records are parsed once. ``inline`` keeps filters from pulling copies of the parses down.
    """
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = records.select(
        *keep,
        F.col("value").cast("string").alias("_text"),
        F.inline(F.array(F.from_json(F.col("value").cast("string"), checked, {"columnNameOfCorruptRecord": CORRUPT}))),
    )
    raw = F.when(F.col(CORRUPT).isNotNull(), F.from_json("_text", _as_text(schema)))
    return parsed.select("*", F.inline(F.array(F.struct(raw.alias("_raw")))))


def _reason(condition: Column, text: str) -> Column:
    return F.when(condition, F.lit(text))


def validate(
    records: DataFrame,
    schema: T.StructType = TRIP,
    required: Sequence[str] = REQUIRED,
    keep: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Parsed records with ``reasons``: the (possibly empty) list of what is wrong with each.

    ``unreadable``: no JSON object, or none of the declared fields. Otherwise per field
    ``missing:f`` (required, absent or null), ``wrong type:f`` (there, but of another type) and
    ``not a number:f``.
    """
    checked = _check(records, schema, keep)
    nothing = F.coalesce(*[F.col(f.name).cast("string") for f in schema]).isNull()
    no_text = F.col("_raw").isNull() | F.coalesce(*[F.col(f"_raw.{f.name}") for f in schema]).isNull()
    unreadable = nothing & no_text
    found: list[Column] = [_reason(unreadable, "unreadable")]
    for field in schema:
        name, value = field.name, F.col(field.name)
        wrong = value.isNull() & F.col(f"_raw.{name}").isNotNull()
        if name in required:
            found.append(_reason(~unreadable & value.isNull() & ~wrong, f"missing:{name}"))
        if not isinstance(field.dataType, T.StringType):
            found.append(_reason(wrong, f"wrong type:{name}"))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            found.append(_reason(F.isnan(value), f"not a number:{name}"))
    reasons = F.array_except(F.array(*found), F.array(F.lit(None).cast("string"))).alias("reasons")
    return checked.select(*schema.names, *keep, F.col("_text").alias("value"), reasons)


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") == 0).drop("reasons", "value")


def quarantined(checked: DataFrame, *keep: str) -> DataFrame:
    """Text of the bad records with the reasons and, as ``keep``, columns to find them by."""
    return checked.filter(F.size("reasons") > 0).select(*keep, "value", "reasons")


def drift_report(records: DataFrame, schema: T.StructType = TRIP) -> DataFrame:
    """Per field: records that have it, lack it, hold an unusable value; and whether it is declared.

    Fields are counted per task before the shuffle, so it carries a row per task and field, whatever sets
    of names the records have.
    """
    checked = _check(records, schema, ())
    # json_object_keys knows no NaN; for such records a parse as a map does.
    as_map = F.from_json("_text", T.MapType(T.StringType(), T.StringType()))
    names = F.coalesce(F.json_object_keys("_text"), F.map_keys(as_map), F.array().cast("array<string>"))

    def counted(field: Column, present: Column, unusable: Column) -> Column:
        numbers = {"field": field, "present": present.cast("bigint"), "unusable": unusable.cast("bigint")}
        return F.struct(*(value.alias(name) for name, value in numbers.items()))

    declared = [
        counted(F.lit(f.name), F.array_contains("names", f.name), F.col(f.name).isNull() & F.col(f"_raw.{f.name}").isNotNull())
        for f in schema
    ]
    extra = F.array_except("names", F.array(*[F.lit(name) for name in schema.names]))
    rows = F.concat(F.array(*declared), F.transform(extra, lambda name: counted(name, F.lit(1), F.lit(0))))
    spread = checked.withColumn("names", names).select(F.inline(rows))
    report = spread.groupBy("field").agg(
        F.sum("present").alias("present"), F.sum(F.coalesce("unusable", F.lit(0))).alias("unusable")
    )
    return report.withColumn("declared", F.col("field").isin(schema.names))


def compatible(old: T.StructType, new: T.StructType) -> list[str]:
    """Why data written with ``new`` cannot be read as ``old``; empty if it can."""
    problems = [f"removed:{f.name}" for f in old if f.name not in new.names]
    changed = [f.name for f in old if f.name in new.names and new[f.name].dataType != f.dataType]
    return problems + [f"retyped:{name}" for name in changed]


def _combine_copies(trips: DataFrame, key: Sequence[str], event_time: str) -> DataFrame:
    """Of the copies within one Arrow batch keep the one with the latest event time.

    A copy that is too late for the watermark thus never displaces one that is not.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pc.sort_indices(batch.column(event_time), sort_keys=[("", "descending")])
            keys = pa.table({"row": order, **{name: batch.column(name).take(order) for name in key}})
            first = keys.group_by(list(key), use_threads=False).aggregate([("row", "first")])
            yield batch.take(first["row_first"].combine_chunks())

    return trips.mapInArrow(combine, trips.schema)


#: Of all rows, the share from which on a key is heavy; so there are a thousand heavy keys at most.
HEAVY = 0.001
#: Keys that are counted at once to find those; more than enough for their counts to be close.
TRACKED = 16_384
#: Number that tells rows without a key apart. They have no copies.
_SOLE = "__sole"


def _earliest(trips: DataFrame, key: Sequence[str], event_time: str) -> DataFrame:
    """One row per key in batch; see ``dedupe``."""
    rest = [name for name in trips.columns if name not in key]
    order = sorted(rest, key=lambda name: name != event_time)
    whole = reduce(and_, (F.col(name).isNotNull() for name in key))
    keyed = trips.filter(whole)
    code = F.xxhash64(*key)
    # Hashes of the keys that have many copies, from one look at the keys and without a shuffle of them: a sketch of
    # the frequent ones. It is close, and need not be more, as either way gives the same rows.
    frequent = F.call_function("approx_top_k", code, F.lit(min(TRACKED, max(1, round(1 / HEAVY)))), F.lit(TRACKED)).alias("frequent")
    seen = keyed.agg(F.count("*").alias("rows"), frequent).first()
    many = max(1, int(HEAVY * seen["rows"]))
    heavy = [item["item"] for item in seen["frequent"] or [] if item["count"] > many]
    hot = whole & code.isin(heavy) if heavy else F.lit(False)
    # A row without a key gets a number, so it is the only one of its kind.
    numbered = trips.filter(~hot).withColumn(_SOLE, F.when(~whole, F.monotonically_increasing_id()))
    nth = F.row_number().over(Window.partitionBy(*key, _SOLE).orderBy(*order))
    light = numbered.withColumn(_SOLE, nth).filter(F.col(_SOLE) == 1).drop(_SOLE)
    if not heavy:
        return light
    # Of the heavy keys a row per task goes into the shuffle.
    first = F.min(F.struct(*order)).alias("_first")
    reduced = trips.filter(hot).groupBy(*key).agg(first).select(*key, "_first.*").select(*trips.columns)
    return light.unionByName(reduced)


def dedupe(
    trips: DataFrame,
    key: Sequence[str] = ("trip_id",),
    delay: str = DELAY,
    event_time: str = EVENT_TIME,
    hot_keys: bool = True,
) -> DataFrame:
    """One row per key. Rows without a key (or part of it) are no copies of each other and all stay.

    A batch keeps the earliest copy; ties go by the other columns, so the choice does not depend on
    the order of the rows. Of keys with very many copies, which a sketch finds, the minimum is taken per task first, so that
    they reach the shuffle as one row per task; all other rows are sorted once, behind the shuffle.
    Which way a key goes makes no difference to the result.

    A stream drops copies that arrive within the watermark of the first one to arrive; it cannot wait for
    the earliest. Spark has no combining before the shuffle of a stream, so copies are combined per
    Arrow batch there: of a key that is a third of all rows one row per some thousand is left, without a
    second state store. ``hot_keys=False`` spares the way through Arrow where no key can have many copies.
    A row without a key gets a number for its state, so it neither drops others nor piles up with them.
    """
    if trips.isStreaming:
        sole = F.when(~reduce(and_, (F.col(name).isNotNull() for name in key)), F.uuid())
        numbered = trips.withColumn(_SOLE, sole)
        few = _combine_copies(numbered, [*key, _SOLE], event_time) if hot_keys else numbered
        return watermarked(few, delay, event_time).dropDuplicatesWithinWatermark([*key, _SOLE]).drop(_SOLE)
    return _earliest(trips, key, event_time)


def preprocess(
    trips: DataFrame,
    required: Sequence[str] = REQUIRED,
    fill: Mapping[str, float | str] | None = None,
    not_negative: Sequence[str] = ("fare", "tips", "trip_total"),
) -> DataFrame:
    """Ready stored trips for batch work.

    Drops rows without a required field or with a negative or infinite amount; a NaN becomes NULL;
    then missing values are filled.
    """
    doubles = [f.name for f in trips.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    present = trips.dropna(how="any", subset=list(required))
    numbers = present.withColumns({name: F.when(~F.isnan(name), F.col(name)) for name in doubles})
    for name in not_negative:
        sound = (F.col(name) >= 0) & (F.col(name) < float("inf"))
        numbers = numbers.filter(F.col(name).isNull() | sound)
    return numbers.fillna(dict(fill)) if fill else numbers


QUARTILES = {"low_quarter": 0.25, "high_quarter": 0.75}


def amount_sketch(trips: DataFrame, by: Sequence[str], amounts: Sequence[str] = ("fare", "trip_total")) -> DataFrame:
    """How the amounts of each group are spread, in cents; see ``hackney.operators.sketch``."""
    return sketch(trips, {name: cents(name) for name in amounts}, by)


def amount_fences(made: DataFrame, by: Sequence[str], width: int = 3, least: int = 100) -> DataFrame:
    """Per group and amount ``lowest`` and ``highest``, in cents: ``width`` times the quarters' distance beyond them.

    The distance counts as ``least`` cents at least, and as what a level may be off, so that a group of all but equal
    amounts has some room.
    """
    off = F.shiftright(F.abs("high_quarter"), BITS) + 1
    wide = F.greatest(F.col("high_quarter") - F.col("low_quarter"), F.lit(least), off) * F.lit(width)
    lowest, highest = F.col("low_quarter") - wide, F.col("high_quarter") + wide
    return quantiles(made, QUARTILES, by).select(*by, "measure", lowest.alias("lowest"), highest.alias("highest"))


def drop_outliers(
    trips: DataFrame, by: Sequence[str], amounts: Sequence[str] = ("fare", "trip_total"), fences: DataFrame | None = None
) -> DataFrame:
    """Trips whose amounts lie within the fences of their group: those given (of earlier trips, say), or their own.

    A missing amount is no outlier, and a group without fences has none. A NULL group is one like others. The fences
    are a row per group; a hot group is a skewed join, which Spark splits where it does not broadcast them.
    """
    fences = amount_fences(amount_sketch(trips, by, amounts), by) if fences is None else fences
    limits = fences.groupBy(*by).agg(
        *[F.max(F.when(F.col("measure") == name, F.struct("lowest", "highest"))).alias(f"__{name}") for name in amounts]
    )
    limits = limits.withColumnsRenamed({name: f"__by_{name}" for name in by})
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"__by_{name}")) for name in by)) if by else F.lit(True)
    joined = trips.join(limits, same, "left")
    inside = [
        F.coalesce(cents(name).between(F.col(f"__{name}.lowest"), F.col(f"__{name}.highest")), F.lit(True)) for name in amounts
    ]
    return joined.filter(reduce(and_, inside)).select(*trips.columns)
