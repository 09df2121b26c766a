"""Quantiles from counts by level: sketches that add up, and are the same in every run.

A level is a whole number cut to its leading binary digits, so it is off by less than ``2 ** -bits`` of the number,
and a group has some hundred levels at most, however many rows. The counts are whole, their sums do not depend on any
order, and sketches of several loads are put together by adding up their counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Binary digits behind the first: levels are 0.8 % apart.
BITS = 7
MEASURE, LEVEL, MANY = "measure", "level", "many"


def level(number: Column, bits: int = BITS) -> Column:
    """The level of a whole number, towards 0. NULL has none."""
    size = F.abs(number.cast("bigint"))
    cut = F.greatest(F.length(F.bin(size)) - (bits + 1), F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, cut), cut)
    return F.when(number < 0, -low).otherwise(low)


def sketch(rows: DataFrame, measures: Mapping[str, Column], by: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """``by``, ``measure``, ``level`` and ``many``: how many rows of a group have a measure, a whole number, on a level."""
    each = [F.struct(F.lit(name).alias(MEASURE), level(number, bits).alias(LEVEL)) for name, number in measures.items()]
    spread = rows.select(*by, F.inline(F.array(*each))).filter(F.col(LEVEL).isNotNull())
    return spread.groupBy(*by, MEASURE, LEVEL).agg(F.count("*").alias(MANY))


def quantiles(made: DataFrame, shares: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``measure``, a column per share, and ``many`` rows, of one sketch or several in a union.

    A quantile is the first level up to which that share of the rows lies. No window has more rows than a group has levels.
    """
    whole = made.groupBy(*by, MEASURE, LEVEL).agg(F.sum(MANY).alias(MANY))
    group = Window.partitionBy(*by, MEASURE)
    counted = whole.withColumns({"__up_to": F.sum(MANY).over(group.orderBy(LEVEL)), "__all": F.sum(MANY).over(group)})
    found = [F.min(F.when(F.col("__up_to") >= F.ceil(F.col("__all") * F.lit(q)), F.col(LEVEL))).alias(name) for name, q in shares.items()]
    return counted.groupBy(*by, MEASURE).agg(*found, F.max("__all").alias(MANY))
