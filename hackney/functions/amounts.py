"""Sums, means and rounding of money.

The trip fields are doubles, so a plain sum depends on the order of the rows. With ``exact=True``
amounts are added as whole cents in a BIGINT: the same result whatever the partitioning or the
retries, and still a fixed-width buffer that hash aggregation keeps in place. Amounts that are no
number or do not fit become NULL there, and so does a sum that does not fit: a garbled amount must
not end a stream. A plain sum lets them through. Each amount is rounded to a cent before it is added, half
to even, so of amounts with parts of a cent the parts are lost; those need a plain sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: str | Column) -> Column:
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.rint(column * 100).try_cast("bigint")


def cents_sum(amount: str) -> Column:
    return F.try_sum(cents(amount))


def total(amount: str, exact: bool = False) -> Column:
    return cents_sum(amount) / F.lit(100.0) if exact else F.sum(amount)


def mean(amount: str, exact: bool = False) -> Column:
    if exact:
        return cents_sum(amount) / F.lit(100.0) / F.count(cents(amount))
    return F.avg(amount)


def rounded(column: Column, scale: int | None) -> Column:
    """Half-up rounding; ``None`` leaves the value as it is."""
    return column if scale is None else F.round(column, scale)
