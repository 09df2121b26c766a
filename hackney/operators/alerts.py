"""Critical conditions on result rows, and the alerts that remember what they have raised."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from hackney.schemas import SUM_FARE_TOPIC


@dataclass(frozen=True)
class Rule:
    """Raise ``name`` where ``metric`` is at least (or, with ``below``, less than) ``threshold``.

    ``topic`` says of which results.
    """

    name: str
    metric: str
    threshold: float
    below: bool = False
    topic: str = SUM_FARE_TOPIC

    def broken(self) -> Column:
        value = F.col(self.metric)
        return value < F.lit(self.threshold) if self.below else value >= F.lit(self.threshold)


def alerts(results: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """A row per result row and broken rule. All rules are checked in one pass."""
    raised = [
        F.when(
            rule.broken(),
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.col(rule.metric).cast("double").alias("value"),
                F.lit(float(rule.threshold)).alias("threshold"),
            ),
        )
        for rule in rules
    ]
    return results.select(*keep, F.inline(F.array_compact(F.array(*raised))))


#: Column names of a condition and of what is raised.
FIRST, LAST = "first", "last"
RAISED, CLEARED = "raised", "cleared"


def conditions(
    results: DataFrame, rules: Sequence[Rule], start: Column, end: Column, subject: Column | None = None, delay: str | None = "0 seconds"
) -> DataFrame:
    """A row per result and broken rule: ``rule``, ``subject`` (what it is about), ``first`` and ``last``, its time, ``value``.

    In a stream all results move the watermark, not only those that break a rule; it stays ``delay`` behind.
    """
    timed = results.withColumn("__end", end)
    if delay and results.isStreaming:
        timed = timed.withWatermark("__end", delay)
    # The time goes through the structs: what filters the rows cannot then move below the watermark.
    broken = [
        F.when(
            rule.broken(),
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.coalesce((F.lit("") if subject is None else subject).cast("string"), F.lit("")).alias("subject"),
                start.cast("timestamp").alias(FIRST),
                F.col("__end").cast("timestamp").alias(LAST),
                F.col(rule.metric).cast("double").alias("value"),
                F.lit(rule.below).alias("below"),
            ),
        )
        for rule in rules
    ]
    return timed.select(F.inline(F.array_compact(F.array(*broken))))


EPISODES = "rule string, subject string, event string, at timestamp, first timestamp, last timestamp, value double"
_ISLAND = "first bigint, last bigint, value double"


class _Memory(StatefulProcessor):
    """The open episodes of a rule and subject, in microseconds, and a timer for the next one that ends."""

    def __init__(self, gap: dt.timedelta) -> None:
        self._gap = gap // dt.timedelta(microseconds=1)

    def init(self, handle) -> None:
        self._handle = handle
        self._open = handle.getListState("open", _ISLAND)

    def _row(self, key: tuple, event: str, at: int, island: list) -> tuple:
        return (*key, event, at, island[0], island[1], island[2])

    def _told(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in EPISODES.split(", ")])
            for name in ("at", FIRST, LAST):
                out[name] = pd.to_datetime(out[name], unit="us")
            yield out

    def _keep(self, islands: list[list], before: list[list]) -> None:
        """Store what is open, and have a timer for the first to end and no other."""
        ends = {(i[1] + self._gap) // 1000 + 1 for i in islands}
        for timer in {(i[1] + self._gap) // 1000 + 1 for i in before} - ends:
            self._handle.deleteTimer(timer)
        for timer in ends - {(i[1] + self._gap) // 1000 + 1 for i in before}:
            self._handle.registerTimer(timer)
        if islands:
            self._open.put([tuple(i) for i in islands])
        else:
            self._open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        islands = [list(i) for i in self._open.get()]
        before, out = [list(i) for i in islands], []
        every = pd.concat(list(rows)).sort_values([FIRST, LAST])
        spans = [every[c].astype("datetime64[us]").astype("int64").tolist() for c in (FIRST, LAST)]
        for first, last, value, below in zip(*spans, every["value"].tolist(), every["below"].tolist()):
            near = [i for i in islands if first <= i[1] + self._gap and i[0] <= last + self._gap]
            if not near:
                out.append(self._row(key, RAISED, last, [first, last, value]))
            # What came late may close the gap between two.
            worst = (min if below else max)([value, *(i[2] for i in near)])
            whole = [min([first, *(i[0] for i in near)]), max([last, *(i[1] for i in near)]), worst]
            islands = sorted([i for i in islands if i not in near] + [whole])
        self._keep(islands, before)
        yield from self._told(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        islands = [list(i) for i in self._open.get()]
        done = [i for i in islands if (i[1] + self._gap) // 1000 + 1 <= now]
        left = [i for i in islands if i not in done]
        if left:
            self._open.put([tuple(i) for i in left])
        else:
            self._open.clear()
        yield from self._told([self._row(key, CLEARED, i[1] + self._gap, i) for i in done])


def episodes(broken: DataFrame, gap: dt.timedelta) -> DataFrame:
    """From a stream of ``conditions``, in ``append`` mode, what is worth telling.

    Conditions of a rule and subject at most ``gap`` apart are one episode. Its first row to arrive raises it, those that
    follow say nothing, and when the watermark is past its last row and the gap, it is cleared: with its first
    and last time and its worst value. A condition after that raises it again. A result that is emitted several
    times counts as often without harm. Needs the RocksDB state store.
    """
    return broken.groupBy("rule", "subject").transformWithStateInPandas(
        statefulProcessor=_Memory(gap), outputStructType=EPISODES, outputMode="Append", timeMode="EventTime"
    )
