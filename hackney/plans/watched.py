"""Alerts with memory, and one decode for all standing queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions.clock import flat_window
from hackney.operators.alerts import Rule, conditions, episodes
from hackney.operators.daily import day_report, totals_by_day
from hackney.operators.windows import COMMUNITY, community_hot_spots, fare_totals
from hackney.plans.fixtures import TRIPS, batch_trips, cores, event_wire, in_quarters, sql_sliding, table
from hackney.plans.registry import plan
from hackney.plans.streams import sql_standing, standing
from hackney.plans.windows import SQL_BY_DAY, sql_fares
from hackney.schemas import INGEST_TOPIC, RESULT_KEYS, topic_name
from hackney.session import scratch
from hackney.streaming.run import ALL_AVAILABLE, ROCKSDB, STANDING, await_all, decode, decoded, start, start_tenant
from hackney.streaming.sinks import file_sink, read_latest, versioned_sink
from hackney.streaming.topics import Folders

#: Half a second more than the distance of any two windows, so that no two lie exactly so far apart.
GAPS = {"fares": dt.timedelta(hours=2, milliseconds=500), "days": dt.timedelta(hours=30), "areas": dt.timedelta(minutes=45, milliseconds=500)}
WATCHED = {
    "fares": (Rule("fares high", "total_fare", 500.0), Rule("fares low", "total_fare", 60.0, below=True)),
    "days": (Rule("busy day", "trips_total", 32.0),),
    "areas": (Rule("crowded", "count", 2.0),),
}


def _sql_conditions(kind: str, subject: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, '{r.name}' AS rule, {subject} AS subject, "first", "last",
                   cast({r.metric} AS double) AS value, {str(r.below)} AS below
            FROM {kind} WHERE {r.metric} {'<' if r.below else '>='} {r.threshold}"""
        for r in WATCHED[kind]
    )


def _sql_gap() -> str:
    cases = " ".join(f"WHEN '{kind}' THEN INTERVAL '{gap.total_seconds() * 1000:.0f} milliseconds'" for kind, gap in GAPS.items())
    return f"CASE kind {cases} END"


@plan(
    f"""
WITH trips AS ({TRIPS}),
     fares AS (SELECT *, window_start AS "first", window_end AS "last" FROM ({sql_fares('1 hour', 2)})),
     days AS (SELECT *, cast(day AS timestamp) AS "first", cast(day AS timestamp) + INTERVAL '1 day' AS "last" FROM ({SQL_BY_DAY})),
     areas AS (SELECT *, window_start AS "first", window_end AS "last"
               FROM ({sql_sliding('pickup_community_area', 'pickup_community_area IS NOT NULL')})),
     passed AS (SELECT 'fares' AS kind, max("last") AS at FROM fares UNION ALL SELECT 'days', max("last") FROM days
                UNION ALL SELECT 'areas', max("last") FROM areas),
     broken AS ({_sql_conditions('fares', "''")} UNION ALL {_sql_conditions('days', "''")}
                UNION ALL {_sql_conditions('areas', 'cast(pickup_community_area AS varchar)')}),
     gapped AS (SELECT *, {_sql_gap()} AS gap FROM broken),
     marked AS (SELECT *, coalesce("first" > max("last") OVER (PARTITION BY rule, subject ORDER BY "first", "last"
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + gap, true) AS begins FROM gapped),
     numbered AS (SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY rule, subject ORDER BY "first", "last"
                         ROWS UNBOUNDED PRECEDING) AS episode FROM marked),
     ended AS (SELECT kind, rule, subject, episode, min("first") AS "first", max("last") AS "last", any_value(gap) AS gap,
                      CASE WHEN any_value(below) THEN min(value) ELSE max(value) END AS value
               FROM numbered GROUP BY kind, rule, subject, episode)
SELECT rule, subject, 'raised' AS event, "last" AS at, "first", "last", value FROM numbered WHERE begins
UNION ALL
SELECT rule, subject, 'cleared', "last" + gap, "first", "last", value FROM ended JOIN passed USING (kind)
WHERE "last" + gap < passed.at
"""
)
def stream_alert_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on fares, days and areas. The results arrive in thirds of their time; the query starts anew for each."""
    trips = batch_trips(spark, sf_dir)
    results = {
        "fares": flat_window(fare_totals(trips, size="1 hour", scale=2, exact=True)),
        "days": day_report(totals_by_day(trips), scale=None),
        "areas": flat_window(community_hot_spots(trips)),
    }
    checkpoints, thirds, topics, paths = scratch(spark, "checkpoints"), {}, {}, {}
    for kind, rows in results.items():
        start_of = F.col("day").cast("timestamp_ntz") if kind == "days" else F.col("window_start")
        end_of = F.date_add("day", 1).cast("timestamp_ntz") if kind == "days" else F.col("window_end")
        bounds = rows.agg(F.min(start_of).alias("a"), F.max(start_of).alias("b")).first()
        whole = max(1, (bounds["b"] - bounds["a"]).total_seconds())
        third = F.least(F.floor(3 * F.timestamp_diff("SECOND", F.lit(bounds["a"]), start_of) / whole), F.lit(2))
        rows = rows.withColumns({"third": third, "__first": start_of.cast("timestamp"), "__last": end_of.cast("timestamp")})
        thirds[kind], topics[kind], paths[kind] = (scratch(spark, label) for label in ("thirds", "results", "alerts"))
        rows.write.partitionBy("third").parquet(thirds[kind])
    for n in range(3):
        queries = []
        for kind in results:
            part = spark.read.parquet(thirds[kind]).filter(F.col("third") == n).drop("third")
            part.write.mode("append").parquet(topics[kind])
            arriving = spark.readStream.schema(part.schema).parquet(topics[kind])
            subject = F.col(COMMUNITY) if kind == "areas" else None
            broken = conditions(arriving, WATCHED[kind], F.col("__first"), F.col("__last"), subject)
            queries.append(
                start(
                    episodes(broken, GAPS[kind]),
                    name=f"episodes_{kind}",
                    mode="append",
                    sink=file_sink(paths[kind]),
                    checkpoints=checkpoints,
                    trigger=ALL_AVAILABLE,
                    # Few rows break a rule, and every task of such a state starts a Python process.
                    state_partitions=2,
                    state_store=ROCKSDB,
                )
            )
        await_all(queries, poll_seconds=0.1)
    raised = [spark.read.parquet(path) for path in paths.values()]
    every = reduce(DataFrame.unionByName, raised)
    return every.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("at", "first", "last")})


@plan(sql_standing())
def stream_decoded_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standing queries over a topic whose records are parsed by one query, for all of them."""
    topics, root, path = Folders(scratch(spark, "topics")), scratch(spark, "results"), scratch(spark, "decoded")
    topics.send(event_wire(table(spark, sf_dir, "events"), in_quarters), topic_name("acme", INGEST_TOPIC))
    options = {"checkpoints": scratch(spark, "checkpoints"), "trigger": ALL_AVAILABLE, "state_partitions": cores(spark)}
    decode(topics.read(spark, topic_name("acme", INGEST_TOPIC)), path, name="decode", **options).awaitTermination()
    await_all(start_tenant(decoded(spark, path), "acme", lambda topic: versioned_sink(f"{root}/{topic}"), **options))

    def results(topic: str) -> DataFrame:
        rows = read_latest(spark, f"{root}/{topic_name('acme', topic)}", RESULT_KEYS[topic])
        start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
        return standing(topic, rows, F.col("day").cast("string") if "day" in rows.columns else start)

    return reduce(DataFrame.unionByName, [results(topic) for topic in STANDING])
