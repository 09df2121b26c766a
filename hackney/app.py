"""The jobs of a tenant: files to topic, topic to results, results to tables.

    python -m hackney.app ingest --tenant acme --servers broker:9092 --files 's3a://bucket/acme/in'
    python -m hackney.app analyse --tenant acme --servers broker:9092 --checkpoints s3a://bucket/cp
    python -m hackney.app store --tenant acme --servers broker:9092 --checkpoints s3a://b/cp --tables s3a://b/t
    python -m hackney.app watch --tenant acme --servers broker:9092 --checkpoints s3a://b/cp --rule busy <topic> count 50
    python -m hackney.app history --tenant acme --files 's3a://bucket/acme/trips' --tables s3a://b/t

``--topics <folder>`` in place of ``--servers`` uses folders as topics, and ``--once`` ends a job when
it has caught up. On SIGTERM or SIGINT a job stops its queries and ends; the next start goes on from there.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hackney.functions.clock import flat_window
from hackney.functions.records import parse, serialise
from hackney.operators.alerts import Rule, alerts, conditions, episodes
from hackney.operators.conform import create_table
from hackney.operators.ingest import clean, stamp, to_wire, typed_trips
from hackney.operators.metrics import error_rate, throughput
from hackney.operators.quality import quarantined, validate
from hackney.operators.windows import fare_totals
from hackney.schemas import INGEST_TOPIC, RESULT_KEYS, RESULT_TOPICS, narrow, topic_name
from hackney.session import build_session
from hackney.sources.files import read_trip_files
from hackney.sources.wire import sasl
from hackney.streaming.commits import Commits
from hackney.streaming.keyed import KeyedTable
from hackney.streaming.landing import Landing, Taken
from hackney.streaming.late import CorrectedTotals
from hackney.streaming.progress import ProgressLog
from hackney.streaming.run import ALL_AVAILABLE, MONEY, ROCKSDB, await_all, decode, decoded, start, start_tenant, stop_on_signals
from hackney.streaming.sinks import BATCH, RUN, Sink, emission, file_sink, latest, read_table, table_sink
from hackney.streaming.topics import Broker, Folders, Topics
from hackney.streaming.unique import UniqueTrips
from hackney.workflow import Workflow, from_parquet, from_trip_files

ALERT_TOPIC = "alertStream"


def ingested(raw: DataFrame) -> DataFrame:
    """Cells of trip files as records, complete rows only, stamped with the present time."""
    return to_wire(stamp(typed_trips(clean(raw))), key="trip_id")


def ingest(
    spark: SparkSession,
    topics: Topics,
    tenant: str,
    files: str,
    checkpoints: str | None = None,
    trigger: dict | None = None,
    files_per_trigger: int | None = None,
) -> list[StreamingQuery]:
    """Send trip files to the tenant's topic: once, or with ``checkpoints`` also those yet to come."""
    topic = topic_name(tenant, INGEST_TOPIC)
    if checkpoints is None:
        topics.send(ingested(read_trip_files(spark, files)), topic)
        return []
    raw = read_trip_files(spark, files, stream=True, files_per_trigger=files_per_trigger)
    sink = topics.sink(topic)
    return [start(ingested(raw), name=topic, mode="append", sink=sink, checkpoints=checkpoints, trigger=trigger)]


def land(spark: SparkSession, topics: Topics, root: str, path: str, share: int = 100) -> list[Taken]:
    """Take what waits in the landing folders of all tenants, batch by batch, and send it to their topics.

    The records of a batch are kept below ``path`` before they are sent, and are sent again if a job ends in between.
    """
    landing = Landing(spark, root, path, ingested_by_tenant, share)
    done = []
    while True:
        send_landed(spark, topics, landing)
        taken = landing.take()
        if taken is None:
            return done
        done.append(taken)


def ingested_by_tenant(raw: DataFrame) -> DataFrame:
    """As ``ingested``, with ``tenant_id`` beside the record."""
    return to_wire(stamp(typed_trips(clean(raw))), key="trip_id", keep=("tenant_id",))


def send_landed(spark: SparkSession, topics: Topics, landing: Landing) -> None:
    """Send the records of the batches that are not sent yet to the topics of their tenants, and note it."""
    sent = Commits(spark, f"{landing.path}/sent")
    last = int((sent.last() or ("0", {}))[0])
    for number, records in landing.batches(after=last):
        tenants = [r["tenant_id"] for r in records.select("tenant_id").distinct().collect()]
        for tenant in sorted(tenants):
            topics.send(records.filter(F.col("tenant_id") == tenant).drop("tenant_id"), topic_name(tenant, INGEST_TOPIC))
        sent.commit(f"{number:012d}", {"tenants": sorted(tenants)})


def analyse(
    spark: SparkSession,
    topics: Topics,
    tenant: str,
    checkpoints: str,
    trigger: dict | None = None,
    state_partitions: int | None = None,
    quarantine: str | None = None,
    rules: Sequence[Rule] = (),
    decoded_at: str | None = None,
    corrected_at: str | None = None,
    unique_at: str | None = None,
) -> list[StreamingQuery]:
    """The four standing queries: from the tenant's trips to its result topics, as JSON.

    A result record says which run and batch has emitted it. With ``quarantine`` records that are not
    valid are kept in that folder with their reasons; with ``rules`` fares that break one go to the alerts topic.
    With ``decoded_at``, a folder, the records are parsed once, into columns there, and all queries read those. With
    ``corrected_at`` fares per window are also kept there with late trips added, which are listed, see ``CorrectedTotals``;
    with ``unique_at`` the trips themselves, each once, see ``UniqueTrips``.
    """
    records = topics.read(spark, topic_name(tenant, INGEST_TOPIC))
    queries = []

    def trips(fields: Sequence[str]) -> DataFrame:
        return parse(records, fields, keep=())

    if decoded_at:
        path = f"{decoded_at}/{tenant}"
        options = {"checkpoints": checkpoints, "trigger": trigger, "pool": tenant}
        queries.append(decode(records, path, name=topic_name(tenant, "decoded"), **options))
        if trigger == ALL_AVAILABLE:
            # The others end when they have read what is there, so it must be there.
            queries[0].awaitTermination()
        trips = decoded(spark, path)

    def sink(topic: str) -> Sink:
        return topics.sink(topic, lambda emitted, run, batch: serialise(emission(emitted, run, batch)))

    options = {"trigger": trigger, "state_partitions": state_partitions}
    queries += start_tenant(trips, tenant, sink, checkpoints, **options)
    options |= {"checkpoints": checkpoints, "pool": tenant, "mode": "append"}
    if quarantine:
        bad = quarantined(validate(records), "timestamp")
        into = file_sink(f"{quarantine}/{tenant}")
        queries.append(start(bad, name=topic_name(tenant, "quarantine"), sink=into, **options))
    if rules:
        topic = topic_name(tenant, ALERT_TOPIC)
        raised = alerts(fare_totals(trips(MONEY)), rules, keep=["window"])
        queries.append(start(raised, name=topic, sink=sink(topic), **options))
    if corrected_at:
        into = CorrectedTotals(spark, f"{corrected_at}/{tenant}").sink()
        queries.append(start(trips(MONEY), name=topic_name(tenant, "corrected"), sink=into, **options))
    if unique_at:
        into = UniqueTrips(spark, f"{unique_at}/{tenant}").sink()
        queries.append(start(parse(records, keep=()), name=topic_name(tenant, "unique"), sink=into, **options))
    return queries


def store(
    spark: SparkSession,
    topics: Topics,
    tenant: str,
    tables: str,
    checkpoints: str,
    trigger: dict | None = None,
    database: str | None = None,
    files: int | None = None,
) -> list[StreamingQuery]:
    """From the result topics, from their beginning, to the result tables: a row per result record.

    With ``database`` the tables are declared there. A batch of a table is written in as many files as its size
    needs, a small one in one, by AQE; with ``files`` in that many, whatever its size.
    """
    queries = []
    for topic, table in RESULT_TOPICS.items():
        results = results_in(spark, topics, tenant, topic)
        path = f"{tables}/{tenant}/{table.name}"
        if database:
            create_table(spark, table, path, database)
        queries.append(
            start(
                results,
                name=f"{tenant}_{table.name}",
                mode="append",
                sink=table_sink(path, table, files),
                checkpoints=checkpoints,
                trigger=trigger,
                pool=tenant,
            )
        )
    return queries


#: What ``monitor`` keeps of a topic, and what tells its rows apart.
MONITORED = {"throughput": ("window", "topic"), "errors": ("window",)}


def monitor(
    spark: SparkSession,
    topics: Topics,
    tenant: str,
    path: str,
    checkpoints: str,
    interval: str = "1 minute",
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Messages, bytes and unusable records of the tenant's topic per interval, in keyed tables that ``monitored`` reads."""
    topic = topic_name(tenant, INGEST_TOPIC)
    records = topics.read(spark, topic)
    results = {
        "throughput": throughput(records.withColumn("topic", F.lit(topic)), interval),
        "errors": error_rate(records, interval),
    }
    return [
        start(
            rows,
            name=topic_name(tenant, f"monitor_{kind}"),
            mode="update",
            sink=_monitor_table(spark, path, tenant, kind).sink(fold_every=100),
            checkpoints=checkpoints,
            trigger=trigger,
            pool=tenant,
            state_partitions=state_partitions,
        )
        for kind, rows in results.items()
    ]


def _monitor_table(spark: SparkSession, path: str, tenant: str, kind: str) -> KeyedTable:
    return KeyedTable(spark, f"{path}/{tenant}/{kind}", MONITORED[kind], buckets=8)


def monitored(spark: SparkSession, path: str, tenant: str) -> DataFrame:
    """Per interval what came in and how much of it was unusable; ``silent`` is input of which nothing was usable."""
    came, bad = (_monitor_table(spark, path, tenant, kind).read().drop(RUN, BATCH) for kind in MONITORED)
    both = flat_window(came).join(flat_window(bad), ["window_start", "window_end"], "full")
    return both.withColumn("silent", (F.col("records") > 0) & (F.col("malformed") == F.col("records")))


def watch(
    spark: SparkSession,
    topics: Topics,
    tenant: str,
    checkpoints: str,
    rules: Sequence[Rule],
    gap: dt.timedelta = dt.timedelta(minutes=10),
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Alerts that remember, on any of the results: raised once, cleared after a ``gap``, see ``episodes``.

    A query per result topic that has rules, from the topic's beginning to the alerts topic.
    """
    queries = []
    for topic in dict.fromkeys(rule.topic for rule in rules):
        broken = topic_conditions(results_in(spark, topics, tenant, topic), topic, [r for r in rules if r.topic == topic])
        queries.append(
            start(
                serialise(episodes(broken, gap)),
                name=topic_name(tenant, f"watch_{topic}"),
                mode="append",
                sink=topics.sink(topic_name(tenant, ALERT_TOPIC)),
                checkpoints=checkpoints,
                trigger=trigger,
                pool=tenant,
                state_partitions=state_partitions,
                state_store=ROCKSDB,
            )
        )
    return queries


def results_in(spark: SparkSession, topics: Topics, tenant: str, topic: str) -> DataFrame:
    """The records of a result topic, from its beginning, as columns of its table."""
    table = RESULT_TOPICS[topic]
    fields = narrow([name for name in table.schema.names if name != "id"], table.schema)
    return parse(topics.read(spark, topic_name(tenant, topic), "earliest"), fields, keep=())


def topic_conditions(results: DataFrame, topic: str, rules: Sequence[Rule]) -> DataFrame:
    """Which results of a topic break a rule, by their window or day, and by their place if they have one."""
    if "day" in results.columns:
        day = F.col("day").cast("date")
        start, end = day.cast("timestamp"), F.date_add(day, 1).cast("timestamp")
    else:
        start, end = (F.get_json_object("window", f"$.{edge}").cast("timestamp") for edge in ("start", "end"))
    place = next((name for name in RESULT_KEYS[topic] if name not in ("window", "day")), None)
    return conditions(results, rules, start, end, F.col(place) if place else None)


def results_of(spark: SparkSession, tables: str, tenant: str, topic: str) -> DataFrame:
    """The last emission of every result of a topic, from its table."""
    table = RESULT_TOPICS[topic]
    rows = read_table(spark, f"{tables}/{tenant}/{table.name}", table)
    return latest(rows, RESULT_KEYS[topic], (RUN, BATCH, "id"))


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hackney.app", description="Jobs of a tenant.")
    parser.add_argument("job", choices=["ingest", "land", "analyse", "store", "monitor", "watch", "history"])
    parser.add_argument("--tenant", help="needed by all jobs but land")
    where = parser.add_mutually_exclusive_group()
    where.add_argument("--servers", help="broker as host:port")
    where.add_argument("--topics", help="folder of topics instead of a broker")
    parser.add_argument("--sasl-username")
    parser.add_argument("--sasl-password")
    parser.add_argument("--security-protocol", default="SASL_PLAINTEXT")
    parser.add_argument("--sasl-mechanism", default="PLAIN")
    parser.add_argument("--files", help="ingest: trip files")
    parser.add_argument("--files-per-trigger", type=int, help="ingest: files of a micro-batch")
    parser.add_argument("--landing", help="land: folder with <tenant>/in of each tenant")
    parser.add_argument("--share", type=int, default=100, help="land: files of a tenant that a batch takes at most")
    parser.add_argument("--tables", help="folder of the tables of store, monitor, history and land")
    parser.add_argument("--checkpoints", help="folder that all executors share")
    parser.add_argument("--database", help="store: where the tables are declared; the tenant's name if not given")
    parser.add_argument("--quarantine", help="analyse: folder for records that are not valid")
    parser.add_argument("--alert", nargs=3, action="append", default=[], metavar=("NAME", "METRIC", "AT_LEAST"),
                        help="analyse: raise NAME where METRIC of the fares is at least a number")
    parser.add_argument("--decoded", help="analyse: folder for the parsed records, which are then parsed once")
    parser.add_argument("--corrected", help="analyse: folder for fares per window with late trips added")
    parser.add_argument("--unique", help="analyse: folder for the trips, each once however late a copy comes")
    parser.add_argument("--rule", nargs=4, action="append", default=[], metavar=("NAME", "TOPIC", "METRIC", "AT_LEAST"),
                        help="watch: raise NAME where METRIC of a result topic is at least a number")
    parser.add_argument("--interval", default="1 minute", help="monitor: of the counts")
    parser.add_argument("--gap", type=float, default=600, help="watch: seconds after which an alert is cleared")
    parser.add_argument("--trips", choices=["csv", "parquet"], default="csv", help="history: what the files are")
    parser.add_argument("--progress", help="folder for the progress of all queries")
    parser.add_argument("--once", action="store_true", help="end when all there is has been processed")
    arguments = parser.parse_args(argv)
    needed = {
        "ingest": ["files"],
        "analyse": ["checkpoints"],
        "store": ["checkpoints", "tables"],
        "monitor": ["checkpoints", "tables"],
        "watch": ["checkpoints", "rule"],
        "history": ["files", "tables"],
        "land": ["landing", "tables"],
    }[arguments.job]
    if arguments.job != "land":
        needed = ["tenant", *needed]
    if arguments.job != "history" and not (arguments.servers or arguments.topics):
        parser.error("--servers or --topics is needed")
    missing = [f"--{name}" for name in needed if not getattr(arguments, name)]
    if missing:
        parser.error(f"{arguments.job} needs {' and '.join(missing)}")
    return arguments


def _topics(arguments: argparse.Namespace) -> Topics:
    if arguments.topics:
        return Folders(arguments.topics)
    if arguments.sasl_username is None:
        return Broker(arguments.servers)
    login = (arguments.sasl_username, arguments.sasl_password or "")
    return Broker(arguments.servers, sasl(*login, arguments.security_protocol, arguments.sasl_mechanism))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    arguments = _arguments(argv)
    own = spark is None
    stop = stop_on_signals() if own else lambda: False
    spark = spark or build_session(f"hackney-{arguments.job}-{arguments.tenant}")
    if arguments.job == "history":
        extract = from_trip_files if arguments.trips == "csv" else from_parquet
        done = Workflow(spark, arguments.files, f"{arguments.tables}/{arguments.tenant}/history", extract).run()
        print(f"run {done.number}: {len(done.taken)} files, months {', '.join(done.months) or 'none'}")
        if own:
            spark.stop()
        return
    topics, tenant = _topics(arguments), arguments.tenant
    if arguments.job == "land":
        for taken in land(spark, topics, arguments.landing, f"{arguments.tables}/landed", arguments.share):
            print(f"batch {taken.batch}: {', '.join(f'{n} of {t}' for t, n in sorted(taken.files.items()))}")
        if own:
            spark.stop()
        return
    log = ProgressLog(spark, arguments.progress) if arguments.progress else None
    if log:
        spark.streams.addListener(log)
    options = {"checkpoints": arguments.checkpoints, "trigger": ALL_AVAILABLE if arguments.once else None}
    if arguments.job == "ingest":
        options["files_per_trigger"] = arguments.files_per_trigger
        queries = ingest(spark, topics, tenant, arguments.files, **options)
    elif arguments.job == "analyse":
        rules = [Rule(name, metric, float(least)) for name, metric, least in arguments.alert]
        more = {"quarantine": arguments.quarantine, "rules": rules, "decoded_at": arguments.decoded}
        more |= {"corrected_at": arguments.corrected, "unique_at": arguments.unique}
        queries = analyse(spark, topics, tenant, **more, **options)
    elif arguments.job == "monitor":
        queries = monitor(spark, topics, tenant, arguments.tables, interval=arguments.interval, **options)
    elif arguments.job == "watch":
        rules = [Rule(name, metric, float(least), topic=topic) for name, topic, metric, least in arguments.rule]
        queries = watch(spark, topics, tenant, rules=rules, gap=dt.timedelta(seconds=arguments.gap), **options)
    else:
        queries = store(spark, topics, tenant, arguments.tables, database=arguments.database or tenant, **options)
    try:
        await_all(queries, stop=stop)
    finally:
        if log:
            log.wait(queries)
            spark.streams.removeListener(log)
        if own:
            spark.stop()


if __name__ == "__main__":
    main()
