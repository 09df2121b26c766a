"""What comes late, twice or in heaps: corrected windows, unique trips, landing folders in shares, merged progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions.records import parse
from hackney.operators.ingest import clean, typed_trips
from hackney.operators.metrics import progress_rows
from hackney.operators.windows import fare_totals
from hackney.plans.fixtures import TRIPS, batch_trips, event_trips, event_wire, finish, in_thirds, table, trip_file_rows
from hackney.plans.quality import SQL_TRIPS, UNIQUE
from hackney.plans.registry import plan
from hackney.plans.streams import MANY, PASSED, many_batches
from hackney.plans.windows import sql_fares
from hackney.session import scratch
from hackney.sources.store import hadoop_files
from hackney.streaming.landing import Landing
from hackney.streaming.late import CorrectedTotals
from hackney.streaming.progress import ProgressLog, merge_progress, progress_log
from hackney.streaming.run import MONEY
from hackney.streaming.sinks import versioned_sink
from hackney.streaming.unique import UniqueTrips

SQL_MARK = f"mark AS (SELECT {PASSED} AS passed FROM trips WHERE payment_type <> 'error')"


def _corrected(spark: SparkSession, sf_dir: str) -> CorrectedTotals:
    """Trips of type error arrive after all others, most of them long after their window has closed."""
    totals = CorrectedTotals(spark, scratch(spark, "corrected"), size="1 hour", buckets=8)
    source, checkpoints = scratch(spark, "trips"), scratch(spark, "checkpoints")
    for n, part in enumerate(("payment_type <> 'error'", "payment_type = 'error'")):
        _with_time(batch_trips(spark, sf_dir).filter(part)).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        finish(arriving, name="corrected", mode="append", sink=totals.sink(), checkpoints=checkpoints)
        if n == 0:
            totals.fold()
    return totals


@plan(
    f"""
WITH trips AS ({TRIPS}), {SQL_MARK}, fares AS ({sql_fares('1 hour', 2)}),
     numbers AS (
       SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS window_start, count(*) AS trips,
              count(*) FILTER (payment_type = 'error'
                AND time_bucket(INTERVAL '1 hour', event_timestamp) + INTERVAL '1 hour' <= mark.passed) AS late_trips
       FROM trips, mark GROUP BY 1)
SELECT fares.*, numbers.trips, numbers.late_trips, window_end <= (SELECT {PASSED} FROM trips) AS closed
FROM fares JOIN numbers USING (window_start)
"""
)
def stream_corrected_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of a batch, though most windows had closed before their last trips came."""
    found = _corrected(spark, sf_dir).totals(scale=2)
    return found.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


@plan(
    f"""
WITH trips AS ({TRIPS}), {SQL_MARK}
SELECT trip_id, event_timestamp FROM trips, mark
WHERE payment_type = 'error' AND time_bucket(INTERVAL '1 hour', event_timestamp) + INTERVAL '1 hour' <= mark.passed
"""
)
def stream_late_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips that came when their window had closed."""
    late = _corrected(spark, sf_dir).late()
    return late.select("trip_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"))


@plan(SQL_TRIPS)
def stream_unique_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in thirds of their time. With each third purchases come twice, and all of the first third come again."""
    store = UniqueTrips(spark, scratch(spark, "unique"))
    source, checkpoints = scratch(spark, "trips"), scratch(spark, "checkpoints")
    parts = [_with_time(event_trips(part)) for part in in_thirds(table(spark, sf_dir, "events"))]
    for n, part in enumerate(parts):
        again = part.filter("payment_type = 'purchase'")
        whole = part.unionByName(again) if n == 0 else part.unionByName(again).unionByName(parts[0])
        whole.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(whole.schema).parquet(source)
        finish(arriving, name="unique", mode="append", sink=store.sink(), checkpoints=checkpoints)
        if n == 1:
            store.relist()
    found = store.read().select(*UNIQUE)
    return found.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def _with_time(trips: DataFrame) -> DataFrame:
    return trips.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


#: Files of the tenant with a backlog, and of the others; each has one more, delivered twice.
BACKLOG, USUAL, SHARE = 5, 2, 2


def _backlog(spark: SparkSession, sf_dir: str) -> str:
    """Trip files of tenants (here: types of event), of which ``click`` has many; one file of each is there twice."""
    root, aside = scratch(spark, "landing"), scratch(spark, "aside")
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    part = F.when(kind == "click", F.col("event_id") % BACKLOG).otherwise(F.col("event_id") % USUAL)
    rows = trip_file_rows(events, kind.alias("tenant"), part.alias("part")).repartition("tenant", "part")
    rows.write.partitionBy("tenant", "part").options(header=True, escape='"', emptyValue="").csv(aside)
    files, path = hadoop_files(spark, aside)
    copy = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    listed = files.listFiles(path(aside), True)
    twice = set()
    while listed.hasNext():
        place = listed.next().getPath()
        *_, tenant, number, name = str(place).split("/")
        if name.startswith("part-"):
            into = f"{root}/{tenant.partition('=')[2]}/in"
            names = [f"{number.partition('=')[2]}.csv"] + ([] if tenant in twice else ["again.csv"])
            twice.add(tenant)
            for target in names:
                copy(files, place, files, path(f"{into}/{target}"), False, settings)
    return root


@plan(
    f"""
WITH parts AS (SELECT *, event_id % CASE event_type WHEN 'click' THEN {BACKLOG} ELSE {USUAL} END AS part FROM events)
SELECT event_type AS tenant_id, count(*) FILTER (event_type NOT IN ('error', 'signup')) AS trips,
       count(DISTINCT part) + 1 AS files, count(DISTINCT part) AS counted,
       cast(ceil((count(DISTINCT part) + 1) / {SHARE}) AS bigint) AS batches, cast(1 AS bigint) AS first_batch
FROM parts GROUP BY event_type
"""
)
def landing_in_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tenants are in the first batch, and the backlog goes on when the others are done."""

    def make(raw: DataFrame) -> DataFrame:
        return typed_trips(clean(raw)).select("tenant_id", "trip_id")

    landing = Landing(spark, _backlog(spark, sf_dir), scratch(spark, "landed"), make, share=SHARE)
    while landing.take():
        pass
    trips = landing.records().groupBy("tenant_id").agg(F.count("*").alias("n"))
    files = landing.ledger().groupBy("tenant_id").agg(
        F.count("*").alias("files"),
        F.count_if("counts").alias("counted"),
        F.count_distinct("batch").alias("batches"),
        F.min("batch").alias("first_batch"),
    )
    return files.join(trips, "tenant_id", "left").select(
        "tenant_id", F.coalesce("n", F.lit(0)).alias("trips"), "files", "counted", "batches", "first_batch"
    )


@plan(
    f"""
SELECT count(*) AS input_rows, cast({MANY} AS bigint) AS filled_batches, TRUE AS few_files FROM events
"""
)
def progress_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of many micro-batches, merged in between and at the end, into a few files with the same totals."""
    path = scratch(spark, "progress")
    records = many_batches(spark, event_wire(table(spark, sf_dir, "events")))
    totals = fare_totals(parse(records, MONEY, keep=()), size="1 hour", delay="1000 days", exact=True)
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        query = finish(totals, name="merged", mode="update", sink=versioned_sink(scratch(spark, "out"), files=1))
        log.wait([query])
    finally:
        spark.streams.removeListener(log)
    merge_progress(spark, path, at_least=50)
    rows = progress_rows(progress_log(spark, path)).filter(F.col("query_name") == "merged")
    files, make = hadoop_files(spark, path)
    left = len(files.listStatus(make(f"{path}/progress")))
    return rows.agg(
        F.sum("input_rows").alias("input_rows"), F.count_if(F.col("input_rows") > 0).alias("filled_batches")
    ).withColumn("few_files", F.lit(left < 50))
