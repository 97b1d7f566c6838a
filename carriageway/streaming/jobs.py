"""Streams from bronze to silver to gold.

Every function maps a streaming DataFrame to a streaming DataFrame and works on
a batch one as well; ``drain`` and ``start`` run them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from carriageway.functions.rules import banded, tally
from carriageway.functions.times import AS_OF, age_in, days_since, instant, is_weekend
from carriageway.operators.keys import one_row_per_key
from carriageway.operators.measures import rollup_by
from carriageway.operators.quality import SEVERITY_LIST, keep_expected, violations
from carriageway.plans.silver import INSPECTION_CYCLE_DAYS, bridge_risk
from carriageway.session import shared_dir
from carriageway.sources.sinks import quoted

# Expectations, late tolerance, window, congestion bands (ours:
# the published text names the label but no cuts), anomaly limits.
INCIDENT_MUST = {
    "valid_incident_id": "incident_id IS NOT NULL",
    "valid_datetime": "incident_datetime IS NOT NULL",
    "valid_longitude": "longitude BETWEEN -180 AND 180",
}
INCIDENT_SHOULD = {
    "valid_severity": f"severity IN ({SEVERITY_LIST})",
    "valid_lat": "latitude BETWEEN -90 AND 90",
}
BRIDGE_MUST = {"valid_bridge_id": "bridge_id IS NOT NULL"}
BRIDGE_SHOULD = {
    "plausible_year_built": "year_built BETWEEN 1800 AND 2025",
    "valid_sufficiency": "sufficiency_rating BETWEEN 0 AND 100",
}
LATE = "10 minutes"
ARRIVAL, REPEATS_WITHIN = "_ingest_time", "1 day"
BATCH, BUCKET = "_batch", "_bucket"
#: Folders of the key index of a silver table. A batch reads those of its own keys only.
BUCKETS = 64
#: Runs of the key index that are merged into one run of the next level.
FAN = 16
#: What a micro-batch takes of a backlog at most, unless a number of files is given.
BYTES_PER_BATCH = 256 << 30
WINDOW = "5 minutes"
CONGESTION_BANDS = [(15, "Severe"), (30, "Heavy"), (45, "Moderate")]
FREE_FLOW = "Free Flow"
SLOW_SPEED, FULL_OCCUPANCY = 10, 95


def limited(reader: DataStreamReader, files_per_batch: int | None) -> DataStreamReader:
    if files_per_batch:
        return reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("maxBytesPerTrigger", BYTES_PER_BATCH)


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None,
    with_origin: bool = False,
) -> DataFrame:
    """Files of a folder as an incremental stream, optionally with their path.

    A backlog is taken in batches of so many files or of ``BYTES_PER_BATCH``, so
    that a first run over old files can be stopped and go on.
    """
    df = limited(spark.readStream.format(fmt).schema(schema), files_per_batch).load(path)
    return df.select("*", F.col("_metadata.file_path").alias("_source_file")) if with_origin else df


def bronze(df: DataFrame) -> DataFrame:
    """Arrival time beside the record."""
    return df.withColumn("_ingest_time", F.current_timestamp())


def deduplicated(df: DataFrame, key: str, when: str | None = ARRIVAL, late: str = REPEATS_WITHIN) -> DataFrame:
    """First record per key among those arriving within ``late`` of each other.

    The state of a key is dropped after that time. The arrival stamp makes a
    safe clock: no record is late by it. ``when=None`` keeps every key for
    ever, as the published pipeline does.
    """
    if when is None:
        return df.dropDuplicates([key])
    return df.withWatermark(when, late).dropDuplicatesWithinWatermark([key])


def enriched_incidents(df: DataFrame) -> DataFrame:
    """Row-wise part of the streaming silver incidents."""
    return df.withColumns({
        "incident_type": F.upper(F.trim("incident_type")),
        "state_code": F.upper("state_code"),
        "incident_year": F.year("incident_datetime"),
        "incident_month": F.month("incident_datetime"),
        "incident_hour": F.hour("incident_datetime"),
        "is_weekend": is_weekend("incident_datetime"),
        "has_fatality": F.col("fatalities") > 0,
        "total_casualties": F.col("fatalities") + F.col("injuries"),
    })


def silver_incidents(df: DataFrame, when: str | None = ARRIVAL, late: str = REPEATS_WITHIN) -> DataFrame:
    """P18 as one streaming frame; repeats are known for ``late``. ``drain_silver`` knows them for ever."""
    return deduplicated(enriched_incidents(keep_expected(df, INCIDENT_MUST)), "incident_id", when, late)


def enriched_bridges(df: DataFrame) -> DataFrame:
    """Row-wise part of the streaming silver bridges; this risk score has no deficiency term."""
    return df.withColumns({
        "bridge_age_years": age_in("year_built"),
        "days_since_inspection": days_since("last_inspection_date", AS_OF),
        "risk_score": bridge_risk(None),
    }).withColumn("inspection_overdue", F.col("days_since_inspection") > INSPECTION_CYCLE_DAYS)


def silver_bridges(df: DataFrame, when: str | None = ARRIVAL, late: str = REPEATS_WITHIN) -> DataFrame:
    """P19 as one streaming frame."""
    return deduplicated(enriched_bridges(keep_expected(df, BRIDGE_MUST)), "bridge_id", when, late)


def monthly_rollup(silver: DataFrame) -> DataFrame:
    """P20."""
    return rollup_by(silver, ["state_code", "incident_year", "incident_month", "incident_type"], {
        "total_incidents": F.count("incident_id"),
        "total_fatalities": F.sum("fatalities"),
        "total_injuries": F.sum("injuries"),
        "fatal_count": tally(F.col("has_fatality")),
        "avg_vehicles": F.avg("vehicles_involved"),
    })


def sensor_readings(events: DataFrame) -> DataFrame:
    """Traffic readings from generic events: value as speed, payload as occupancy."""
    return events.select(
        "event_id", instant("ts").alias("ts"), F.col("event_type").alias("sensor_group"),
        F.col("value").alias("speed_mph"),
        F.get_json_object("props", "$.k").cast("double").alias("occupancy_pct"),
    )


def traffic_windows(readings: DataFrame, late: str = LATE, window: str = WINDOW) -> DataFrame:
    """Average speed and volume per tumbling window; rows later than ``late`` are dropped."""
    slots = readings.withWatermark("ts", late).groupBy(F.window("ts", window), "sensor_group")
    out = slots.agg(F.avg("speed_mph").alias("avg_speed"), F.count(F.lit(1)).alias("volume"))
    return out.select(
        F.col("window.start").alias("window_start"), "sensor_group", "avg_speed", "volume",
        congestion_level("avg_speed").alias("congestion_level"),
    )


def congestion_level(speed: Column | str) -> Column:
    return banded(speed, "<", CONGESTION_BANDS, FREE_FLOW)


def anomalies(readings: DataFrame) -> DataFrame:
    """Readings that are too slow or too full."""
    return readings.where((F.col("speed_mph") < SLOW_SPEED) | (F.col("occupancy_pct") > FULL_OCCUPANCY))


def start(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: Mapping[str, object] | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start a file sink. ``trigger`` is ``availableNow=True`` or ``processingTime='30 seconds'``."""
    return (
        df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start(path)
    )


def start_table(
    df: DataFrame, table: str, checkpoint: str, comment: str = "", quality: str = "",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start a catalog-table sink, then describe the table."""
    spark = df.sparkSession
    query = (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).toTable(table)
    )
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
    if quality:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('quality' = {quoted(quality)})")
    return query


def drain(df: DataFrame, purpose: str, mode: str = "append") -> DataFrame:
    """Run a stream over all files there are now, and read what it wrote.

    Sink and checkpoint lie in the shared folder: a restarted run goes on where
    the lost one stopped.
    """
    spark = df.sparkSession
    base = shared_dir(spark, f"stream-{purpose}")
    query = start(df, f"{base}/out", f"{base}/checkpoint", mode)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def drain_with_totals(
    df: DataFrame, rules: Mapping[str, str], fold: Callable[[DataFrame], DataFrame], purpose: str,
    beside: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, ...]:
    """Run a stream and log, per micro-batch, how many rows broke each rule.

    Returns what the stream wrote, the totals of the log and, if asked for,
    what ``beside`` makes of the same batches: one read of the source for all.
    A batch replayed after a failure overwrites its own folders, so totals stay
    exact. A source without rows gives empty tables.
    """
    spark = df.sparkSession
    base = shared_dir(spark, f"stream-{purpose}")
    made = {"out": fold, "log": lambda batch: batch.agg(*violations(rules))} | ({"beside": beside} if beside else {})

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, make in made.items():
                make(batch).write.mode("overwrite").parquet(f"{base}/{name}/{BATCH}={epoch}")
        finally:
            batch.unpersist()

    write(spark.createDataFrame([], df.schema), -1)
    run_batches(df, write, f"{base}/checkpoint")
    log = spark.read.parquet(f"{base}/log").agg(*[F.sum(r).alias(r) for r in rules])
    rest = [spark.read.parquet(f"{base}/{name}").drop(BATCH) for name in made if name != "log"]
    return rest[0], log, *rest[1:]


def run_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch there is now to ``write``."""
    start_batches(df, write, checkpoint, {"availableNow": True}).awaitTermination()


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping[str, object],
) -> StreamingQuery:
    """Start handing micro-batches to ``write``, as often as the trigger says, until the query is stopped.

    A batch that a stop or a failure cut short is handed out again under its
    number when a query starts on the same checkpoint, so ``write`` overwrites
    what it wrote for that number.
    """
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stop_after(query: StreamingQuery, batches: int, timeout: float = 300.0) -> None:
    """Stop a running query once it has finished so many batches."""
    until = time.monotonic() + timeout
    while query.isActive and time.monotonic() < until and sum(p.batchId >= 0 and p.numInputRows > 0 for p in query.recentProgress) < batches:
        time.sleep(0.05)
    query.stop()
    if query.exception() is not None:
        raise query.exception()


def written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path; an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def live_runs(epoch: int) -> list[tuple[int, int]]:
    """(level, run) of the key index that together hold each batch before ``epoch`` once.

    A run of level 0 is a batch; ``FAN`` full runs make one of the next level, so
    there are fewer than ``FAN`` live ones per level and the levels grow with the
    logarithm of the batches.
    """
    live, level = [], 0
    while epoch // FAN**level > 0:
        upto = epoch // FAN**level
        live += [(level, run) for run in range(upto - upto % FAN, upto)]
        level += 1
    return live


def runs_filled(epoch: int) -> list[tuple[int, int]]:
    """Runs above level 0 that the batch before ``epoch`` completes, lowest level first."""
    filled, level = [], 1
    while epoch > 0 and epoch % FAN**level == 0:
        filled.append((level, epoch // FAN**level - 1))
        level += 1
    return filled


def parts_of(level: int, run: int) -> list[tuple[int, int]]:
    return [(level - 1, FAN * run + k) for k in range(FAN)]


class Runs:
    """A table that grows by a run per batch, in folders within a run.

    Which runs are live follows from the batch number alone, so a batch that is
    replayed finds what it found before. The runs that a merge has read are
    emptied one batch later, when the batch that merged them can no longer be
    replayed. Each row is written once per level.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, folders: list[str]) -> None:
        self.spark, self.root, self.schema, self.folders = spark, root, schema, folders

    def path(self, level: int, run: int) -> str:
        return f"{self.root}/level={level}/run={run}"

    def read(self, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*[self.path(*run) for run in runs])
        return found.select(self.schema.names)

    def write(self, rows: DataFrame, level: int, run: int) -> None:
        """Replace a run. A folder of many rows is written by several tasks."""
        rows.hint("rebalance", *self.folders).write.mode("overwrite").partitionBy(*self.folders).parquet(self.path(level, run))

    def settle(self, epoch: int, fold: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Merge the runs that are full before this batch, and empty those that the last merge has read."""
        for run in runs_filled(epoch):
            self.write(fold(self.read(parts_of(*run))), *run)
        for run in runs_filled(epoch - 1):
            for part in parts_of(*run):
                self.write(self.spark.createDataFrame([], self.schema), *part)


class KeyIndex(Runs):
    """Keys of a silver table, in folders by hash."""

    def __init__(self, spark: SparkSession, base: str, key: str, kind: T.DataType) -> None:
        schema = T.StructType([T.StructField(key, kind), T.StructField(BUCKET, T.IntegerType())])
        super().__init__(spark, f"{base}/keys", schema, [BUCKET])

    def known(self, buckets: list[int], epoch: int) -> DataFrame:
        """Keys that earlier batches wrote, from the given folders."""
        return self.read(live_runs(epoch)).where(F.col(BUCKET).isin(buckets))


def silver_batch(
    batch: DataFrame, epoch: int, base: str, key: str, must: Mapping[str, str], should: Mapping[str, str],
    enrich: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Write one batch's log, new rows and new keys under ``base``; returns the rows as written."""
    spark = batch.sparkSession
    batch.persist()
    try:
        met = " AND ".join(f"coalesce({rule}, false)" for rule in must.values())
        warned = {name: f"NOT ({met}) OR ({rule})" for name, rule in should.items()}
        bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
        found = batch.agg(*violations({**must, **warned}), F.collect_set(F.when(F.expr(met), bucket)).alias(BUCKET)).persist()
        found.drop(BUCKET).write.mode("overwrite").parquet(f"{base}/log/{BATCH}={epoch}")
        buckets = found.first()[BUCKET]
        found.unpersist()
        fresh = one_row_per_key(enrich(keep_expected(batch, must)), [key])
        index = KeyIndex(spark, base, key, batch.schema[key].dataType)
        index.settle(epoch)
        known = index.known(buckets, epoch).select(F.col(key).alias("_known"))
        fresh = fresh.join(known, F.col(key) == F.col("_known"), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{base}/out/{BATCH}={epoch}")
    finally:
        batch.unpersist()
    rows = spark.read.schema(fresh.schema).parquet(f"{base}/out/{BATCH}={epoch}")
    index.write(rows.select(key, bucket.alias(BUCKET)), 0, epoch)
    return rows


def drain_silver(
    raw: DataFrame, key: str, must: Mapping[str, str], should: Mapping[str, str],
    enrich: Callable[[DataFrame], DataFrame], purpose: str, base: str | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run bronze rows into a silver table that stays unique by key for ever, with counts per rule.

    Returns the table and the totals: per ``must`` rule the rows it dropped, per
    ``should`` rule the kept rows that break it. Each batch keeps one row per
    key and leaves out keys that other batches have written. Those are found in
    an index of keys alone (``KeyIndex``), in folders by hash: a batch opens only
    the folders of its own keys, and no state grows in the stream. A replayed batch
    overwrites itself. ``base`` is given to go on with an earlier run;
    ``after`` gets the rows each batch has written, such as ``rollup_merger``.
    """
    spark = raw.sparkSession
    base = base or shared_dir(spark, f"silver-{purpose}")
    rules = {**must, **should}

    def write(batch: DataFrame, epoch: int) -> None:
        rows = silver_batch(batch, epoch, base, key, must, should, enrich)
        if after is not None:
            after(rows, epoch)

    run_batches(raw, write, f"{base}/checkpoint")
    counts = T.StructType([T.StructField(r, T.LongType()) for r in rules])
    log = written(spark, f"{base}/log", counts).agg(*[F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in rules])
    empty = one_row_per_key(enrich(keep_expected(spark.createDataFrame([], raw.schema), must)), [key])
    return written(spark, f"{base}/out", empty.schema).drop(BATCH), log


#: Keys of the monthly rollup and the folders it is stored in.
ROLLUP_KEYS = ["state_code", "incident_year", "incident_month", "incident_type"]
ROLLUP_FOLDERS = ["incident_year", "incident_month"]
#: Sums of which every measure of the rollup is made.
ROLLUP_SUMS = ["total_incidents", "total_fatalities", "total_injuries", "fatal_count", "vehicles", "vehicle_rows"]
ROLLUP_TYPES = T.StructType([
    T.StructField("state_code", T.StringType()), T.StructField("incident_type", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ROLLUP_SUMS],
    *[T.StructField(c, T.IntegerType()) for c in ROLLUP_FOLDERS],
])


def rollup_parts(silver: DataFrame) -> DataFrame:
    """What some rows add to the monthly rollup."""
    return rollup_by(silver, ROLLUP_KEYS, {
        "total_incidents": F.count("incident_id"), "total_fatalities": F.sum("fatalities"), "total_injuries": F.sum("injuries"),
        "fatal_count": tally(F.col("has_fatality")), "vehicles": F.sum("vehicles_involved"), "vehicle_rows": F.count("vehicles_involved"),
    }).select([F.col(f.name).cast(f.dataType) for f in ROLLUP_TYPES.fields])


def summed(parts: DataFrame) -> DataFrame:
    """Partial sums of the rollup, added up."""
    return parts.groupBy(*ROLLUP_KEYS).agg(*[F.sum(c).alias(c) for c in ROLLUP_SUMS]).select(ROLLUP_TYPES.names)


def rollup_merger(base: str) -> Callable[[DataFrame, int], None]:
    """P20, kept up to date batch by batch; for ``drain_silver``'s ``after``.

    A batch stores its partial sums under its number and merges those of the
    months it touches, so other months are neither read nor written, raw rows
    are read once, and a batch that is replayed replaces its own sums. Partial
    sums lie in ``Runs``: those of many batches are added up to one row per key,
    so a month that every batch touches stays a few files.
    """

    def merge(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        parts = Runs(spark, f"{base}/parts", ROLLUP_TYPES, ROLLUP_FOLDERS)
        parts.settle(epoch, summed)
        parts.write(rollup_parts(rows), 0, epoch)
        own = parts.read([(0, epoch)])
        months = [(r[0], r[1]) for r in own.select(*ROLLUP_FOLDERS).distinct().collect()]  # a row per month of the batch
        if not months:
            return
        touched = F.lit(False)
        for year, month in months:
            touched = touched | (F.col("incident_year").eqNullSafe(F.lit(year)) & F.col("incident_month").eqNullSafe(F.lit(month)))
        merged = summed(parts.read([*live_runs(epoch), (0, epoch)]).where(touched))
        overwrite_folders(merged.repartition(*ROLLUP_FOLDERS), f"{base}/mart", ROLLUP_FOLDERS)

    return merge


def overwrite_folders(df: DataFrame, path: str, folders: list[str]) -> None:
    """Replace the folders that the rows fall into; others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def merged_rollup(spark: SparkSession, base: str) -> DataFrame:
    """P20 from the merged sums."""
    return written(spark, f"{base}/mart", ROLLUP_TYPES).select(
        *ROLLUP_KEYS, *ROLLUP_SUMS[:4], (F.col("vehicles") / F.when(F.col("vehicle_rows") != 0, F.col("vehicle_rows"))).alias("avg_vehicles"))


def incident_tables(raw: DataFrame, purpose: str, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver incidents and their monthly rollup from one stream of bronze rows."""
    base = base or shared_dir(raw.sparkSession, f"incidents-{purpose}")
    silver, _log = drain_silver(raw, "incident_id", INCIDENT_MUST, INCIDENT_SHOULD, enriched_incidents, purpose, base, rollup_merger(f"{base}/gold"))
    return silver, merged_rollup(raw.sparkSession, f"{base}/gold")


def table_chain(events: DataFrame, steps: Mapping[str, Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """Run dependent streaming tables in order, each with its own checkpoint.

    The first step reads ``events``; each later step streams from the files the
    step before it wrote.
    """
    spark = events.sparkSession
    base = shared_dir(spark, "chain")
    source, out = events, {}
    for name, step in steps.items():
        staged = step(source)
        start(staged, f"{base}/{name}", f"{base}/checkpoint-{name}").awaitTermination()
        out[name] = spark.read.schema(staged.schema).parquet(f"{base}/{name}")
        source = file_stream(spark, f"{base}/{name}", staged.schema)
    return out
