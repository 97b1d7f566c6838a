"""Streams over several batches: late rows, repeats across batches, restart."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from carriageway.session import shared_dir
from carriageway.streaming import evolving, jobs

START = datetime(2024, 1, 1, 12, 0)


def files(spark, batches, schema):
    """One file per batch, older files first."""
    import time

    path = shared_dir(spark, "batches")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)
        time.sleep(1.1 if n + 1 < len(batches) else 0)
    return path


def readings(*minutes):
    return [(n, START + timedelta(minutes=m), "loop", 30.0, 50.0) for n, m in enumerate(minutes)]


SCHEMA = "event_id long, ts timestamp, sensor_group string, speed_mph double, occupancy_pct double"


def test_rows_later_than_the_watermark_are_dropped(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    # Minute 1 arrives two batches after minute 40 was seen: more than ten minutes late. (A batch is
    # filtered by the watermark the batch before it ran with, so one batch later it would still count.)
    path = files(spark, [readings(0, 2, 6), readings(40, 33), readings(42), readings(1, 41), readings(80)], SCHEMA)
    stream = jobs.file_stream(spark, path, schema, "json", files_per_batch=1)
    rows = jobs.drain(jobs.traffic_windows(stream), "late").collect()
    volume = {(r["window_start"] - START).seconds // 60: r["volume"] for r in rows}
    assert volume == {0: 2, 5: 1, 30: 1, 40: 3}
    assert {r["congestion_level"] for r in rows} == {"Moderate"}


def test_repeats_in_later_batches_are_dropped_and_restart_adds_nothing(spark):
    schema = "incident_id string, v int"
    path = files(spark, [[("a", 1), ("b", 1), ("a", 1)], [("b", 2), ("c", 2)]], schema)
    made = spark.createDataFrame([], schema).schema
    base = shared_dir(spark, "restart")

    def run():
        stream = jobs.bronze(jobs.file_stream(spark, path, made, "json", files_per_batch=1))
        jobs.start(jobs.deduplicated(stream, "incident_id"), f"{base}/out", f"{base}/cp").awaitTermination()
        return sorted(r["incident_id"] for r in spark.read.parquet(f"{base}/out").collect())

    assert run() == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]
    spark.createDataFrame([("d", 3), ("a", 3)], schema).write.mode("append").json(path)
    assert run() == ["a", "b", "c", "d"]


def test_a_backlog_is_taken_in_batches_by_bytes(spark, monkeypatch):
    schema = "id int"
    path = files(spark, [[(1,), (2,)], [(3,)], [(4,)]], schema)
    made, sizes = spark.createDataFrame([], schema).schema, []
    for limit, batches in ((jobs.BYTES_PER_BATCH, [4]), (1, [2, 1, 1])):
        monkeypatch.setattr(jobs, "BYTES_PER_BATCH", limit)
        sizes.clear()
        stream = jobs.file_stream(spark, path, made, "json")
        jobs.run_batches(stream, lambda batch, epoch: sizes.append(batch.count()), shared_dir(spark, "backlog"))
        assert [n for n in sizes if n] == batches


def test_warn_rules_keep_rows_and_count(spark):
    schema = "severity string, latitude double"
    path = files(spark, [[("Fatal", 35.0), ("Odd", 95.0)], [(None, 35.0)]], schema)
    stream = jobs.file_stream(spark, path, spark.createDataFrame([], schema).schema, "json", files_per_batch=1)
    out, log = jobs.drain_with_totals(stream, jobs.INCIDENT_SHOULD, lambda b: b, "warn")
    assert out.count() == 3
    assert tuple(log.first()) == (2, 1)


def test_null_rule_result_drops_the_row(spark):
    df = spark.createDataFrame([("a", None), ("b", 10.0), ("c", 500.0)], "incident_id string, longitude double")
    kept = jobs.keep_expected(df, {"lon": "longitude BETWEEN -180 AND 180"})
    assert [r["incident_id"] for r in kept.collect()] == ["b"]


def test_anomaly_limits(spark):
    df = spark.createDataFrame([(1, 10.0, 95.0), (2, 9.9, 0.0), (3, 50.0, 95.1)], "event_id int, speed_mph double, occupancy_pct double")
    assert sorted(r["event_id"] for r in jobs.anomalies(df).collect()) == [2, 3]


def test_bronze_stamps(spark):
    df = jobs.bronze(spark.range(3))
    assert df.where(F.col("_ingest_time").isNull()).count() == 0


INCIDENT = "incident_id string, incident_datetime timestamp, longitude double, latitude double, severity string"


def test_silver_stays_unique_and_counts_rules(spark):
    at = START
    path = files(spark, [
        [("a", at, 1.0, 1.0, "Fatal"), ("a", at, 1.0, 1.0, "Fatal"), (None, at, 1.0, 1.0, "Fatal"), ("b", at, 500.0, 1.0, "Odd")],
        [("a", at + timedelta(days=2), 1.0, 1.0, "Fatal"), ("c", at, 1.0, 99.0, "Odd")],
    ], INCIDENT)
    schema = spark.createDataFrame([], INCIDENT).schema
    base = shared_dir(spark, "silver")

    def run():
        raw = jobs.bronze(jobs.file_stream(spark, path, schema, "json", files_per_batch=1))
        out, log = jobs.drain_silver(raw, "incident_id", jobs.INCIDENT_MUST, jobs.INCIDENT_SHOULD, lambda df: df, "t", base)
        return sorted(r["incident_id"] for r in out.collect()), log.first().asDict()

    counts = {"valid_incident_id": 1, "valid_datetime": 0, "valid_longitude": 1, "valid_severity": 1, "valid_lat": 1}
    assert run() == (["a", "c"], counts)
    # A repeat that arrives in a later run, days later, is still known.
    spark.createDataFrame([("a", at + timedelta(days=9), 1.0, 1.0, "Fatal"), ("d", at, 1.0, 1.0, "Fatal")], INCIDENT).write.mode("append").json(path)
    assert run() == (["a", "c", "d"], counts)


def test_a_source_without_rows_gives_empty_tables(spark):
    path = shared_dir(spark, "none")
    spark.createDataFrame([], INCIDENT).write.json(path)
    stream = jobs.file_stream(spark, path, spark.createDataFrame([], INCIDENT).schema, "json")
    out, log = jobs.drain_with_totals(stream, jobs.INCIDENT_SHOULD, lambda b: b, "none")
    assert out.count() == 0 and tuple(log.first()) == (0, 0)
    assert jobs.drain_silver(stream, "incident_id", jobs.INCIDENT_MUST, {}, lambda df: df, "none")[0].count() == 0


def local(path):
    return Path(path.removeprefix("file:"))


def test_a_batch_opens_only_the_key_folders_of_its_own_keys(spark):
    base = shared_dir(spark, "index")
    df = spark.createDataFrame([(f"k{i}", i) for i in range(500)], "key string, v int")
    jobs.silver_batch(df, 0, base, "key", {"has_key": "key IS NOT NULL"}, {}, lambda d: d)
    folders = sorted(local(base).glob(f"keys/**/{jobs.BUCKET}=*"))
    assert len(folders) == jobs.BUCKETS
    again = spark.createDataFrame([("k7", 1), ("new", 2)], df.schema)
    own = {r[0] for r in again.select(F.pmod(F.xxhash64("key"), F.lit(jobs.BUCKETS)).cast("int")).collect()}
    for folder in folders:
        if int(folder.name.split("=")[1]) not in own:
            for file in folder.rglob("*.parquet"):
                file.write_bytes(b"no parquet file")  # reading it would fail
    rows = jobs.silver_batch(again, 1, base, "key", {"has_key": "key IS NOT NULL"}, {}, lambda d: d)
    assert [r["key"] for r in rows.collect()] == ["new"]
    # The same batch again, as after a failure: its own keys do not count as known.
    assert [r["key"] for r in jobs.silver_batch(again, 1, base, "key", {"has_key": "key IS NOT NULL"}, {}, lambda d: d).collect()] == ["new"]


def test_runs_of_the_key_index_hold_each_batch_once(monkeypatch):
    for fan in (2, 3, 16):
        monkeypatch.setattr(jobs, "FAN", fan)
        for epoch in range(300):
            held = [b for level, run in jobs.live_runs(epoch) for b in range(run * fan**level, (run + 1) * fan**level)]
            assert sorted(held) == list(range(epoch))
            # What is emptied at a batch is neither read by it, nor merged by it, nor needed if it is replayed.
            emptied = {part for run in jobs.runs_filled(epoch - 1) for part in jobs.parts_of(*run)}
            merged = [part for run in jobs.runs_filled(epoch) for part in jobs.parts_of(*run)]
            assert emptied.isdisjoint(jobs.live_runs(epoch)) and emptied.isdisjoint(merged)


def test_key_index_merges_its_runs_and_empties_what_it_merged(spark, monkeypatch):
    monkeypatch.setattr(jobs, "FAN", 3)
    base, rule = shared_dir(spark, "runs"), {"has_key": "key IS NOT NULL"}

    def batch(epoch):
        # Two keys of its own, and one of every earlier batch.
        own = [(f"k{epoch}", epoch), (f"l{epoch}", epoch)] + [(f"k{e}", epoch) for e in range(epoch)] + [(None, 0)]
        rows = jobs.silver_batch(spark.createDataFrame(own, "key string, v int"), epoch, base, "key", rule, {}, lambda d: d)
        return sorted(r["key"] for r in rows.collect())

    def files():
        return {(f.parts[-4], f.parts[-3]) for f in local(base).glob("keys/*/*/*/*.parquet")}

    for epoch in range(11):
        for _ in range(2 if epoch in (3, 4, 9) else 1):  # a replay, of batches that merge or empty runs too
            assert batch(epoch) == [f"k{epoch}", f"l{epoch}"]
    # Nine batches in one run of level 2; of the runs below only the last two batches are left.
    assert files() == {("level=2", "run=0"), ("level=0", "run=9"), ("level=0", "run=10")}
    keys = jobs.KeyIndex(spark, base, "key", spark.createDataFrame([], "key string").schema["key"].dataType)
    assert sorted(r["key"] for r in keys.read(jobs.live_runs(11)).collect()) == sorted(f"{c}{e}" for e in range(11) for c in "kl")


CRASH = "incident_id string, incident_datetime timestamp, longitude double, latitude double, severity string, incident_type string, state_code string, fatalities int, injuries int, vehicles_involved int"


def crash(key, month, fatalities=0, vehicles=2):
    return key, datetime(2024, month, 3), 1.0, 1.0, "Fatal", "crash ", "tn", fatalities, 1, vehicles


def test_gold_is_merged_batch_by_batch(spark):
    path = files(spark, [[crash("a", 1), crash("b", 2, 1)], [crash("c", 2, vehicles=None), crash("a", 2)], [crash("d", 3)]], CRASH)
    schema = spark.createDataFrame([], CRASH).schema
    base = shared_dir(spark, "gold")

    def run():
        return jobs.incident_tables(jobs.bronze(jobs.file_stream(spark, path, schema, "json", files_per_batch=1)), "t", base)

    def stored():
        return {str(f.parent.name) + f.name for f in local(base).glob("gold/mart/**/*.parquet") if "month=1" in str(f) or "month=2" in str(f)}

    def agree(silver, gold):
        assert sorted(map(tuple, gold.collect())) == sorted(map(tuple, jobs.monthly_rollup(silver).collect()))

    silver, gold = run()
    agree(silver, gold)
    assert {(r["incident_month"], r["total_incidents"], r["total_fatalities"], r["avg_vehicles"]) for r in gold.collect()} == {(1, 1, 0, 2.0), (2, 2, 1, 2.0), (3, 1, 0, 2.0)}
    # A batch handed out twice replaces its own sums, and other months keep their files.
    before = stored()
    merge = jobs.rollup_merger(f"{base}/gold")
    merge(spark.read.parquet(f"{base}/out").where(f"{jobs.BATCH} = 2").drop(jobs.BATCH), 2)
    assert stored() == before
    agree(spark.read.parquet(f"{base}/out"), jobs.merged_rollup(spark, f"{base}/gold"))
    spark.createDataFrame([crash("e", 3, 2), crash("b", 3)], CRASH).write.mode("append").json(path)
    silver, gold = run()
    assert stored() == before and silver.count() == 5
    agree(silver, gold)


def test_a_month_that_every_batch_touches_stays_a_few_files(spark, monkeypatch):
    monkeypatch.setattr(jobs, "FAN", 2)
    base = shared_dir(spark, "months")
    merge, schema = jobs.rollup_merger(base), spark.createDataFrame([], CRASH).schema
    batches = [[crash(f"a{n}", 1, n), crash(f"b{n}", 2 + n % 3, vehicles=None)] for n in range(6)]
    for epoch, rows in enumerate(batches):
        for _ in range(1 + epoch % 2):  # every second batch is replayed
            merge(jobs.enriched_incidents(spark.createDataFrame(rows, schema)), epoch)
    every = jobs.enriched_incidents(spark.createDataFrame(sum(batches, []), schema))
    assert sorted(map(tuple, jobs.merged_rollup(spark, base).collect())) == sorted(map(tuple, jobs.monthly_rollup(every).collect()))
    live = {(f.parts[-5], f.parts[-4]) for f in local(base).glob("parts/*/*/*/*/*.parquet") if "incident_month=1" in f.parts}
    assert live == {("level=2", "run=0"), ("level=0", "run=4"), ("level=0", "run=5")}


def test_a_timed_query_goes_on_where_it_was_stopped(spark):
    schema = "id int"
    path = files(spark, [[(1,), (2,)], [(3,)], [(4,)]], schema)
    made = spark.createDataFrame([], schema).schema
    base = shared_dir(spark, "timed")
    seen = []

    def write(batch, epoch):
        seen.append(epoch)
        batch.write.mode("overwrite").parquet(f"{base}/out/{jobs.BATCH}={epoch}")

    def stream():
        return jobs.file_stream(spark, path, made, "json", files_per_batch=1)

    query = jobs.start_batches(stream(), write, f"{base}/checkpoint", {"processingTime": "2 seconds"})
    jobs.stop_after(query, 1)
    assert not query.isActive and 0 in seen and len(set(seen)) < 3
    spark.createDataFrame([(5,)], schema).write.mode("append").json(path)
    again = jobs.start_batches(stream(), write, f"{base}/checkpoint", {"processingTime": "100 milliseconds"})
    again.processAllAvailable()
    again.stop()
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/out").collect()) == [1, 2, 3, 4, 5]


def test_changed_and_broken_records_are_all_kept(spark):
    path = shared_dir(spark, "lines")

    def add(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)

    known = spark.createDataFrame([], "id int, speed double").schema
    add('{"id": 1, "speed": 3.5}', '{"id": 2, "speed": 4.5, "lane": "left", "extra": {"a": 1}}', '{"id": 3, "speed": "fast"}', '{"id": 4, "spe', "[1, 2]", "", '{"id": null}')
    out, bad, base = evolving.ingest(evolving.text_lines(spark, path), known)
    rows = sorted(((r["id"], r["speed"], r[evolving.RESCUED]) for r in out.collect()), key=str)
    assert rows == [(1, 3.5, None), (2, 4.5, '{"lane":"left","extra":"{\\"a\\":1}"}'), (3, None, '{"speed":"fast"}'), (None, None, None)]
    assert sorted(r["value"] for r in bad.collect()) == ["[1, 2]", '{"id": 4, "spe'] and all("lines" in r[evolving.ORIGIN] for r in bad.collect())
    wide = evolving.widened(known, out)
    assert wide.fieldNames() == ["id", "speed", "extra", "lane"]
    add('{"id": 5, "speed": 1.0, "lane": "right"}')
    out, bad, _ = evolving.ingest(evolving.text_lines(spark, path), wide, base)
    assert {(r["id"], r["lane"]) for r in out.collect()} == {(1, None), (2, None), (3, None), (None, None), (5, "right")} and bad.count() == 2
