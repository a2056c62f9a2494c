"""Landing writes, by-name loads and appends."""

import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from roadlens.operators import serving
from roadlens.plans import telemetry_view
from roadlens.schemas import SERVING_TABLES
from roadlens.sources import landing
from roadlens.sources.store import StoredTable


def test_landing_write_one_partition(spark):
    ts = dt.datetime(2024, 3, 15, 10, 30, tzinfo=dt.timezone.utc)
    rows = [(f"e{i}", "gps", "ZX-001", ts) for i in range(5)]
    df = spark.createDataFrame(rows, "event_id string, sensor_type string, vehicle_id string, timestamp timestamp")
    path = tempfile.mkdtemp(prefix="landing-") + "/raw"
    landing.write_landing(df, path)
    rep = landing.landing_report(spark, path).collect()
    assert len(rep) == 1
    r = rep[0]
    assert (r["sensor_type"], r["year"], r["month"], r["day"], r["vehicle_id"], r["rows"]) == (
        "gps", "2024", "03", "15", "ZX-001", 5)
    assert os.path.isdir(f"{path}/sensor_type=gps/year=2024/month=03/day=15/vehicle_id=ZX-001")


def test_append_aligns_by_name_and_counts(spark):
    ts = dt.datetime(2024, 3, 15, 10, 30, tzinfo=dt.timezone.utc)
    # Extra column (processing_lag_ms) and columns in another order.
    df = spark.createDataFrame(
        [(5.0, "ZX-001", "e1", ts, 12.5, 1234)],
        "speed_ms double, vehicle_id string, event_id string, timestamp timestamp, speed_kmh double, processing_lag_ms long",
    )
    path = tempfile.mkdtemp(prefix="table-") + "/gps_events"
    n = landing.append(df, SERVING_TABLES["gps_events"], path)
    assert n == 1
    back = landing.table_rows(spark, SERVING_TABLES["gps_events"], path)
    assert back.columns == [f.name for f in SERVING_TABLES["gps_events"].schema.fields]
    r = back.first()
    assert r["speed_ms"] == 5.0 and r["latitude"] is None and r["event_id"] == "e1"


def test_parameterised_sql(spark):
    spark.createDataFrame([("ZX-001", 1.0), ("ZX-002", 2.0)], "vehicle_id string, v double").createOrReplaceTempView("t_params")
    out = landing.query(spark, "SELECT v FROM t_params WHERE vehicle_id = ?", ["ZX-002"]).collect()
    assert [r["v"] for r in out] == [2.0]
    assert "t_params" in landing.list_tables(spark)


def test_append_keeps_rejects_and_keys(spark):
    ts = dt.datetime(2024, 3, 15, 10, 30, tzinfo=dt.timezone.utc)
    schema = "event_id string, vehicle_id string, timestamp timestamp, speed_ms double"
    df = spark.createDataFrame(
        [("e1", "ZX-001", ts, 1.0), ("e1", "ZX-001", ts, 2.0), ("e2", None, ts, 3.0), ("e3", "ZX-002", ts, 4.0)], schema)
    path = tempfile.mkdtemp(prefix="table-") + "/gps_events"
    table = SERVING_TABLES["gps_events"]
    assert landing.append(df, table, path) == 2
    assert landing.append(df, table, path) == 0
    assert sorted(r["event_id"] for r in landing.table_rows(spark, table, path).collect()) == ["e1", "e3"]
    rejected = landing.rejected_rows(spark, table, path).collect()
    assert [r["event_id"] for r in rejected] == ["e2", "e2"] and rejected[0]["speed_ms"] == 3.0


def test_append_finds_a_stored_key_under_another_timestamp(spark):
    schema = "event_id string, vehicle_id string, timestamp timestamp, speed_ms double"
    path = tempfile.mkdtemp(prefix="table-") + "/gps_events"
    table = SERVING_TABLES["gps_events"]

    def batch(*rows):
        return spark.createDataFrame(
            [(e, "ZX-001", dt.datetime(2024, 3, day, 10, 30, tzinfo=dt.timezone.utc), 1.0) for e, day in rows], schema)

    assert landing.append(batch(("e1", 15), ("e2", 16)), table, path) == 2
    assert landing.append(batch(("e1", 20), ("e3", 21)), table, path) == 1  # e1 re-stamped, outside of its first span
    assert landing.append(batch(("e2", 1)), table, path) == 0
    assert sorted(r["event_id"] for r in landing.table_rows(spark, table, path).collect()) == ["e1", "e2", "e3"]


def readings(spark, ids, day=0):
    return spark.createDataFrame(
        [(f"e{i}", f"v{i % 3}", dt.datetime(2024, 3, 1 + (i + day) % 5, i % 24, tzinfo=dt.timezone.utc), float(i)) for i in ids],
        "event_id string, vehicle_id string, timestamp timestamp, speed_ms double")


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def held(spark, table):
    return sorted(r.event_id for r in table.rows(spark).collect())


def test_a_broken_append_leaves_the_table_and_is_repeated_whole(spark, tmp_path, monkeypatch):
    table = StoredTable(str(tmp_path), ("event_id",))
    assert table.append(readings(spark, range(10)), "one") == 10

    def broken(*a, **k):
        raise OSError("lost between write and commit")

    with monkeypatch.context() as m:
        m.setattr(StoredTable, "_commit", broken)
        with pytest.raises(OSError):
            table.append(readings(spark, range(5, 20)), "two")
    assert len(held(spark, table)) == 10 and table.zones(spark).agg(F.sum("rows")).first()[0] == 10
    assert table.append(readings(spark, range(5, 20)), "two") == 10
    assert table.append(readings(spark, range(5, 20)), "two") == 0  # replayed
    assert table.append(readings(spark, range(30)), "one") == 0
    assert held(spark, table) == sorted(f"e{i}" for i in range(20))


def test_a_second_writer_stores_no_key_twice(spark, tmp_path, monkeypatch):
    table, write = StoredTable(str(tmp_path), ("event_id",)), StoredTable._write
    table.append(readings(spark, range(3)), "zero")

    def slow(self, df, batch):
        write(self, df, batch)
        if batch == "b-slow":  # the other one is done before this one commits
            table.append(readings(spark, range(8, 15), 1), "fast")

    monkeypatch.setattr(StoredTable, "_write", slow)
    assert table.append(readings(spark, range(10)), "slow") == 5
    assert table.append(readings(spark, range(10)), "slow") == 0
    assert held(spark, table) == sorted(f"e{i}" for i in range(15))


def test_a_small_append_reads_few_key_folders(spark, tmp_path, monkeypatch):
    table = StoredTable(str(tmp_path), ("event_id",), buckets=64)
    table.append(readings(spark, range(2000)), "large")
    seen, plans, real = [], [], StoredTable._held

    def watched(self, *a):
        out = real(self, *a)
        seen.extend(r[0] for r in out.select(F.input_file_name()).distinct().collect())
        plans.append(out._jdf.queryExecution().toString())
        return out

    monkeypatch.setattr(StoredTable, "_held", watched)
    assert table.append(readings(spark, [7, 5000]), "small") == 1
    buckets = {f.split("bucket=")[1].split("/")[0] for f in seen}
    assert 1 <= len(buckets) <= 2 and all("/keys/" in f for f in seen)
    assert all("bucket#" in p.split("PartitionFilters: [")[1].split("]")[0] for p in plans)


def test_zone_map_equals_one_built_from_scratch(spark, tmp_path):
    table = StoredTable(str(tmp_path), ("event_id",))
    for k in range(3):
        table.append(readings(spark, range(k * 40, k * 40 + 60)), str(k))

    def scratch():
        return sorted(table.rows(spark).groupBy("year", "month", "day", F.hour("timestamp").alias("hour")).agg(
            F.count(F.lit(1)), F.min("timestamp"), F.max("timestamp")).collect())

    def catalog():
        return sorted(table.zones(spark).select("year", "month", "day", "hour", "rows", "first_timestamp",
                                                "last_timestamp").collect())

    assert catalog() == scratch() and sum(r["rows"] for r in catalog()) == 140
    table.expire(spark, dt.date(2024, 3, 3))
    assert catalog() == scratch() and {r.day for r in catalog()} == {3, 4, 5}
    assert table.append(readings(spark, range(10)), "again") == 0  # keys of expired rows stay taken


def test_compaction_swaps_files_under_a_reader(spark, tmp_path):
    table = StoredTable(str(tmp_path), ("event_id",))
    for k in range(4):
        table.append(readings(spark, range(k * 10, k * 10 + 10)), str(k))
    before = table.rows(spark)  # a reader that started earlier
    files = files_of(before)
    assert table.compact(spark) == 40 and table.compact(spark) == 40
    after = table.rows(spark)
    assert sorted(after.collect()) == sorted(before.collect())
    assert len(files_of(after)) == 5 < len(files)  # one a day
    gone = table.replaced(spark)
    assert all(any(f"{folder}/" in f for folder in gone) for f in files)
    assert not any(f"{folder}/" in f for folder in gone for f in files_of(after))
    assert table.append(readings(spark, range(45)), "late") == 5 and len(held(spark, table)) == 45
    assert table.append(readings(spark, range(45)), "2") == 0  # a replaced batch stays known


def test_look_backs_read_the_zone_map_and_late_days_only(spark, tmp_path):
    rows = readings(spark, range(120)).withColumn("detected_at", F.expr("timestamp + INTERVAL 30 HOURS"))
    table = StoredTable(str(tmp_path), ("event_id",), ("timestamp", "detected_at"))
    table.append(rows, "all")
    timed = table.timed(spark)
    for got, want in (
        (serving.recent(timed, 3600), serving.recent(rows, 3600)),
        (serving.recent(timed, 7200, "detected_at"), serving.recent(rows, 7200, "detected_at")),
        (serving.newest(timed, "detected_at", 3).orderBy(F.desc("detected_at"), "event_id").limit(3),
         rows.orderBy(F.desc("detected_at"), "event_id").limit(3)),
    ):
        plan = got._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        scans = re.split(r"\n\(\d+\) ", plan.split("===== Subqueries")[0])
        scans = [s for s in scans if s.startswith("Scan parquet")]
        assert len(scans) == 1 and "PartitionFilters" in scans[0] and "Subquery" in scans[0]
        # No subquery reads the rows: all they scan is the zone map.
        assert "speed_ms" not in plan.split("===== Subqueries")[1] and "/rows]" not in plan.split("===== Subqueries")[1]
        assert sorted(got.select("event_id").collect()) == sorted(want.select("event_id").collect())
    assert serving.recent(timed, 60, as_of="2030-01-01").count() == 0


def test_message_table_is_written_without_sorting_by_topic(spark, monkeypatch):
    monkeypatch.setattr(telemetry_view, "_RAW_PATHS", {})
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda *a: pytest.fail("a write of several topics sorts its messages"))
    written = spark.read.parquet(telemetry_view.raw_table_path(spark, "/root/testdata/sf0.001"))
    built = telemetry_view.build_raw_messages(spark, "/root/testdata/sf0.001")
    written = written.select(*built.columns)
    assert written.count() == built.count() > 0
    assert written.exceptAll(built).isEmpty()


def test_a_task_reads_a_bounded_split_of_messages(spark, monkeypatch):
    """Row groups of the message files fit the splits that the streams ask for."""
    from roadlens import session
    from roadlens.plans import telemetry_view as V

    monkeypatch.setattr(V, "SPLIT_BYTES", 20_000)
    monkeypatch.setattr(session, "SPLIT_BYTES", 20_000)
    monkeypatch.setattr(V, "_RAW_PATHS", {})
    path = V.raw_table_path(spark, "/root/testdata/sf0.01")
    before = spark.conf.get(session.MAX_PARTITION_BYTES)
    with session.small_splits(spark):
        messages = spark.read.parquet(path)
        split = messages.select(F.length("value")).rdd.glom().map(len).collect()
    assert spark.conf.get(session.MAX_PARTITION_BYTES) == before
    assert sum(split) == spark.read.parquet(path).count()
    assert max(split) < sum(split) / 30


def test_a_key_bucket_is_written_by_several_tasks(spark, tmp_path):
    """A large batch with few buckets: no task gets a whole one."""
    table = StoredTable(str(tmp_path / "t"), key=("id",), time_cols=("ts",), buckets=1)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20k")
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr("uuid() AS id", "timestamp '2024-01-01' AS ts")
        assert table.append(rows, "a") == 60_000
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "t" / "keys" / "batch=b-a" / "bucket=0").glob("*.parquet"))) > 1


def written_rows(spark, path):
    """Rows of all batches on disk, visible or not."""
    return sum(spark.read.parquet(str(f)).count() for f in path.glob("rows/batch=*") if list(f.rglob("*.parquet")))


def test_a_load_writes_no_row_whose_key_is_stored(spark, tmp_path):
    table = SERVING_TABLES["gps_events"]
    assert landing.append(readings(spark, range(40)), table, str(tmp_path), "0") == 40
    assert landing.append(readings(spark, range(20, 60), 1), table, str(tmp_path), "1") == 20
    assert landing.append(readings(spark, range(60)), table, str(tmp_path), "2") == 0
    assert written_rows(spark, tmp_path) == 60
    store = landing.serving_store(table, str(tmp_path))
    assert store.compact(spark) == 60
    assert landing.append(readings(spark, range(60)), table, str(tmp_path)) == 0
    assert landing.append(readings(spark, range(70)), table, str(tmp_path), look_first=False) == 10
    assert held(spark, store) == sorted(f"e{i}" for i in range(70))
    assert store.zones(spark).agg(F.sum("rows")).first()[0] == 70


def test_a_look_before_the_write_finds_what_is_committed_after_it(spark, tmp_path, monkeypatch):
    table, write = StoredTable(str(tmp_path), ("event_id",)), StoredTable._write
    table.append(readings(spark, range(3)), "zero")

    def slow(self, df, batch):
        if batch == "b-slow":  # the other one is done between this one's look and its write
            table.append(readings(spark, range(8, 15), 1), "fast", look_first=True)
        write(self, df, batch)

    monkeypatch.setattr(StoredTable, "_write", slow)
    assert table.append(readings(spark, range(10)), "slow", look_first=True) == 5
    assert held(spark, table) == sorted(f"e{i}" for i in range(15))


def test_a_load_without_free_rows_keeps_its_rejects(spark, tmp_path):
    """All rows stored or broken: the count of the broken ones is not lost with the empty rest."""
    table, excluded = SERVING_TABLES["gps_events"], "spark.sql.adaptive.optimizer.excludedRules"
    path, before = str(tmp_path / "t"), spark.conf.get(excluded, None)
    broken = readings(spark, range(5, 8)).withColumn("vehicle_id", F.lit(None).cast("string"))
    assert landing.append(readings(spark, range(5)), table, path) == 5
    assert landing.append(readings(spark, range(5)).unionByName(broken), table, path) == 0
    assert landing.append(broken, table, path) == 0
    assert sorted(r.event_id for r in landing.rejected_rows(spark, table, path).collect()) == ["e5", "e5", "e6", "e6", "e7", "e7"]
    assert spark.conf.get(excluded, None) == before


def test_served_readings_are_the_processed_ones_in_the_columns_of_their_table(spark):
    from roadlens.plans import tables

    sf = "/root/testdata/sf0.001"
    for sensor in ("gps", "imu", "can_bus"):
        served, table = tables.served(spark, sf, sensor), SERVING_TABLES[f"{sensor}_events"]
        whole = tables.processed(spark, sf, sensor).select(*served.columns)
        assert served.columns == [f.name for f in table.schema.fields]
        assert served.schema == whole.schema and sorted(served.collect(), key=str) == sorted(whole.collect(), key=str)
        assert "sequence_number" not in served._jdf.queryExecution().executedPlan().toString()
