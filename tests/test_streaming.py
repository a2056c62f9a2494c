"""The streaming topology (R8/R9), progress table (R11) and sinks."""

import os
import random

import pytest
from pyspark.sql import functions as F

from roadlens.operators.features import align_imu
from roadlens.plans.telemetry_view import raw_table_path
from roadlens.schemas import TOPICS
from roadlens.session import scratch_path
from roadlens.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_topology_runs_and_reports(spark):
    raw = J.file_source(spark, [raw_table_path(spark, SF)], list(TOPICS.values()))
    out, ckpt = scratch_path(spark, "topo-out"), scratch_path(spark, "topo-ckpt")
    topo = J.start_topology(spark, raw, out, ckpt, trigger={"availableNow": True})
    assert len(topo.queries) == 3 + 4
    for q in topo.queries:
        q.awaitTermination()
    names = sorted(os.listdir(out))
    assert {"gps", "imu", "can_bus"} <= set(names)
    gps = spark.read.parquet(f"{out}/gps")
    assert gps.count() > 0 and {"year", "month", "day", "vehicle_id", "sensor_type"} <= set(gps.columns)
    prog = J.progress_table(spark, topo.queries).collect()
    assert prog and all(r["input_rows"] >= 0 for r in prog)
    topo.stop()


def test_single_watermark_upstream(spark):
    raw = J.file_source(spark, [raw_table_path(spark, SF)], list(TOPICS.values()))
    s = J.sensor_stream(raw, "can_bus")
    plan = s._jdf.queryExecution().analyzed().toString()
    assert plan.count("EventTimeWatermark") == 1


def test_anomaly_branch_streams(spark):
    from roadlens.ml.iforest import IsolationForest
    from roadlens.plans import tables

    from roadlens.plans.q_ml import anomaly_input

    model = IsolationForest(n_trees=20).fit(anomaly_input(spark, SF))
    raw = J.file_source(spark, [raw_table_path(spark, SF)], list(TOPICS.values()))
    out, ckpt = scratch_path(spark, "topo-ml-out"), scratch_path(spark, "topo-ml-ckpt")
    topo = J.start_topology(spark, raw, out, ckpt, trigger={"availableNow": True}, scorer=model.scorer())
    for q in topo.queries:
        q.awaitTermination()
    anomalies = spark.read.parquet(f"{out}/anomalies")
    n = anomalies.count()
    total = tables.can_bus_events(spark, SF).count()
    assert 0 < n < total * 0.2
    assert anomalies.filter(~anomalies.is_anomaly).count() == 0
    topo.stop()


def test_late_rows_dropped_and_reported(spark, tmp_path):
    import datetime as dt

    from roadlens.operators.windows import window_summary

    t0 = dt.datetime(2024, 1, 1, 0, 10, tzinfo=dt.timezone.utc)
    schema = "vehicle_id string, timestamp timestamp, speed_ms double"
    src = str(tmp_path / "gps")
    # Batch 1 moves the watermark to 00:09 (1 minute delay); batch 2 then
    # brings rows from 00:00, ten minutes behind it.
    spark.createDataFrame([("ZX-001", t0 + dt.timedelta(seconds=i), 1.0) for i in range(10)], schema) \
        .coalesce(1).write.parquet(src + "/a")
    os.utime(src, None)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    agg = window_summary("w1", stream.withWatermark("timestamp", "1 minute"))
    q = (agg.writeStream.format("memory").queryName("late_test").outputMode("append")
         .trigger(processingTime="0 seconds").start())
    q.processAllAvailable()
    spark.createDataFrame([("ZX-001", t0 - dt.timedelta(minutes=10), 99.0)] * 5, schema) \
        .coalesce(1).write.parquet(src + "/b")
    q.processAllAvailable()
    progress = J.progress_table(spark, [q]).collect()
    dropped = sum(r["dropped_by_watermark"] for r in progress)
    q.stop()
    # Counted at the state store, i.e. after the map-side partial aggregate:
    # the five late rows of one window arrive there as one row.
    assert dropped >= 1
    assert spark.table("late_test").filter("max_speed_ms = 99.0").count() == 0


def test_console_sink_update_mode(spark):
    from roadlens.operators.windows import window_summary

    raw = J.file_source(spark, [raw_table_path(spark, SF)], list(TOPICS.values()))
    agg = window_summary("w1", J.sensor_stream(raw, "gps"))
    q = J.console_sink(agg, trigger={"availableNow": True})
    q.awaitTermination()
    # The last progress may be an empty batch; count over all batches.
    assert sum(p["sources"][0]["numInputRows"] for p in q.recentProgress) > 0


def test_landing_replays_and_broken_batches_store_once(spark):
    """A batch that breaks between two sinks and is run again, and one that is
    repeated whole, leave every sink as if each had run once."""
    from roadlens.plans.q_stream import _scorer
    from roadlens.streaming import topology as T

    messages = spark.read.parquet(raw_table_path(spark, SF)).filter("offset % 5 = 0")
    once, twice = (T.Landing(scratch_path(spark, "land"), scorer=_scorer) for _ in range(2))
    new = once.process(messages, 0)
    assert set(new) == set(T.SINKS) and new["gps"] > 0 and new["counters"] > 0

    def broken(can):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        T.Landing(twice.root, scorer=broken).process(messages, 0)
    half = T.processed(T.parse_messages(messages.filter(T.F.col("topic") == T.TOPICS["gps"]), T.SENSOR_SCHEMAS["gps"]), "gps")
    twice.sink("gps").append(half, f"{twice.name}-0")  # one sink had committed
    assert twice.process(messages, 0)["gps"] == 0
    assert set(twice.process(messages, 0).values()) == {0}
    assert twice.process(messages, 1)["gps"] == 0  # the same events in a later batch
    for sink in T.SINKS:
        if sink != "counters":
            assert once.rows(spark, sink).count() == twice.rows(spark, sink).count() == new[sink], sink
    assert twice.rows(spark, "counters").count() == 2 * new["counters"]


def test_stream_alignment_forms_no_pairs_and_equals_the_batch(spark, tmp_path):
    """Readings on the second, of equal times, a tolerance apart and too far
    apart, in several micro-batches."""
    rng = random.Random(8)
    times = lambda n: [rng.choice([rng.randrange(60) * 250_000, rng.randrange(15_000_000)]) for _ in range(n)]
    schema = "event_id string, vehicle_id string, us long, accel_magnitude double, sequence_number long"
    imu = spark.createDataFrame([(f"i{i}", f"v{i % 7}", t, float(i), i) for i, t in enumerate(times(150))], schema)
    can = spark.createDataFrame([(f"c{i}", f"v{i % 8}", t, None, i) for i, t in enumerate(times(300))], schema)
    end = spark.createDataFrame([(f"end{i}", "end", t, 0.0, -i) for i, t in enumerate((10**10, 2 * 10**10))], schema)
    streams = {}
    for name, df in (("can", can), ("imu", imu)):
        df = df.withColumn("timestamp", F.timestamp_micros("us"))
        path = str(tmp_path / name)
        for i in range(3):
            df.filter(F.pmod("sequence_number", F.lit(3)) == i).coalesce(1).write.mode("append").parquet(path)
        for i in range(2):
            end.withColumn("timestamp", F.timestamp_micros("us")).filter(F.col("event_id") == f"end{i}").coalesce(1).write.mode(
                "append").parquet(path)
        streams[name] = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
                         .withWatermark("timestamp", "1 minute"))
    out = J.align_imu_stream(streams["can"].select("event_id", "vehicle_id", "timestamp"), streams["imu"])
    assert "Join" not in out._jdf.queryExecution().analyzed().toString()
    q = (out.writeStream.format("memory").queryName("aligned_test").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    cols = ["event_id", "vehicle_id", "timestamp", "accel_magnitude", "imu_timestamp"]
    got = spark.table("aligned_test").filter("vehicle_id <> 'end'").select(*cols).collect()
    as_batch = [df.withColumn("timestamp", F.timestamp_micros("us")) for df in (can, imu)]
    want = align_imu(*as_batch).select(*cols).collect()
    key = lambda r: r.event_id
    assert sorted(got, key=key) == sorted(want, key=key)
    assert 0 < sum(r.imu_timestamp is None for r in got) < len(got)


def test_a_sensor_stream_decodes_and_shuffles_its_columns_only(spark):
    raw = J.file_source(spark, [raw_table_path(spark, "/root/testdata/sf0.001")], list(TOPICS.values()))
    lag = J.sensor_stream(raw, "gps", "2 minutes", ("timestamp", "vehicle_id", "processing_lag_ms"))
    assert lag.columns == ["timestamp", "vehicle_id", "processing_lag_ms"]
    assert "ingested_at" in lag._jdf.queryExecution().analyzed().toString()
    plan = J.sensor_stream(raw, "gps", "2 minutes", ("timestamp", "vehicle_id"))._jdf.queryExecution().analyzed().toString()
    assert "latitude" in plan and "heading_deg" not in plan and "ingested_at" not in plan
    assert "latitude" not in plan.split("DeduplicateWithinWatermark")[0]  # a bound's column is not kept
