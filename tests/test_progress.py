"""The progress store; the mergeable distinct counts of W5."""

import pytest
from pyspark.sql import functions as F

from roadlens.operators import windows as W
from roadlens.streaming.progress import SCHEMA, ProgressLog, lag, offsets, progress_rows, totals

REPORT = {
    "id": "q1", "runId": "r1", "name": "readings", "batchId": 7, "timestamp": "2024-01-01T00:00:00.000Z",
    "stateOperators": [{"numRowsTotal": 5, "numRowsDroppedByWatermark": 2}, {"numRowsTotal": 1}],
    "sources": [
        {"description": "kafka", "startOffset": {"gps": {"0": 10, "1": 4}}, "endOffset": {"gps": {"0": 15, "1": 9}},
         "latestOffset": {"gps": {"0": 15, "1": 30}}, "numInputRows": 10},
        {"description": "files", "startOffset": None, "endOffset": '{"logOffset":3}', "latestOffset": None, "numInputRows": 4},
    ],
}


def frame(spark, rows):
    text = SCHEMA.replace("at timestamp", "at string")
    return spark.createDataFrame(rows, text).withColumn("at", F.to_timestamp("at"))


def test_offsets_of_sources():
    assert offsets(None) == {}
    assert offsets(5) == {(None, "offset"): 5}
    assert offsets('{"logOffset":3}') == {(None, "logOffset"): 3}
    assert offsets({"t": {"0": 1, "1": 2}}) == {("t", "0"): 1, ("t", "1"): 2}


def test_rows_and_lag_per_partition(spark):
    rows = progress_rows(REPORT)
    assert [r[7:12] for r in rows] == [("gps", "0", 10, 15, 15), ("gps", "1", 4, 9, 30), (None, "logOffset", None, 3, None)]
    df = frame(spark, rows)
    t = totals(df).first()
    assert (t["batches"], t["input_rows"], t["dropped_by_watermark"], t["most_state_rows"]) == (1, 14, 2, 6)
    got = {(r["source"], r["partition"]): (r["end_offset"], r["lag"]) for r in lag(df).collect()}
    assert got == {("kafka", "0"): (15, 0), ("kafka", "1"): (9, 21), ("files", "logOffset"): (3, None)}


def test_store_counts_a_repeated_batch_once(spark, tmp_path):
    path = str(tmp_path / "progress")
    again = {**REPORT, "runId": "r2", "timestamp": "2024-01-01T00:05:00.000Z"}
    for report in (REPORT, again):
        frame(spark, progress_rows(report)).write.mode("append").parquet(path)
    t = totals(ProgressLog(spark, path).rows()).first()
    assert (t["batches"], t["input_rows"]) == (1, 14)


@pytest.mark.parametrize("vehicles", [50, 20000])
def test_sketches_merge_within_the_bound(spark, vehicles):
    readings = spark.range(60000).select(
        F.timestamp_seconds(F.col("id") % 7200).alias("timestamp"), F.lit("gps").alias("sensor_type"),
        F.concat(F.lit("v"), (F.col("id") * 7919 % vehicles).cast("string")).alias("vehicle_id"))
    hours = W.merge_sketches(W.throughput_sketches(readings), "1 hour", "sensor_type")
    days = W.merge_sketches(hours.select("window_start", "event_count", "vehicles"), "1 day")
    exact = readings.agg(F.count_distinct("vehicle_id")).first()[0]
    day = days.first()
    assert day["event_count"] == 60000
    assert abs(day["active_vehicles"] - exact) <= W.SKETCH_BOUND * exact
