"""Structured Streaming topology: R1-R11, S8, S9, M13.

One watermark per pipeline, set once right after decoding (R1); the window
summaries, deduplication and alert state downstream never redefine it.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.time import time_parts
from roadlens.operators import alerts as A
from roadlens.operators import windows as W
from roadlens.operators.enrich import enrich, enrich_gps, inputs_of, snapshot
from roadlens.operators.validate import deduplicate_stream, filter_invalid
from roadlens.schemas import SANITY_BOUNDS, SENSOR_SCHEMAS, TOPICS
from roadlens.sources.kafka import parse_messages, read_stream

# Watermark delays per pipeline and the default trigger.
WATERMARK = {"gps": "1 minute", "imu": "1 minute", "can_bus": "2 minutes"}
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
PARTITION_COLS = ["year", "month", "day", "vehicle_id", "sensor_type"]


def sensor_stream(raw: DataFrame, sensor: str, watermark: str | None = None, columns=None) -> DataFrame:
    """Decode one topic, set the watermark once (R1), filter, deduplicate
    within the watermark (R3), enrich and add time parts.

    With ``columns`` (decoded or derived) only what these and the filter need is
    decoded, and only what the ``columns`` need goes through the deduplication."""
    topic, needs, decoded = raw.filter(F.col("topic") == TOPICS[sensor]), None, None
    if columns is not None:
        needs = list(dict.fromkeys(["event_id", "timestamp", *inputs_of(sensor, columns)]))
        if "processing_lag_ms" in columns:
            needs.append("ingested_at")
        decoded = {*needs, *inputs_of(sensor, (c.column for c in SANITY_BOUNDS.get(sensor, [])))}
    df = parse_messages(topic, SENSOR_SCHEMAS[sensor], decoded)
    df = df.withWatermark("timestamp", watermark or WATERMARK.get(sensor, "1 minute"))
    df = filter_invalid(df, sensor)
    df = deduplicate_stream(df.select(*dict.fromkeys(needs)) if needs else df)
    if sensor == "gps":
        df = enrich_gps(df, as_of=F.col("ingested_at") if "ingested_at" in df.columns else None)
    else:
        df = enrich(df, sensor)
    return time_parts(df) if columns is None else df.select(*columns)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB, as timers need.
    A query's checkpoint remembers it; the session's own setting comes back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def parquet_sink(df: DataFrame, path: str, checkpoint: str, partition_cols=None,
                 trigger: dict | None = None, name: str | None = None,
                 files_per_partition: int = 4):
    """Partitioned Parquet file sink, append mode, checkpointed.

    Rows are clustered on the partition keys plus a small salt before the
    sink: each folder gets at most ``files_per_partition`` files per trigger,
    and a hot vehicle's rows are spread over that many tasks.
    """
    out = df
    if partition_cols:
        salt_src = "event_id" if "event_id" in df.columns else partition_cols[0]
        salt = F.pmod(F.xxhash64(F.col(salt_src)), F.lit(files_per_partition))
        out = df.repartition(*[F.col(c) for c in partition_cols], salt)
    w = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or DEFAULT_TRIGGER))
    return w.start(path)


def console_sink(df: DataFrame, truncate: bool = False, trigger: dict | None = None):
    """Debug console sink in update mode."""
    return (
        df.writeStream.format("console").outputMode("update").option("truncate", str(truncate).lower())
        .trigger(**(trigger or DEFAULT_TRIGGER)).start()
    )


@dataclass
class Topology:
    """The started queries of one deployment."""

    queries: list = field(default_factory=list)

    def await_any(self, spark: SparkSession, timeout: float | None = None) -> None:
        try:
            spark.streams.awaitAnyTermination(timeout)
        except KeyboardInterrupt:
            self.stop()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def start_topology(
    spark: SparkSession,
    raw: DataFrame,
    out_root: str,
    checkpoint_root: str,
    *,
    trigger: dict | None = None,
    scorer=None,
) -> Topology:
    """Per sensor an enriched sink plus one query per window summary; an
    anomaly branch when a scorer is given (M13); alerts with stateful
    cool-down (R10)."""
    topo = Topology()

    def start(df, name, cols):
        topo.queries.append(
            parquet_sink(df, f"{out_root}/{name}", f"{checkpoint_root}/{name}", cols, trigger, name)
        )

    streams = {s: sensor_stream(raw, s) for s in ("gps", "imu", "can_bus")}
    for s, df in streams.items():
        start(df, s, PARTITION_COLS)
    for key, (sensor, fn, dur) in W.WINDOW_SUMMARIES.items():
        start(time_parts(fn(streams[sensor], dur), "window_start", with_hour=False), f"{key}_summary",
              ["year", "month", "day"])
    if scorer is not None:
        can = streams["can_bus"]
        if "accel_magnitude" not in can.columns:
            can = align_imu_stream(can, streams["imu"])
        scored = scorer(can)
        start(scored.filter(F.col("is_anomaly")), "anomalies", ["year", "month", "day", "vehicle_id"])
    return topo


#: Steps of a search through a sorted array, largest first.
_STEPS = f"array({', '.join(str(1 << i) for i in range(30, -1, -1))})"


def align_imu_stream(can: DataFrame, imu: DataFrame, tolerance_s: int = 1) -> DataFrame:
    """F2 on streams: the newest imu ``accel_magnitude`` of the same vehicle at
    or before each can_bus reading, within the tolerance (else null).

    Readings meet in windows of two tolerances, one tolerance apart. The second
    half of a window brings its can_bus and its imu readings, the first half
    only its newest imu reading; no pairs are formed. A window is emitted once
    the watermark has passed it, and each of its can_bus readings then finds its
    partner by binary search. State is bounded by the watermark.
    """
    tol = int(tolerance_s)
    reading = F.struct(F.col("timestamp").alias("its"), F.col("sequence_number").alias("seq"),
                       F.col("accel_magnitude").alias("acc"))
    whole = F.struct(*can.columns)
    as_type = {"_imu": imu.select(reading.alias("r")).schema["r"].dataType, "_can": can.select(whole.alias("r")).schema["r"].dataType}
    none = {k: F.lit(None).cast(t).alias(k) for k, t in as_type.items()}
    rows = (
        can.select("vehicle_id", "timestamp", none["_imu"], whole.alias("_can"))
        .unionByName(imu.select("vehicle_id", "timestamp", reading.alias("_imu"), none["_can"]))
        .withColumn("_w", F.window("timestamp", f"{2 * tol} seconds", f"{tol} seconds"))
        .withColumn("_own", F.col("timestamp") >= F.col("_w.start") + F.expr(f"INTERVAL {tol} SECONDS"))
        .filter("_own OR _can IS NULL")
    )
    met = rows.groupBy("vehicle_id", "_w").agg(
        F.collect_list("_can").alias("_cans"),
        F.sort_array(F.collect_list(F.when(F.col("_own"), F.col("_imu")))).alias("_imus"),
        F.max(F.when(~F.col("_own"), F.col("_imu"))).alias("_before"),
    )
    place = f"""aggregate({_STEPS}, 0, (p, s) -> if(s <= size(_imus) - p AND _imus[p + s - 1].its <= c.timestamp, p + s, p))"""
    pairs = F.expr(f"""transform(transform(_cans, c -> struct(c AS c, {place} AS p)),
        x -> struct(x.c AS c, if(x.p > 0, _imus[x.p - 1], _before) AS m))""")
    ok = F.col("m.its") >= F.col("c.timestamp") - F.expr(f"INTERVAL {tol} SECONDS")
    return met.select(F.inline(pairs)).select(
        *[F.col(f"c.{c}").alias(c) for c in can.columns if c != "accel_magnitude"],
        F.when(ok, F.col("m.acc")).alias("accel_magnitude"), F.when(ok, F.col("m.its")).alias("imu_timestamp"))


def alert_stream(snap: DataFrame, rules=None) -> DataFrame:
    """Candidates of a snapshot stream through the stateful cool-down."""
    return A.apply_cooldown_stream(A.candidates(snap, rules))


def snapshot_stream(raw: DataFrame, scorer=None, watermark: str | None = None, columns: dict | None = None) -> DataFrame:
    """P14 on streams (one union of the three sensor pipelines). ``columns`` are
    those that each sensor decodes and deduplicates, the scorer's included."""
    streams = [sensor_stream(raw, s, watermark, columns and columns[s]) for s in ("gps", "imu", "can_bus")]
    if scorer is not None:
        streams[2] = scorer(streams[2])
    return snapshot(*streams)


def progress_table(spark: SparkSession, queries) -> DataFrame:
    """The last progress of each query, flattened to one row per query
    and source (rows in, rows per second, rows dropped by the watermark)."""
    rows = []
    for q in queries:
        p = q.lastProgress
        if not p:
            continue
        dropped = sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))
        state_rows = sum(int(op.get("numRowsTotal", 0)) for op in p.get("stateOperators", []))
        for src in p.get("sources", []):
            rows.append((
                p.get("name") or q.name, int(p.get("batchId", -1)), src.get("description"),
                int(src.get("numInputRows", 0)), float(src.get("processedRowsPerSecond") or 0.0),
                dropped, state_rows,
            ))
    schema = ("query string, batch_id long, source string, input_rows long, rows_per_second double, "
              "dropped_by_watermark long, state_rows long")
    return spark.createDataFrame(rows, schema)


def file_source(spark: SparkSession, paths: list[str], topics, max_files_per_trigger=None) -> DataFrame:
    """S1 on files: one streaming source per folder, unioned."""
    out = None
    for p in paths:
        df = read_stream(spark, topics, source="files", path=p, max_files_per_trigger=max_files_per_trigger)
        out = df if out is None else out.unionByName(df)
    return out
