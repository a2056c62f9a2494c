"""Registered streaming queries: the batch queries' semantics run as
Structured Streaming jobs (file source, watermark, state, Parquet sink) and read
back. The oracle is the batch query's SQL.

The stream reads the message folder plus a control folder. Three
``availableNow`` runs share one checkpoint: the data, then two control
messages far in the future. The first control message moves the watermark
past every data window; the second lets the engine evict them (a watermark
set in one batch is applied in the next). Control rows are removed from the
output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators import windows as W
from roadlens.plans import tables
from roadlens.plans.oracle import with_ctes
from roadlens.plans.registry import ORACLES, all_processed, beside_exact, register
from roadlens.plans.telemetry_view import JSON_OPTIONS, raw_table_path
from roadlens.schemas import SENSOR_SCHEMAS, STREAM_ENVELOPE, TOPICS
from roadlens.session import scratch_path, small_splits
from roadlens.sources.kafka import parse_messages, quarantine
from roadlens.streaming import jobs as J
from roadlens.streaming.progress import ProgressLog, totals
from roadlens.streaming.topology import READINGS, Landing

CONTROL_VEHICLE = "ZX-CONTROL"
CONTROL_TS = ("2024-03-01 00:00:00", "2024-04-01 00:00:00")

# Values that pass every sanity filter, per sensor.
_CONTROL_FIELDS = {
    "gps": {"latitude": 0.0, "longitude": 0.0, "speed_ms": 0.0, "heading_deg": 0.0},
    "imu": {"accel_x": 0.0, "accel_y": 0.0, "accel_z": 0.0, "gyro_x": 0.0, "gyro_y": 0.0, "gyro_z": 0.0},
    "can_bus": {"speed_ms": 0.0, "engine_rpm": 1000.0, "engine_temp_celsius": 80.0,
                "brake_pressure_pct": 0.0, "battery_voltage": 12.5, "brake_wear_pct": 0.0},
}


def _control_messages(spark: SparkSession, ts: str, phase: int) -> DataFrame:
    parts = []
    for sensor, vals in _CONTROL_FIELDS.items():
        schema = SENSOR_SCHEMAS[sensor]
        cols = []
        for f in schema.fields:
            if f.name == "event_id":
                c = F.lit(f"control-{sensor}-{phase}")
            elif f.name == "vehicle_id":
                c = F.lit(CONTROL_VEHICLE)
            elif f.name == "sensor_type":
                c = F.lit(sensor)
            elif f.name in ("timestamp", "ingested_at"):
                c = F.lit(ts).cast("timestamp")
            elif f.name == "sequence_number":
                c = F.lit(-phase).cast("long")
            elif f.name in vals:
                c = F.lit(vals[f.name])
            else:
                c = F.lit(None)
            cols.append(c.cast(f.dataType).alias(f.name))
        row = spark.range(1).select(F.to_json(F.struct(*cols), JSON_OPTIONS).alias("v"))
        parts.append(row.select(
            F.lit(CONTROL_VEHICLE).cast("binary").alias("key"),
            F.col("v").cast("binary").alias("value"),
            F.lit(TOPICS[sensor]).alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(-phase).cast("long").alias("offset"),
            F.lit(ts).cast("timestamp").alias("timestamp"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*[f.name for f in STREAM_ENVELOPE.fields])


def in_slices(messages: DataFrame, slices: int) -> list[DataFrame]:
    """The messages in order of their readings' time, in slices of equal length;
    malformed ones come first."""
    us = F.unix_micros(F.try_to_timestamp(F.get_json_object(F.col("value").cast("string"), "$.timestamp")))
    lo, hi = messages.agg(F.min(us), F.max(us)).first()
    number = F.least(F.coalesce(F.floor((us - F.lit(lo)) * slices / F.lit(hi - lo + 1)), F.lit(0)), F.lit(slices - 1))
    return [messages.filter(number == i) for i in range(slices)]


def run_stream(spark: SparkSession, sf: str, build, name: str, slices: int | None = None) -> DataFrame:
    """Run ``build(raw_stream)`` to completion through a Parquet sink; with
    ``slices`` the data come in as many deliveries, in order of time."""
    root = scratch_path(spark, f"stream-{name}")
    control, data = f"{root}/control", raw_table_path(spark, sf)
    spark.createDataFrame([], STREAM_ENVELOPE).write.parquet(control)
    deliveries = [None, *(_control_messages(spark, ts, i + 1).coalesce(1) for i, ts in enumerate(CONTROL_TS))]
    if slices:
        deliveries[:1] = in_slices(spark.read.schema(STREAM_ENVELOPE).parquet(data), slices)
        data = control
    raw = J.file_source(spark, list(dict.fromkeys([data, control])), list(TOPICS.values()))
    df = build(raw)
    out, ckpt = f"{root}/out", f"{root}/checkpoint"
    for delivery in deliveries:
        if delivery is not None:
            delivery.write.mode("append").parquet(control)
        q = (
            df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out)
        )
        q.awaitTermination()
    res = spark.read.schema(df.schema).parquet(out)
    if "vehicle_id" in res.columns:
        res = res.filter(F.col("vehicle_id") != CONTROL_VEHICLE)
    elif "window_start" in res.columns:
        res = res.filter(F.col("window_start") < F.lit(CONTROL_TS[0]).cast("timestamp"))
    return res


def _reg(key: str, batch_key: str, build):
    register(key, ORACLES.get(batch_key))(lambda spark, sf: run_stream(spark, sf, build, key))


for key, (sensor, fn, dur) in W.WINDOW_SUMMARIES.items():
    batch = {"w1": "w1_speed_summary", "w2": "w2_hard_braking", "w3": "w3_engine_health",
             "w4": "w4_imu_vibration"}[key]
    _reg(f"r_stream_{key}", batch,
         (lambda s, f, d, c: lambda raw: f(J.sensor_stream(raw, s, "2 minutes", c), d))(
             sensor, fn, dur, W.SUMMARIES[key].reads))


def _readings(raw):
    parts = [J.sensor_stream(raw, s, "2 minutes", ("timestamp", "sensor_type", "vehicle_id"))
             for s in ("gps", "imu", "can_bus")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_reg("r_stream_w5", "w5_throughput", lambda raw: W.fleet_throughput(_readings(raw), "1 minute"))


@register("r_stream_w5_sketched", ORACLES["w5_sketched_hours"])
def r_stream_w5_sketched(spark, sf):
    """W5's sketched minutes from a stream, merged to hours where they are stored."""
    minutes = run_stream(spark, sf, lambda raw: W.throughput_sketches(_readings(raw)), "r_stream_w5_sketched")
    return beside_exact(minutes, all_processed(spark, sf), "sensor_type")


_reg("r_stream_dedup", "p_enrich_can", lambda raw: J.sensor_stream(raw, "can_bus"))


def _scorer(can):
    return can.withColumn("anomaly_score", tables.standin_score()).withColumn(
        "is_anomaly", F.col("anomaly_score") < tables.STANDIN_CUT)


#: The readings of an hour come in two deliveries, so many alerts are due, and
#: state expires, while data still come.
ALERT_WATERMARK = "5 minutes"
ALERT_SLICES = 2
#: What the rules' snapshots and the scorer read.
ALERT_READS = {s: ("event_id", "vehicle_id", "sensor_type", "timestamp", *own) for s, own in {
    "gps": ("speed_ms",), "imu": ("accel_magnitude",), "can_bus": ("speed_ms", "engine_temp_celsius", "sequence_number"),
}.items()}


def _alerts(raw):
    snap = J.snapshot_stream(raw, scorer=_scorer, watermark=ALERT_WATERMARK, columns=ALERT_READS)
    return J.alert_stream(snap).select("rule", "severity", "vehicle_id", "message", "ts", "event_id")


def _f2(raw):
    can = J.sensor_stream(raw, "can_bus").select("event_id", "vehicle_id", "timestamp")
    imu = J.sensor_stream(raw, "imu")
    return J.align_imu_stream(can, imu).select(
        "event_id", "vehicle_id", "timestamp", "accel_magnitude", "imu_timestamp")


def _register_f2():
    from roadlens.plans import q_features  # noqa: F401  (oracle text)

    _reg("r_stream_f2_align", "f2_align_imu", _f2)


_register_f2()


def _register_alerts():
    from roadlens.plans import q_alerts  # noqa: F401  (oracle text)

    def alerts(spark, sf):
        with J.rocksdb_state(spark):
            return run_stream(spark, sf, _alerts, "r_stream_alerts", ALERT_SLICES)

    register("r_stream_alerts", ORACLES["a_cooldown_all"])(alerts)


_register_alerts()


def _register_quarantine():
    from roadlens.plans import q_rows  # noqa: F401  (oracle text)

    _reg("r_stream_quarantine", "s_quarantine_malformed", quarantine)


_register_quarantine()


# ---------------------------------------------------------------------------
# The sinks of one landing that decodes each micro-batch once
# ---------------------------------------------------------------------------

#: Message files per micro-batch: two or three micro-batches here.
LANDING_FILES = 24
_LANDINGS: dict[tuple[str, str], Landing] = {}


def landed(spark: SparkSession, sf: str) -> Landing:
    """The view's messages, landed once per session in several micro-batches,
    of which the first is then processed again, as after a failure."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _LANDINGS:
        root = scratch_path(spark, "landing")
        landing = Landing(f"{root}/tables", scorer=_scorer, buckets=4)
        raw = J.file_source(spark, [raw_table_path(spark, sf)], list(TOPICS.values()), LANDING_FILES)

        def process(batch, batch_id):
            landing.process(batch, batch_id)
            if batch_id == 0:
                landing.process(batch, batch_id)

        with small_splits(spark):  # a batch is held while its sinks read it
            q = (raw.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(process)
                 .trigger(availableNow=True).start())
            q.awaitTermination()
        _LANDINGS[key] = landing
    return _LANDINGS[key]


def _register_landing():
    """Where an event was delivered twice, which copy came first depends on the
    micro-batches: the offset is not compared."""
    from roadlens.plans import q_alerts, q_rows  # noqa: F401  (oracle text)

    def sink(name, *drop):
        return lambda spark, sf: landed(spark, sf).rows(spark, name).drop(*drop)

    days = ("year", "month", "day")
    for sensor, batch in (("gps", "p_enrich_gps"), ("imu", "p_enrich_imu"), ("can_bus", "p_enrich_can")):
        register(f"r_topology_{sensor}", f'SELECT * EXCLUDE ("offset") FROM ({ORACLES[batch]}) b')(sink(sensor, "offset"))
    register("r_topology_candidates", ORACLES["a_candidates"])(sink("candidates", *days))
    register("r_topology_quarantine", ORACLES["s_quarantine_malformed"])(sink("quarantine", "partition", "timestamp", *days))
    register("r_topology_violations", ORACLES["s_quarantine"])(
        lambda spark, sf: sink("violations")(spark, sf).select(
            "event_id", "sensor_type", "vehicle_id", F.array_join("violations", ",").alias("violation_list")))
    register("r_topology_anomalies", with_ctes("SELECT event_id, anomaly_score FROM can_scored WHERE anomaly_score < -0.7", "can_scored"))(
        lambda spark, sf: sink("anomalies")(spark, sf).select("event_id", "anomaly_score"))
    register("r_topology_counters", ORACLES["s_decode_stats"])(
        lambda spark, sf: sink("counters")(spark, sf).groupBy("topic").agg(
            *[F.sum(c).alias(c) for c in ("received", "parse_errors", "decoded")]))


_register_landing()


# ---------------------------------------------------------------------------
# What the queries reported, read back from the progress store
# ---------------------------------------------------------------------------

PROGRESS_FILES = 3


def _register_progress():
    from roadlens.plans import q_rows  # noqa: F401  (oracle text)

    @register("r_progress", "SELECT 'decoded-' || topic AS query, received AS input_rows, 0 AS dropped_by_watermark, "
                            f"true AS several_batches FROM ({ORACLES['s_decode_stats']}) s WHERE topic IN "
                            f"({', '.join(repr(TOPICS[s]) for s in READINGS)})")
    def r_progress(spark, sf):
        """Rows read by one query per sensor topic over several micro-batches."""
        root = scratch_path(spark, "progress")
        with ProgressLog(spark, f"{root}/progress") as log:
            for sensor in READINGS:
                topic = TOPICS[sensor]
                source = spark.readStream.schema(STREAM_ENVELOPE).option("maxFilesPerTrigger", PROGRESS_FILES).parquet(
                    f"{raw_table_path(spark, sf)}/topic={topic}")
                decoded = parse_messages(source.withColumn("topic", F.lit(topic)), SENSOR_SCHEMAS[sensor])
                q = (decoded.writeStream.queryName(f"decoded-{topic}").format("parquet")
                     .option("checkpointLocation", f"{root}/checkpoint-{sensor}").trigger(availableNow=True)
                     .start(f"{root}/{sensor}"))
                q.awaitTermination()
                log.wait(q)
        return totals(log.rows()).select("query", "input_rows", "dropped_by_watermark", (F.col("batches") > 1).alias("several_batches"))


_register_progress()
