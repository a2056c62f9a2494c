"""Deterministic telemetry view over the driver's ``events`` table.

Every ``events`` row becomes one gps, one imu and one can_bus reading; clicks
also yield a lidar scan, views a camera frame and errors a system-health
reading. Time is compressed 720x (30 days -> one hour) so that minute windows
hold several readings. Numeric payloads are multiples of 1/64 (or of 1/256,
1/512) so that sums are exact in any order.

The formulas are plain SQL expression text shared by both engines: Spark
evaluates them with ``F.expr`` (JVM side, whole-stage codegen), the DuckDB
oracle inlines the same text into its CTEs. Only the timestamp arithmetic has
a per-engine spelling.

Dirt, identical in both engines:
  * every 50th event is delivered twice (a later offset),
  * every 103rd event carries a malformed JSON value,
  * every 97th gps reading has latitude 95, every 101st can reading 9000 rpm,
    every 89th imu reading an implausible accel_z of 150,
  * every 211th event comes from a ``BAD-`` vehicle,
  * every 149th system-health reading has disk usage 120.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.schemas import SENSOR_SCHEMAS, TOPICS
from roadlens.session import SPLIT_BYTES, ensure_partitions, ensure_utc, scratch_path

# Fixed values of the view.
BASE_US = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
COMPRESSION = 720
VEHICLES = 50
DUP_EVERY = 50
MALFORMED_EVERY = 103
BAD_VEHICLE_EVERY = 211
MALFORMED_VALUE = "{not json"

_VNUM = f"lpad(CAST(user_id % {VEHICLES} AS STRING), 3, '0')"

VEHICLE_ID = (
    f"CASE WHEN event_id % {BAD_VEHICLE_EVERY} = 0 THEN concat('BAD-', {_VNUM}) "
    f"ELSE concat('ZX-', {_VNUM}) END"
)

# Lag between event time and ingestion, milliseconds (0 .. 90 s).
LAG_MS = "(event_id * 7919) % 90000"

# Which events feed which sensor.
SENSOR_FILTER = {
    "gps": None,
    "imu": None,
    "can_bus": None,
    "lidar": "event_type = 'click'",
    "camera": "event_type = 'view'",
    "system_health": "event_type = 'error'",
}

# Kafka partitions per topic (12 for the high-rate topics, 6 for the others).
PARTITIONS = {"gps": 12, "imu": 12, "can_bus": 12, "lidar": 6, "camera": 6, "system_health": 6}


def _d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


PAYLOAD_SQL: dict[str, dict[str, str]] = {
    "gps": {
        "latitude": f"CASE WHEN event_id % 97 = 0 THEN {_d('95')} "
        f"ELSE {_d('37')} + {_d('(event_id * 13) % 1024')} / 2048 END",
        "longitude": f"{_d('-122')} - {_d('(event_id * 17) % 1024')} / 2048",
        "altitude_m": f"{_d('event_id % 640')} / 64",
        "speed_ms": f"{_d('(event_id * 7919) % 1920')} / 64",
        "heading_deg": f"{_d('(event_id * 11) % 23040')} / 64",
        "accuracy_m": f"{_d('1')} + {_d('event_id % 64')} / 64",
        "num_satellites": "CAST(4 + event_id % 9 AS INT)",
    },
    "imu": {
        "accel_x": f"{_d('(event_id * 31) % 1001 - 500')} / 256",
        "accel_y": f"{_d('(event_id * 37) % 1001 - 500')} / 256",
        "accel_z": f"CASE WHEN event_id % 89 = 0 THEN {_d('150')} "
        f"ELSE {_d('9.75')} + {_d('(event_id * 41) % 449')} / 64 END",
        "gyro_x": f"{_d('(event_id * 43) % 201 - 100')} / 512",
        "gyro_y": f"{_d('(event_id * 47) % 201 - 100')} / 512",
        "gyro_z": f"{_d('(event_id * 53) % 201 - 100')} / 512",
        "roll_deg": f"{_d('(event_id * 59) % 1921 - 960')} / 64",
        "pitch_deg": f"{_d('(event_id * 61) % 1281 - 640')} / 64",
        "yaw_deg": f"{_d('(event_id * 67) % 23040')} / 64",
        "temperature_celsius": f"{_d('20')} + {_d('event_id % 1280')} / 64",
    },
    "can_bus": {
        "speed_ms": f"{_d('(event_id * 6271) % 1920')} / 64",
        "steering_angle_deg": f"{_d('(event_id * 71) % 2049 - 1024')} / 4",
        "throttle_pct": f"{_d('(event_id * 73) % 6401')} / 64",
        "brake_pressure_pct": f"CASE WHEN value > 100 THEN {_d('100')} ELSE value END",
        "gear": "CASE event_id % 10 WHEN 0 THEN 'P' WHEN 1 THEN 'R' WHEN 2 THEN 'N' ELSE 'D' END",
        "engine_rpm": f"CASE WHEN event_id % 101 = 0 THEN {_d('9000')} "
        f"ELSE {_d('700 + (event_id * 79) % 5000')} END",
        "engine_temp_celsius": f"{_d('70')} + {_d('floor(value * 16)')} / 64",
        "oil_pressure_kpa": f"{_d('200')} + {_d('(event_id * 83) % 12800')} / 64",
        "battery_voltage": f"{_d('11')} + {_d('(event_id * 89) % 192')} / 64",
        "odometer_km": f"{_d(f'1000 * (user_id % {VEHICLES})')} + {_d('event_id')} / 64",
        "brake_wear_pct": f"{_d('(event_id * 97) % 6401')} / 64",
        "turn_signal": "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'left' "
        "WHEN 2 THEN 'right' ELSE 'off' END",
    },
    "lidar": {
        "scan_id": "concat('scan-', CAST(event_id AS STRING))",
        "point_count": "CAST(1000 + (event_id * 101) % 120000 AS INT)",
        "range_min_m": f"{_d('event_id % 64')} / 128",
        "range_max_m": _d("50 + event_id % 150"),
        "field_of_view_deg": _d("360"),
        "scan_duration_ms": _d("100"),
        "obstacles_detected": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 12 AS INT) END",
        "closest_obstacle_m": f"CASE WHEN event_id % 12 = 0 THEN NULL "
        f"ELSE {_d('(event_id * 7) % 3200')} / 64 END",
    },
    "camera": {
        "camera_id": "concat('cam-', CAST(event_id % 6 AS STRING))",
        "frame_id": "concat('frame-', CAST(event_id AS STRING))",
        "resolution_width": "CAST(1920 AS INT)",
        "resolution_height": "CAST(1080 AS INT)",
        "fps": _d("30"),
        "exposure_ms": f"{_d('event_id % 640')} / 64",
        "s3_frame_uri": "CASE WHEN event_id % 2 = 0 THEN concat('frames/', CAST(event_id AS STRING), '.jpg') "
        "ELSE NULL END",
        "objects_detected": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 9 AS INT) END",
        "lanes_detected": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id % 3 = 0 END",
    },
    "system_health": {
        "cpu_usage_pct": f"{_d('(event_id * 7) % 6401')} / 64",
        "memory_usage_pct": f"{_d('(event_id * 11) % 6401')} / 64",
        "disk_usage_pct": f"CASE WHEN event_id % 149 = 0 THEN {_d('120')} "
        f"ELSE {_d('(event_id * 13) % 6401')} / 64 END",
        "gpu_usage_pct": f"CASE WHEN event_id % 5 = 0 THEN NULL ELSE {_d('(event_id * 17) % 6401')} / 64 END",
        "network_rx_mbps": f"{_d('(event_id * 19) % 64000')} / 64",
        "network_tx_mbps": f"{_d('(event_id * 23) % 32000')} / 64",
        "process_count": "CAST(100 + event_id % 300 AS INT)",
        "uptime_seconds": _d("event_id * 10"),
        "av_software_version": "concat('v', CAST(1 + event_id % 3 AS STRING), '.0')",
        "error_count_last_minute": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 4 AS INT) END",
    },
}

# Per-engine spelling of the compressed event time, in microseconds.
TS_US = {
    "spark": f"{BASE_US} + (unix_micros(CAST(ts AS TIMESTAMP)) - {BASE_US}) div {COMPRESSION}",
    "duckdb": f"{BASE_US} + (epoch_us(ts) - {BASE_US}) // {COMPRESSION}",
}
TS_OF_US = {"spark": "timestamp_micros({})", "duckdb": "make_timestamp({})"}


def envelope_sql(sensor: str, dialect: str) -> dict[str, str]:
    """Envelope columns of one sensor reading, as SQL text."""
    ts_us = f"({TS_US[dialect]})"
    ts_of = TS_OF_US[dialect]
    return {
        "event_id": f"concat('{sensor}-', CAST(event_id AS STRING))",
        "vehicle_id": VEHICLE_ID,
        "sensor_type": f"'{sensor}'",
        "timestamp": ts_of.format(ts_us),
        "sequence_number": "CAST(event_id AS BIGINT)",
        "ingested_at": ts_of.format(f"{ts_us} + ({LAG_MS}) * 1000"),
    }


def kafka_sql(sensor: str) -> dict[str, str]:
    """Kafka metadata of the first delivery of a reading."""
    return {
        "topic": f"'{TOPICS[sensor]}'",
        "partition": f"CAST((user_id % {VEHICLES}) % {PARTITIONS[sensor]} AS INT)",
        "offset": "CAST(event_id * 2 AS BIGINT)",
    }


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "ignoreNullFields": "false",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table.

    A single small file scans as one split; the per-row work downstream
    (serialising and decoding JSON) then runs in one task. Spread such a scan
    over the cluster's cores; a scan that already has enough splits is left
    as it is (no shuffle at scale).
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores, "event_id")  # by key: dealing rows out in turn would sort them first
    return df


def sensor_readings(spark: SparkSession, sf_dir: str, sensor: str) -> DataFrame:
    """Typed readings of one sensor (before serialisation), plus Kafka metadata."""
    ensure_utc(spark)
    ev = read_events(spark, sf_dir)
    if SENSOR_FILTER[sensor]:
        ev = ev.filter(F.expr(SENSOR_FILTER[sensor]))
    cols = {**envelope_sql(sensor, "spark"), **PAYLOAD_SQL[sensor]}
    schema = SENSOR_SCHEMAS[sensor]
    typed = [F.expr(cols[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    meta = [F.expr(v).alias(k) for k, v in kafka_sql(sensor).items()]
    return ev.select(*meta, *typed, F.col("event_id").alias("_n"))


def build_raw_messages(spark: SparkSession, sf_dir: str, sensors=None) -> DataFrame:
    """Kafka-shaped messages (key, value, topic, partition, offset, timestamp).

    Duplicated deliveries come from a two-element ``explode`` on the rows that
    are re-sent, so the data is read once.
    """
    sensors = list(sensors or SENSOR_FILTER)
    out = None
    for sensor in sensors:
        r = sensor_readings(spark, sf_dir, sensor)
        payload = [c for c in r.columns if c not in ("topic", "partition", "offset", "_n")]
        value = F.when(
            F.col("_n") % MALFORMED_EVERY == 0, F.lit(MALFORMED_VALUE)
        ).otherwise(F.to_json(F.struct(*payload), JSON_OPTIONS))
        copies = F.when(F.col("_n") % DUP_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        msg = r.select(
            F.col("vehicle_id").cast("binary").alias("key"),
            value.cast("binary").alias("value"),
            "topic",
            "partition",
            F.col("offset"),
            F.col("ingested_at").alias("timestamp"),
            F.explode(copies).alias("_copy"),
        ).select(
            "key", "value", "topic", "partition",
            (F.col("offset") + F.col("_copy")).alias("offset"), "timestamp",
        )
        out = msg if out is None else out.unionByName(msg)
    return out


_RAW_PATHS: dict[tuple[str, str], str] = {}


def raw_table_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the message table once per session and scale factor.

    The table lives in the shared checkpoint folder, partitioned by topic like
    a topic-per-folder landing zone. Each topic is a write of its own: rows go
    to their file as they come, where one write of all topics would sort every
    task's messages by topic first and hold them in memory. Its row groups fit
    the splits of the streams (``small_splits``). Reading it back also cuts the lineage
    between serialisation and decoding, so the optimizer never inlines the
    JSON writer into the reader.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RAW_PATHS:
        ensure_partitions(spark, spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count())
        path = scratch_path(spark, "telemetry-raw")
        with ThreadPoolExecutor(len(SENSOR_FILTER)) as pool:
            writes = [pool.submit(build_raw_messages(spark, sf_dir, [s]).drop("topic").write.option("parquet.block.size", SPLIT_BYTES).parquet,
                                  f"{path}/topic={TOPICS[s]}")
                      for s in SENSOR_FILTER]
            for done in writes:
                done.result()
        _RAW_PATHS[key] = path
    return _RAW_PATHS[key]


def raw_messages(spark: SparkSession, sf_dir: str, sensors=None) -> DataFrame:
    """The message table, optionally limited to some sensors' topics (the topic
    predicate prunes partitions at the scan)."""
    ensure_utc(spark)
    df = spark.read.parquet(raw_table_path(spark, sf_dir))
    if sensors:
        df = df.filter(F.col("topic").isin([TOPICS[s] for s in sensors]))
    return df.select("key", "value", "topic", "partition", "offset", "timestamp")


# ---------------------------------------------------------------------------
# DuckDB side (oracle CTE text)
# ---------------------------------------------------------------------------


def duck_readings_cte(sensor: str, clean: bool = True) -> str:
    """SELECT text of the typed readings of ``sensor`` in DuckDB.

    With ``clean`` the malformed deliveries are removed (what JSON decoding
    followed by the null-vehicle filter leaves).
    """
    cols = {**kafka_sql(sensor), **envelope_sql(sensor, "duckdb"), **PAYLOAD_SQL[sensor]}
    schema = SENSOR_SCHEMAS[sensor]
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    items = []
    for k, v in cols.items():
        if k in types:
            t = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}[types[k]]
            items.append(f"CAST({v} AS {t}) AS \"{k}\"")
        else:
            items.append(f"{v} AS \"{k}\"")
    where = []
    if SENSOR_FILTER[sensor]:
        where.append(SENSOR_FILTER[sensor])
    if clean:
        where.append(f"event_id % {MALFORMED_EVERY} <> 0")
    w = f" WHERE {' AND '.join(where)}" if where else ""
    return f"SELECT {', '.join(items)} FROM events{w}"
