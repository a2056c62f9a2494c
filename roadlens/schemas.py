"""Declared schemas for the six sensor event kinds, the stream envelope and the
serving tables (data model of SURVEY §1, sources S4 and S12).

Every schema is fixed and declared, never inferred. One module holds them all so
that parsing, validation, landing and serving derive from the same definitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _f(name: str, dtype, nullable: bool = True) -> StructField:
    return StructField(name, dtype, nullable)


# Sensor kinds and their topics.
SENSOR_TYPES = ("gps", "imu", "lidar", "camera", "can_bus", "system_health")

TOPICS = {
    "gps": "av.telemetry.gps",
    "imu": "av.telemetry.imu",
    "lidar": "av.telemetry.lidar",
    "camera": "av.telemetry.camera",
    "can_bus": "av.telemetry.can_bus",
    "system_health": "av.telemetry.system",
}
ALERTS_TOPIC = "av.alerts"
TOPIC_TO_SENSOR = {topic: sensor for sensor, topic in TOPICS.items()}

# Fixed value: every vehicle id starts with this prefix.
VEHICLE_PREFIX = "ZX-"

# The columns of the envelope.
ENVELOPE = StructType(
    [
        _f("event_id", StringType()),
        _f("vehicle_id", StringType()),
        _f("sensor_type", StringType()),
        _f("timestamp", TimestampType()),
        _f("sequence_number", LongType()),
        _f("ingested_at", TimestampType()),
    ]
)

# The columns of the six sensor kinds.
PAYLOADS: dict[str, list[StructField]] = {
    "gps": [
        _f("latitude", DoubleType()),
        _f("longitude", DoubleType()),
        _f("altitude_m", DoubleType()),
        _f("speed_ms", DoubleType()),
        _f("heading_deg", DoubleType()),
        _f("accuracy_m", DoubleType()),
        _f("num_satellites", IntegerType()),
    ],
    "imu": [
        _f("accel_x", DoubleType()),
        _f("accel_y", DoubleType()),
        _f("accel_z", DoubleType()),
        _f("gyro_x", DoubleType()),
        _f("gyro_y", DoubleType()),
        _f("gyro_z", DoubleType()),
        _f("roll_deg", DoubleType()),
        _f("pitch_deg", DoubleType()),
        _f("yaw_deg", DoubleType()),
        _f("temperature_celsius", DoubleType()),
    ],
    "can_bus": [
        _f("speed_ms", DoubleType()),
        _f("steering_angle_deg", DoubleType()),
        _f("throttle_pct", DoubleType()),
        _f("brake_pressure_pct", DoubleType()),
        _f("gear", StringType()),
        _f("engine_rpm", DoubleType()),
        _f("engine_temp_celsius", DoubleType()),
        _f("oil_pressure_kpa", DoubleType()),
        _f("battery_voltage", DoubleType()),
        _f("odometer_km", DoubleType()),
        _f("brake_wear_pct", DoubleType()),
        _f("turn_signal", StringType()),
    ],
    "lidar": [
        _f("scan_id", StringType()),
        _f("point_count", IntegerType()),
        _f("range_min_m", DoubleType()),
        _f("range_max_m", DoubleType()),
        _f("field_of_view_deg", DoubleType()),
        _f("scan_duration_ms", DoubleType()),
        _f("obstacles_detected", IntegerType()),
        _f("closest_obstacle_m", DoubleType()),
    ],
    "camera": [
        _f("camera_id", StringType()),
        _f("frame_id", StringType()),
        _f("resolution_width", IntegerType()),
        _f("resolution_height", IntegerType()),
        _f("fps", DoubleType()),
        _f("exposure_ms", DoubleType()),
        _f("s3_frame_uri", StringType()),
        _f("objects_detected", IntegerType()),
        _f("lanes_detected", BooleanType()),
    ],
    "system_health": [
        _f("cpu_usage_pct", DoubleType()),
        _f("memory_usage_pct", DoubleType()),
        _f("disk_usage_pct", DoubleType()),
        _f("gpu_usage_pct", DoubleType()),
        _f("network_rx_mbps", DoubleType()),
        _f("network_tx_mbps", DoubleType()),
        _f("process_count", IntegerType()),
        _f("uptime_seconds", DoubleType()),
        _f("av_software_version", StringType()),
        _f("error_count_last_minute", IntegerType()),
    ],
}

SENSOR_SCHEMAS: dict[str, StructType] = {
    sensor: StructType(ENVELOPE.fields + fields) for sensor, fields in PAYLOADS.items()
}

# Topic -> schema routing for all six topics.
TOPIC_SCHEMAS: dict[str, StructType] = {
    TOPICS[sensor]: schema for sensor, schema in SENSOR_SCHEMAS.items()
}

# Kafka-shaped stream envelope; file sources carry the same columns.
STREAM_ENVELOPE = StructType(
    [
        _f("key", BinaryType()),
        _f("value", BinaryType()),
        _f("topic", StringType()),
        _f("partition", IntegerType()),
        _f("offset", LongType()),
        _f("timestamp", TimestampType()),
    ]
)


# ---------------------------------------------------------------------------
# Declarative constraints. Each entry is (column, kind, args).
#   required      column must be non-null
#   range         lo <= x <= hi (either bound may be None); `hi_open` for x < hi
#   prefix        string starts with the given prefix
#   one_of        value in the given set
# Optional fields with defaults are listed in DEFAULTS.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Constraint:
    column: str
    kind: str
    lo: float | None = None
    hi: float | None = None
    hi_open: bool = False
    values: tuple = ()


def _required(*cols: str) -> list[Constraint]:
    return [Constraint(c, "required") for c in cols]


def _rng(col: str, lo=None, hi=None, hi_open: bool = False) -> Constraint:
    return Constraint(col, "range", lo=lo, hi=hi, hi_open=hi_open)


ENVELOPE_CONSTRAINTS = _required("event_id", "vehicle_id", "sensor_type", "timestamp") + [
    Constraint("vehicle_id", "prefix", values=(VEHICLE_PREFIX,)),
    Constraint("sensor_type", "one_of", values=SENSOR_TYPES),
]

# Sanity bounds of the processing path (T1-T4). They are looser
# than the payload's, and a missing value is out of bounds.
SANITY_BOUNDS: dict[str, list[Constraint]] = {
    "gps": [_rng("latitude", -90, 90), _rng("longitude", -180, 180), _rng("speed_ms", 0)],
    "imu": [_rng("accel_magnitude", hi=100, hi_open=True)],
    "can_bus": [_rng("engine_rpm", 0, 8000), _rng("engine_temp_celsius", -40, 200)],
}

# Payload bounds of the six sensor kinds.
PAYLOAD_CONSTRAINTS: dict[str, list[Constraint]] = {
    "gps": _required(
        "latitude", "longitude", "altitude_m", "speed_ms", "heading_deg",
        "accuracy_m", "num_satellites",
    ) + [
        _rng("latitude", -90.0, 90.0),
        _rng("longitude", -180.0, 180.0),
        _rng("speed_ms", 0.0),
        _rng("heading_deg", 0.0, 360.0, hi_open=True),
        _rng("accuracy_m", 0.0),
        _rng("num_satellites", 0),
    ],
    "imu": _required(
        "accel_x", "accel_y", "accel_z", "gyro_x", "gyro_y", "gyro_z",
        "roll_deg", "pitch_deg", "yaw_deg", "temperature_celsius",
    ),
    "can_bus": _required(
        "speed_ms", "steering_angle_deg", "throttle_pct", "brake_pressure_pct", "gear",
        "engine_rpm", "engine_temp_celsius", "oil_pressure_kpa", "battery_voltage",
        "odometer_km", "brake_wear_pct",
    ) + [
        _rng("speed_ms", 0.0),
        _rng("steering_angle_deg", -540.0, 540.0),
        _rng("throttle_pct", 0.0, 100.0),
        _rng("brake_pressure_pct", 0.0, 100.0),
        _rng("engine_rpm", 0.0),
        _rng("oil_pressure_kpa", 0.0),
        _rng("battery_voltage", 0.0),
        _rng("odometer_km", 0.0),
        _rng("brake_wear_pct", 0.0, 100.0),
    ],
    "lidar": _required(
        "scan_id", "point_count", "range_min_m", "range_max_m", "field_of_view_deg",
        "scan_duration_ms",
    ) + [_rng("point_count", 0)],
    "camera": _required(
        "camera_id", "frame_id", "resolution_width", "resolution_height", "fps", "exposure_ms",
    ),
    "system_health": _required(
        "cpu_usage_pct", "memory_usage_pct", "disk_usage_pct", "network_rx_mbps",
        "network_tx_mbps", "process_count", "uptime_seconds", "av_software_version",
    ) + [
        _rng("cpu_usage_pct", 0.0, 100.0),
        _rng("memory_usage_pct", 0.0, 100.0),
        _rng("disk_usage_pct", 0.0, 100.0),
        _rng("gpu_usage_pct", 0.0, 100.0),
        _rng("network_rx_mbps", 0.0),
        _rng("network_tx_mbps", 0.0),
    ],
}

# Defaults applied to optional fields that arrive null.
DEFAULTS: dict[str, dict[str, object]] = {
    "_envelope": {"sequence_number": 0},
    "lidar": {"obstacles_detected": 0},
    "camera": {"objects_detected": 0, "lanes_detected": False},
    "system_health": {"error_count_last_minute": 0},
}


# ---------------------------------------------------------------------------
# Serving tables (columns, key, not-null, defaults).
# ---------------------------------------------------------------------------

TS = TimestampType()
D = DoubleType()
S = StringType()
I = IntegerType()
L = LongType()
B = BooleanType()


@dataclass(frozen=True)
class TableDef:
    name: str
    schema: StructType
    key: tuple[str, ...]
    not_null: tuple[str, ...]
    default_now: tuple[str, ...] = ()


def _schema(cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


# The columns and keys of the serving tables.
SERVING_TABLES: dict[str, TableDef] = {
    "gps_events": TableDef(
        "gps_events",
        _schema([
            ("event_id", S), ("vehicle_id", S), ("timestamp", TS), ("latitude", D),
            ("longitude", D), ("altitude_m", D), ("speed_ms", D), ("speed_kmh", D),
            ("heading_deg", D), ("accuracy_m", D), ("num_satellites", I), ("is_moving", B),
            ("year", I), ("month", I), ("day", I), ("hour", I),
        ]),
        key=("event_id",),
        not_null=("event_id", "vehicle_id", "timestamp"),
    ),
    "imu_events": TableDef(
        "imu_events",
        _schema([
            ("event_id", S), ("vehicle_id", S), ("timestamp", TS), ("accel_x", D),
            ("accel_y", D), ("accel_z", D), ("accel_magnitude", D), ("lateral_g", D),
            ("longitudinal_g", D), ("gyro_magnitude", D), ("roll_deg", D), ("pitch_deg", D),
            ("yaw_deg", D), ("year", I), ("month", I), ("day", I),
        ]),
        key=("event_id",),
        not_null=("event_id", "vehicle_id", "timestamp"),
    ),
    "can_bus_events": TableDef(
        "can_bus_events",
        _schema([
            ("event_id", S), ("vehicle_id", S), ("timestamp", TS), ("speed_ms", D),
            ("speed_kmh", D), ("steering_angle_deg", D), ("throttle_pct", D),
            ("brake_pressure_pct", D), ("gear", S), ("engine_rpm", D),
            ("engine_temp_celsius", D), ("oil_pressure_kpa", D), ("battery_voltage", D),
            ("odometer_km", D), ("brake_wear_pct", D), ("hard_braking", B),
            ("engine_overheating", B), ("low_battery", B), ("year", I), ("month", I),
            ("day", I),
        ]),
        key=("event_id",),
        not_null=("event_id", "vehicle_id", "timestamp"),
    ),
    "anomaly_detections": TableDef(
        "anomaly_detections",
        _schema([
            ("event_id", S), ("vehicle_id", S), ("timestamp", TS), ("sensor_type", S),
            ("anomaly_score", D), ("features", S), ("detected_at", TS),
        ]),
        key=(),
        not_null=("event_id", "vehicle_id", "timestamp", "sensor_type", "anomaly_score"),
        default_now=("detected_at",),
    ),
    "vehicle_summary_1min": TableDef(
        "vehicle_summary_1min",
        _schema([
            ("window_start", TS), ("window_end", TS), ("vehicle_id", S),
            ("avg_speed_ms", D), ("max_speed_ms", D), ("min_speed_ms", D),
            ("speed_stddev", D), ("event_count", L),
        ]),
        key=("window_start", "vehicle_id"),
        not_null=("window_start", "window_end", "vehicle_id"),
    ),
}
