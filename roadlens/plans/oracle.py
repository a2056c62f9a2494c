"""DuckDB SQL for every registered query (the independent check).

Each query is written as plain SQL over the pre-registered ``events`` view,
with the telemetry view spelled as CTEs. Rounded aggregates use the same
half-up-through-decimal rule as the Spark side.
"""

from __future__ import annotations

from roadlens.plans.telemetry_view import (
    DUP_EVERY,
    MALFORMED_EVERY,
    duck_readings_cte,
)


def rnd(expr: str, n: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def bucket(ts: str, seconds: int) -> str:
    w = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {w}) * {w})"


def _time_parts(ts: str = "timestamp", with_hour: bool = True) -> str:
    parts = [
        f"CAST(year({ts}) AS INTEGER) AS year",
        f"CAST(month({ts}) AS INTEGER) AS month",
        f"CAST(day({ts}) AS INTEGER) AS day",
    ]
    if with_hour:
        parts.append(f"CAST(hour({ts}) AS INTEGER) AS hour")
    return ", ".join(parts)


# CTE bodies by name. Processed tables keep all decoded columns plus
# enrichment and time parts, like the Spark side.
CTES: dict[str, str] = {
    "gps_raw": duck_readings_cte("gps"),
    "imu_raw": duck_readings_cte("imu"),
    "can_raw": duck_readings_cte("can_bus"),
    "lidar_raw": duck_readings_cte("lidar"),
    "camera_raw": duck_readings_cte("camera"),
    "system_raw": duck_readings_cte("system_health"),
    "gps_events": (
        "SELECT *, round(speed_ms * 3.6, 2) AS speed_kmh, speed_ms > 0.5 AS is_moving, "
        "epoch_ms(ingested_at) - epoch_ms(\"timestamp\") AS processing_lag_ms, "
        f"{_time_parts()} FROM gps_raw "
        "WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND speed_ms >= 0"
    ),
    "imu_enriched": (
        "SELECT *, round(sqrt(accel_x * accel_x + accel_y * accel_y + accel_z * accel_z), 4) "
        "AS accel_magnitude, round(accel_y / 9.81, 4) AS lateral_g, "
        "round(accel_x / 9.81, 4) AS longitudinal_g, "
        "round(sqrt(gyro_x * gyro_x + gyro_y * gyro_y + gyro_z * gyro_z), 5) AS gyro_magnitude "
        "FROM imu_raw"
    ),
    "imu_events": f"SELECT *, {_time_parts()} FROM imu_enriched WHERE accel_magnitude < 100",
    "can_bus_events": (
        "SELECT *, round(speed_ms * 3.6, 2) AS speed_kmh, "
        "brake_pressure_pct > 70.0 AS hard_braking, "
        "engine_temp_celsius > 105.0 AS engine_overheating, "
        "battery_voltage < 11.9 AS low_battery, brake_wear_pct > 80.0 AS high_wear_brakes, "
        f"{_time_parts()} FROM can_raw "
        "WHERE engine_rpm BETWEEN 0 AND 8000 AND engine_temp_celsius BETWEEN -40 AND 200"
    ),
}

DEPS = {
    "gps_events": ["gps_raw"],
    "imu_enriched": ["imu_raw"],
    "imu_events": ["imu_enriched"],
    "can_bus_events": ["can_raw"],
}


def with_ctes(sql: str, *names: str, extra: dict[str, str] | None = None,
              recursive: bool = False) -> str:
    """Prefix ``sql`` with the named CTEs (and their dependencies, in order)."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    bodies = [f"{n} AS ({CTES[n]})" for n in order]
    for k, v in (extra or {}).items():
        bodies.append(f"{k} AS ({v})")
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(bodies) + "\n" + sql


__all__ = ["CTES", "with_ctes", "rnd", "bucket", "DUP_EVERY", "MALFORMED_EVERY"]


CTES["can_scored"] = (
    "SELECT *, -(0.25 + CAST((sequence_number * 13) % 512 AS DOUBLE) / 1024) AS anomaly_score "
    "FROM can_bus_events"
)
DEPS["can_scored"] = ["can_bus_events"]
CTES["anomaly_detections"] = (
    "SELECT event_id, vehicle_id, \"timestamp\", sensor_type, anomaly_score, "
    "to_json({'speed_ms': speed_ms, 'steering_angle_deg': steering_angle_deg, "
    "'brake_pressure_pct': brake_pressure_pct, 'engine_temp_celsius': engine_temp_celsius}) AS features, "
    "ingested_at AS detected_at FROM can_scored WHERE anomaly_score < -0.7"
)
DEPS["anomaly_detections"] = ["can_scored"]
CTES["snapshots"] = (
    "SELECT \"timestamp\" AS ts, vehicle_id, sensor_type, speed_ms, CAST(0 AS DOUBLE) AS accel_magnitude, "
    "CAST(0 AS DOUBLE) AS engine_temp, CAST(NULL AS DOUBLE) AS anomaly_score, false AS is_anomaly, "
    "latitude AS lat, longitude AS lon, event_id FROM gps_events "
    "UNION ALL SELECT \"timestamp\", vehicle_id, sensor_type, CAST(0 AS DOUBLE), accel_magnitude, "
    "CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE), false, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), event_id "
    "FROM imu_events "
    "UNION ALL SELECT \"timestamp\", vehicle_id, sensor_type, speed_ms, CAST(0 AS DOUBLE), "
    "engine_temp_celsius, anomaly_score, anomaly_score < -0.7, CAST(NULL AS DOUBLE), "
    "CAST(NULL AS DOUBLE), event_id FROM can_scored"
)
DEPS["snapshots"] = ["gps_events", "imu_events", "can_scored"]


def dupes(cte: str) -> str:
    """Rows of a clean readings CTE plus the second delivery of every
    DUP_EVERY-th event (offset + 1)."""
    return (
        f"SELECT * FROM {cte} UNION ALL "
        f"SELECT * REPLACE (\"offset\" + 1 AS \"offset\") FROM {cte} "
        f"WHERE sequence_number % {DUP_EVERY} = 0"
    )
