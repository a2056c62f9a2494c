"""Registered serving queries G1-G21 (dashboard window 15 minutes unless the
query has its own look-back)."""

from __future__ import annotations

from roadlens.operators import serving as G
from roadlens.plans import tables
from roadlens.plans.oracle import rnd, with_ctes
from roadlens.plans.registry import register
from roadlens.plans.telemetry_view import duck_readings_cte

WIN = 15
FOCUS = "ZX-007"


def since(table: str, seconds: int, col: str = '"timestamp"') -> str:
    return f"{col} >= (SELECT max({col}) FROM {table}) - INTERVAL {seconds} SECOND"


def reg(name, sql, *ctes):
    return register(name, with_ctes(sql, *ctes))


reg("g1_active_vehicles",
    "SELECT vehicle_id, max(\"timestamp\") AS last_seen, avg(speed_ms) AS avg_speed_ms, "
    f"max(speed_ms) AS max_speed_ms FROM gps_events WHERE {since('gps_events', 300)} GROUP BY 1",
    "gps_events")(lambda spark, sf: G.active_vehicles(tables.gps_store(spark, sf), 5))

reg("g2_recent_anomalies",
    "SELECT vehicle_id, \"timestamp\", sensor_type, anomaly_score, features FROM anomaly_detections "
    "ORDER BY detected_at DESC, event_id DESC LIMIT 50",
    "anomaly_detections")(lambda spark, sf: G.recent_anomalies(tables.anomaly_detections(spark, sf), 50))

reg("g3_speed_timeseries",
    "SELECT \"timestamp\", speed_ms, speed_kmh, heading_deg FROM gps_events "
    f"WHERE vehicle_id = '{FOCUS}' AND {since('gps_events', 3600)}",
    "gps_events")(lambda spark, sf: G.speed_timeseries(tables.gps_store(spark, sf), FOCUS, 1))

reg("g4_engine_health",
    "SELECT vehicle_id, \"timestamp\", engine_temp_celsius, oil_pressure_kpa, battery_voltage, "
    "brake_wear_pct, engine_overheating, low_battery FROM can_bus_events "
    f"WHERE {since('can_bus_events', 6 * 3600)} "
    "AND (engine_overheating OR low_battery OR brake_wear_pct > 80)",
    "can_bus_events")(lambda spark, sf: G.engine_health(tables.can_store(spark, sf), 6))

reg("g5_throughput_last_hour",
    "SELECT date_trunc('minute', \"timestamp\") AS minute, count(*) AS event_count, "
    f"count(DISTINCT vehicle_id) AS active_vehicles FROM gps_events WHERE {since('gps_events', 3600)} "
    "GROUP BY 1",
    "gps_events")(lambda spark, sf: G.throughput_last_hour(tables.gps_store(spark, sf)))

reg("g6_kpi_active_vehicles",
    f"SELECT count(DISTINCT vehicle_id) AS cnt FROM gps_events WHERE {since('gps_events', WIN * 60)}",
    "gps_events")(lambda spark, sf: G.kpi_active_vehicles(tables.gps_store(spark, sf), WIN))

reg("g7_kpi_anomaly_count",
    f"SELECT count(*) AS cnt FROM anomaly_detections WHERE {since('anomaly_detections', WIN * 60, 'detected_at')}",
    "anomaly_detections")(lambda spark, sf: G.kpi_anomaly_count(tables.anomaly_detections(spark, sf), WIN))

reg("g8_kpi_fleet_speed",
    f"SELECT {rnd('avg(speed_ms) * 3.6', 1)} AS avg_kmh FROM gps_events WHERE {since('gps_events', WIN * 60)}",
    "gps_events")(lambda spark, sf: G.kpi_fleet_speed(tables.gps_store(spark, sf), WIN))

reg("g9_kpi_overheating",
    "SELECT count(DISTINCT vehicle_id) AS cnt FROM can_bus_events WHERE engine_overheating "
    f"AND {since('can_bus_events', WIN * 60)}",
    "can_bus_events")(lambda spark, sf: G.kpi_overheating(tables.can_store(spark, sf), WIN))

reg("g10_kpi_events",
    f"SELECT count(*) AS cnt FROM gps_events WHERE {since('gps_events', WIN * 60)}",
    "gps_events")(lambda spark, sf: G.kpi_events(tables.gps_store(spark, sf), WIN))

reg("g11_last_locations",
    "SELECT vehicle_id, last(latitude ORDER BY \"timestamp\", sequence_number) AS lat, "
    "last(longitude ORDER BY \"timestamp\", sequence_number) AS lon, "
    "last(speed_ms ORDER BY \"timestamp\", sequence_number) * 3.6 AS speed_kmh "
    f"FROM gps_events WHERE {since('gps_events', WIN * 60)} GROUP BY 1",
    "gps_events")(lambda spark, sf: G.last_locations(tables.gps_store(spark, sf), WIN))

reg("g12_speed_per_minute",
    "SELECT date_trunc('minute', \"timestamp\") AS minute, vehicle_id, avg(speed_ms) * 3.6 AS avg_speed_kmh "
    f"FROM gps_events WHERE {since('gps_events', WIN * 60)} GROUP BY 1, 2",
    "gps_events")(lambda spark, sf: G.speed_per_minute(tables.gps_store(spark, sf), WIN))

reg("g12_speed_per_minute_focus",
    "SELECT date_trunc('minute', \"timestamp\") AS minute, vehicle_id, avg(speed_ms) * 3.6 AS avg_speed_kmh "
    f"FROM gps_events WHERE {since('gps_events', WIN * 60)} AND vehicle_id = '{FOCUS}' GROUP BY 1, 2",
    "gps_events")(lambda spark, sf: G.speed_per_minute(tables.gps_store(spark, sf), WIN, FOCUS))

reg("g13_engine_temp_per_minute",
    "SELECT date_trunc('minute', \"timestamp\") AS minute, vehicle_id, avg(engine_temp_celsius) AS avg_temp, "
    f"max(engine_temp_celsius) AS max_temp FROM can_bus_events WHERE {since('can_bus_events', WIN * 60)} "
    "GROUP BY 1, 2",
    "can_bus_events")(lambda spark, sf: G.engine_temp_per_minute(tables.can_store(spark, sf), WIN))

reg("g14_anomaly_history",
    "SELECT \"timestamp\", vehicle_id, sensor_type, anomaly_score, features FROM anomaly_detections "
    f"WHERE {since('anomaly_detections', WIN * 60, 'detected_at')} "
    "ORDER BY \"timestamp\" DESC, event_id DESC LIMIT 200",
    "anomaly_detections")(lambda spark, sf: G.anomaly_history(tables.anomaly_detections(spark, sf), WIN, 200))

reg("g15_hard_brake_leaderboard",
    "SELECT vehicle_id, count(*) AS hard_brake_count, max(brake_pressure_pct) AS max_pressure "
    f"FROM can_bus_events WHERE hard_braking AND {since('can_bus_events', WIN * 60)} GROUP BY 1",
    "can_bus_events")(lambda spark, sf: G.hard_brake_leaderboard(tables.can_store(spark, sf), WIN))

reg("g16_events_per_minute",
    "SELECT date_trunc('minute', \"timestamp\") AS minute, count(*) AS events FROM gps_events "
    f"WHERE {since('gps_events', WIN * 60)} GROUP BY 1",
    "gps_events")(lambda spark, sf: G.events_per_minute(tables.gps_store(spark, sf), WIN))

_DECODED_SQL = " UNION ALL ".join(
    f"SELECT vehicle_id, sensor_type FROM ({dup})"
    for dup in [
        "SELECT * FROM gps_raw UNION ALL SELECT * FROM gps_raw WHERE sequence_number % 50 = 0",
        "SELECT * FROM imu_raw UNION ALL SELECT * FROM imu_raw WHERE sequence_number % 50 = 0",
        "SELECT * FROM can_raw UNION ALL SELECT * FROM can_raw WHERE sequence_number % 50 = 0",
    ]
)


def _decoded(spark, sf):
    parts = [tables.parsed(spark, sf, s).select("vehicle_id", "sensor_type") for s in ("gps", "imu", "can_bus")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register("g17_events_received", with_ctes(
    "SELECT vehicle_id, sensor_type, count(*) AS events_received FROM d GROUP BY 1, 2",
    "gps_raw", "imu_raw", "can_raw", extra={"d": _DECODED_SQL},
))(lambda spark, sf: G.events_received(_decoded(spark, sf)))


def _processed_all(spark, sf, cols):
    """Processed readings of the three main sensors, from the stored tables."""
    parts = [tables.store(spark, sf, s).select(*cols) for s in ("gps", "imu", "can_bus")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


reg("g17_events_processed",
    "SELECT sensor_type, count(*) AS events_processed FROM (SELECT sensor_type FROM gps_events "
    "UNION ALL SELECT sensor_type FROM imu_events UNION ALL SELECT sensor_type FROM can_bus_events) GROUP BY 1",
    "gps_events", "imu_events", "can_bus_events",
    )(lambda spark, sf: G.events_processed(_processed_all(spark, sf, ["sensor_type"])))

reg("g18_anomalies_by_vehicle",
    "SELECT vehicle_id, count(*) AS anomalies FROM anomaly_detections GROUP BY 1",
    "anomaly_detections")(lambda spark, sf: G.anomalies_by_vehicle(tables.anomaly_detections(spark, sf).rows))

reg("g18_active_recent",
    f"SELECT DISTINCT vehicle_id FROM snapshots WHERE {since('snapshots', 300, 'ts')}",
    "snapshots")(lambda spark, sf: G.recent_vehicle_ids(tables.snapshots(spark, sf), 300))

_BUCKETS = [("0.1", 100000), ("0.5", 500000), ("1", 1000000), ("2", 2000000), ("5", 5000000),
            ("10", 10000000), ("30", 30000000), ("60", 60000000)]
_LAG = "(epoch_us(ingested_at) - epoch_us(\"timestamp\"))"
_HIST = " UNION ALL ".join(
    [f"SELECT sensor_type, '{lab}' AS le, count(*) FILTER (WHERE {_LAG} <= {us}) AS bucket_count, "
     f"count(*) AS lag_count, CAST(sum({_LAG}) AS DOUBLE) / 1000000 AS lag_sum_seconds FROM r GROUP BY 1"
     for lab, us in _BUCKETS]
    + [f"SELECT sensor_type, '+Inf', count(*), count(*), CAST(sum({_LAG}) AS DOUBLE) / 1000000 FROM r GROUP BY 1"]
)

register("g19_lag_histogram", with_ctes(
    _HIST, "gps_events", "imu_events", "can_bus_events",
    extra={"r": "SELECT sensor_type, \"timestamp\", ingested_at FROM gps_events UNION ALL "
                "SELECT sensor_type, \"timestamp\", ingested_at FROM imu_events UNION ALL "
                "SELECT sensor_type, \"timestamp\", ingested_at FROM can_bus_events"},
))(lambda spark, sf: G.lag_histogram(_processed_all(spark, sf, ["sensor_type", "timestamp", "ingested_at"])))

_MSGS = {
    f"{s}_m": duck_readings_cte(s, clean=False)
    for s in ("gps", "imu", "can_bus", "lidar", "camera", "system_health")
}
register("g20_consumer_progress", with_ctes(
    "SELECT topic, \"partition\", min(\"offset\") AS min_offset, max(\"offset\") AS max_offset, "
    "count(*) AS messages FROM (" + " UNION ALL ".join(
        f"SELECT topic, \"partition\", \"offset\" FROM {k} UNION ALL "
        f"SELECT topic, \"partition\", \"offset\" + 1 FROM {k} WHERE sequence_number % 50 = 0" for k in _MSGS
    ) + ") GROUP BY 1, 2",
    extra=_MSGS,
))(lambda spark, sf: G.consumer_progress(tables.messages(spark, sf)))

reg("g21_recent_snapshots",
    "SELECT * FROM snapshots ORDER BY ts DESC, event_id DESC LIMIT 1000",
    "snapshots")(lambda spark, sf: G.latest(tables.snapshots(spark, sf), 1000))

reg("g21_recent_vehicles",
    f"SELECT DISTINCT vehicle_id FROM snapshots WHERE {since('snapshots', 300, 'ts')}",
    "snapshots")(lambda spark, sf: G.recent_vehicle_ids(tables.snapshots(spark, sf), 300))
