"""Registered feature queries F1-F3."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.operators import features as FT
from roadlens.plans import tables
from roadlens.plans.oracle import with_ctes
from roadlens.plans.registry import register

# The view compresses time 720x: one hour of data stands for 30 days, so the
# 24-hour maintenance horizon becomes 120 s and the trailing hour 5 s.
ROLLING_US = 5_000_000
HORIZON_US = 120_000_000

register(
    "f1_rolling_features",
    with_ctes(
        "SELECT event_id, vehicle_id, \"timestamp\", "
        "avg(speed_ms) OVER w AS avg_speed_ms_1h, "
        "CAST(coalesce(sum(CAST(hard_braking AS INTEGER)) OVER w, 0) AS BIGINT) AS hard_brake_count_1h, "
        "CAST(coalesce(sum(CAST(engine_overheating AS INTEGER)) OVER w, 0) AS BIGINT) AS engine_overheating_count_1h "
        "FROM can_bus_events WINDOW w AS (PARTITION BY vehicle_id ORDER BY epoch_us(\"timestamp\") "
        f"RANGE BETWEEN {ROLLING_US} PRECEDING AND CURRENT ROW)",
        "can_bus_events",
    ),
)(lambda spark, sf: FT.rolling_features(tables.can_bus_events(spark, sf), ROLLING_US))

register(
    "f1_rolling_features_hour",
    with_ctes(
        "SELECT event_id, vehicle_id, \"timestamp\", "
        "avg(speed_ms) OVER w AS avg_speed_ms_1h, "
        "CAST(coalesce(sum(CAST(hard_braking AS INTEGER)) OVER w, 0) AS BIGINT) AS hard_brake_count_1h, "
        "CAST(coalesce(sum(CAST(engine_overheating AS INTEGER)) OVER w, 0) AS BIGINT) AS engine_overheating_count_1h "
        "FROM can_bus_events WINDOW w AS (PARTITION BY vehicle_id ORDER BY \"timestamp\" "
        "RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)",
        "can_bus_events",
    ),
)(lambda spark, sf: FT.rolling_features(tables.can_bus_events(spark, sf)))

register(
    "f2_align_imu",
    with_ctes(
        "SELECT c.event_id, c.vehicle_id, c.\"timestamp\", "
        "CASE WHEN epoch_us(c.\"timestamp\") - epoch_us(i.\"timestamp\") <= 1000000 THEN i.accel_magnitude END "
        "AS accel_magnitude, "
        "CASE WHEN epoch_us(c.\"timestamp\") - epoch_us(i.\"timestamp\") <= 1000000 THEN i.\"timestamp\" END "
        "AS imu_timestamp "
        "FROM can_bus_events c ASOF LEFT JOIN imu_events i "
        "ON c.vehicle_id = i.vehicle_id AND c.\"timestamp\" >= i.\"timestamp\"",
        "can_bus_events", "imu_events",
    ),
)(lambda spark, sf: FT.align_imu(tables.can_bus_events(spark, sf), tables.imu_events(spark, sf)))


def maintenance_log(spark, sf):
    """Maintenance events derived from system-health readings (3 errors in a minute)."""
    sh = tables.processed(spark, sf, "system_health", columns=("vehicle_id", "timestamp", "error_count_last_minute"))
    return sh.filter(F.col("error_count_last_minute") == 3).select("vehicle_id", "timestamp")


register(
    "f3_label",
    with_ctes(
        "SELECT c.event_id, c.vehicle_id, c.\"timestamp\", "
        "(SELECT min(m.\"timestamp\") FROM m WHERE m.vehicle_id = c.vehicle_id AND m.\"timestamp\" > c.\"timestamp\" "
        f"AND epoch_us(m.\"timestamp\") - epoch_us(c.\"timestamp\") <= {HORIZON_US}) AS next_maintenance, "
        "EXISTS (SELECT 1 FROM m WHERE m.vehicle_id = c.vehicle_id AND m.\"timestamp\" > c.\"timestamp\" "
        f"AND epoch_us(m.\"timestamp\") - epoch_us(c.\"timestamp\") <= {HORIZON_US}) AS needs_maintenance_24h "
        "FROM can_bus_events c",
        "can_bus_events", "system_raw",
        extra={"m": "SELECT vehicle_id, \"timestamp\" FROM system_raw WHERE error_count_last_minute = 3"},
    ),
)(lambda spark, sf: FT.maintenance_labels(tables.can_bus_events(spark, sf), maintenance_log(spark, sf), HORIZON_US))
