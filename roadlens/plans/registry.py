"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle per inventory item. Keys follow the inventory IDs.

Every callable takes (spark, sf_dir), reads the driver's tables through the
telemetry view and returns a DataFrame with zone-free timestamps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.time import to_ntz
from roadlens.plans import tables
from roadlens.plans.oracle import bucket, rnd, with_ctes
from roadlens.operators import windows as W

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_ntz(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------
# W1-W5
# ---------------------------------------------------------------------------

W1_SQL = with_ctes(
    f"""
SELECT {bucket('"timestamp"', 60)} AS window_start,
       {bucket('"timestamp"', 60)} + INTERVAL 1 MINUTE AS window_end,
       vehicle_id,
       {rnd('avg(speed_ms)', 3)} AS avg_speed_ms,
       {rnd('max(speed_ms)', 3)} AS max_speed_ms,
       {rnd('min(speed_ms)', 3)} AS min_speed_ms,
       {rnd('stddev_samp(speed_ms)', 4)} AS speed_stddev,
       count(*) AS event_count
FROM gps_events GROUP BY 1, 2, 3""",
    "gps_events",
)


def summary_of(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window summary over readings of which only its own columns are decoded."""
    summary = W.SUMMARIES[key]
    return W.summarise(tables.processed(spark, sf_dir, summary.sensor, columns=summary.reads), summary)


@register("w1_speed_summary", W1_SQL)
def w1_speed_summary(spark, sf_dir):
    """W1 over processed gps readings."""
    return summary_of("w1", spark, sf_dir)


W2_SQL = with_ctes(
    f"""
SELECT {bucket('"timestamp"', 300)} AS window_start, vehicle_id,
       count(*) AS hard_brake_count,
       {rnd('max(brake_pressure_pct)', 2)} AS max_brake_pressure_pct
FROM can_bus_events WHERE hard_braking GROUP BY 1, 2""",
    "can_bus_events",
)


@register("w2_hard_braking", W2_SQL)
def w2_hard_braking(spark, sf_dir):
    """W2 over processed can_bus readings."""
    return summary_of("w2", spark, sf_dir)


W3_SQL = with_ctes(
    f"""
SELECT {bucket('"timestamp"', 300)} AS window_start, vehicle_id,
       {rnd('avg(engine_temp_celsius)', 2)} AS avg_engine_temp,
       {rnd('max(engine_temp_celsius)', 2)} AS max_engine_temp,
       {rnd('avg(oil_pressure_kpa)', 2)} AS avg_oil_pressure,
       {rnd('min(battery_voltage)', 3)} AS min_battery_voltage,
       CAST(sum(CAST(engine_overheating AS INTEGER)) AS BIGINT) AS overheating_events
FROM can_bus_events GROUP BY 1, 2""",
    "can_bus_events",
)


@register("w3_engine_health", W3_SQL)
def w3_engine_health(spark, sf_dir):
    """W3 over processed can_bus readings."""
    return summary_of("w3", spark, sf_dir)


W4_SQL = with_ctes(
    f"""
SELECT {bucket('"timestamp"', 60)} AS window_start, vehicle_id,
       {rnd('avg(accel_magnitude)', 4)} AS avg_accel_magnitude,
       {rnd('max(accel_magnitude)', 4)} AS max_accel_magnitude,
       {rnd('avg(gyro_magnitude)', 5)} AS avg_gyro_magnitude,
       {rnd('stddev_samp(lateral_g)', 4)} AS lateral_g_stddev,
       count(*) AS sample_count
FROM imu_events GROUP BY 1, 2""",
    "imu_events",
)


@register("w4_imu_vibration", W4_SQL)
def w4_imu_vibration(spark, sf_dir):
    """W4 over processed imu readings."""
    return summary_of("w4", spark, sf_dir)


W5_SQL = with_ctes(
    f"""
SELECT {bucket('"timestamp"', 60)} AS window_start, sensor_type,
       count(*) AS event_count, count(DISTINCT vehicle_id) AS active_vehicles
FROM (SELECT "timestamp", sensor_type, vehicle_id FROM gps_events
      UNION ALL SELECT "timestamp", sensor_type, vehicle_id FROM imu_events
      UNION ALL SELECT "timestamp", sensor_type, vehicle_id FROM can_bus_events) u
GROUP BY 1, 2""",
    "gps_events", "imu_events", "can_bus_events",
)


def all_processed(spark, sf_dir, cols=("timestamp", "sensor_type", "vehicle_id", "event_id")):
    parts = [tables.processed(spark, sf_dir, s, columns=cols) for s in ("gps", "imu", "can_bus")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("w5_throughput", W5_SQL)
def w5_throughput(spark, sf_dir):
    """W5 over the union of processed gps, imu and can_bus readings."""
    return W.fleet_throughput(all_processed(spark, sf_dir), "1 minute")


def _hours(by: str) -> str:
    return with_ctes(
        f"""
SELECT {bucket('"timestamp"', 3600)} AS window_start{by},
       count(*) AS event_count, count(DISTINCT vehicle_id) AS active_vehicles, true AS sketch_within_bound
FROM (SELECT "timestamp", sensor_type, vehicle_id FROM gps_events
      UNION ALL SELECT "timestamp", sensor_type, vehicle_id FROM imu_events
      UNION ALL SELECT "timestamp", sensor_type, vehicle_id FROM can_bus_events) u
GROUP BY ALL""",
        "gps_events", "imu_events", "can_bus_events",
    )


W5_HOURS_SQL = _hours(", sensor_type")
W5_FLEET_HOURS_SQL = _hours("")


def beside_exact(sketches: DataFrame, readings: DataFrame, *by: str) -> DataFrame:
    """Hours merged from sketched minutes, beside the exact distinct counts."""
    merged = W.merge_sketches(sketches, "1 hour", *by).withColumnRenamed("active_vehicles", "sketched")
    hour = F.window("timestamp", "1 hour")["start"].alias("window_start")
    exact = readings.groupBy(hour, *by).agg(F.count_distinct("vehicle_id").alias("active_vehicles"))
    off = F.abs(F.col("sketched") - F.col("active_vehicles"))
    return merged.join(exact, ["window_start", *by]).select(
        "window_start", *by, "event_count", "active_vehicles",
        (off <= F.lit(W.SKETCH_BOUND) * F.col("active_vehicles")).alias("sketch_within_bound"))


@register("w5_sketched_hours", W5_HOURS_SQL)
def w5_sketched_hours(spark, sf_dir):
    """W5's minutes as sketches, merged to hours per sensor type."""
    readings = all_processed(spark, sf_dir)
    return beside_exact(W.throughput_sketches(readings), readings, "sensor_type")


@register("w5_sketched_fleet_hours", W5_FLEET_HOURS_SQL)
def w5_sketched_fleet_hours(spark, sf_dir):
    """The same over all sensor types: a vehicle seen by several counts once."""
    readings = all_processed(spark, sf_dir)
    return beside_exact(W.throughput_sketches(readings), readings)
