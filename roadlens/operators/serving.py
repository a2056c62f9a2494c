"""Serving queries G1-G21 as DataFrame functions.

Look-back windows (T7) are anchored at ``as_of``; by default the newest event
time of the input, as a scalar subquery: over the zone map of a stored table,
over the rows of any other frame. The optional focus
vehicle (T8) is a bound literal, never spliced into SQL text. Every top-k
orders by a unique tie-break so that the limit is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.numeric import round_half_up
from roadlens.functions.time import lookback_start, minute_bucket
from roadlens.sources.store import Timed, day_key

# Dashboard look-back choices (minutes) and bucket bounds (s).
WINDOW_CHOICES_MIN = (5, 15, 60, 360)
LAG_BUCKETS_S = (0.1, 0.5, 1, 2, 5, 10, 30, 60)


def recent(df: DataFrame | Timed, seconds: int, ts_col: str = "timestamp", as_of=None) -> DataFrame:
    """Rows with ``ts_col >= as_of - seconds``.

    Of a stored table with a zone map (``Timed``) the newest time comes from
    the map, and so does the first day that can hold such rows, whichever time
    column is asked for: the table itself is only read from that day on.

    Of a plain frame the newest time is computed from its rows. A timestamp
    bound does not imply anything about the year/month/day partition columns of
    a Hive-partitioned table, so when they are present the implied day bound is
    added too: it only references partition columns and prunes folders at the
    scan (the bound itself is evaluated once).
    """
    if isinstance(df, Timed):
        start = lookback_start(df.zones, f"last_{ts_col}", seconds, as_of)
        first_day = df.zones.filter(F.col(f"last_{ts_col}") >= start).agg(F.min(day_key())).scalar()
        return df.rows.filter((F.col(ts_col) >= start) & (day_key() >= first_day))
    start = lookback_start(df, ts_col, seconds, as_of)
    out = df.filter(F.col(ts_col) >= start)
    if ts_col == "timestamp" and {"year", "month", "day"} <= set(df.columns):
        start_key = F.year(start) * 10000 + F.month(start) * 100 + F.dayofmonth(start)
        out = out.filter(day_key() >= start_key)
    return out


def newest(df: DataFrame | Timed, ts_col: str, n: int) -> DataFrame:
    """The rows that can be among the ``n`` newest by ``ts_col``: of a plain
    frame all; of a stored table those of the latest zones that hold ``n`` rows
    together, and of zones that reach into their span."""
    if not isinstance(df, Timed):
        return df
    last, first = f"last_{ts_col}", f"first_{ts_col}"
    # The zone map is small: a row per day and hour.
    running = Window.orderBy(F.desc(last), F.desc(first)).rowsBetween(Window.unboundedPreceding, -1)
    needed = (df.zones.filter(F.col(last).isNotNull())
              .withColumn("before", F.coalesce(F.sum("rows").over(running), F.lit(0))).filter(F.col("before") < n))
    start = needed.agg(F.min(first)).scalar()
    first_day = df.zones.filter(F.col(last) >= start).agg(F.min(day_key())).scalar()
    return df.rows.filter((F.col(ts_col) >= start) & (day_key() >= first_day))


def focus(df: DataFrame, vehicle: str | None) -> DataFrame:
    """Optional focus vehicle; None or "All" keeps every vehicle."""
    if vehicle is None or vehicle == "All":
        return df
    return df.filter(F.col("vehicle_id") == F.lit(vehicle))


def active_vehicles(gps: DataFrame | Timed, last_minutes: int = 5, as_of=None) -> DataFrame:
    """G1."""
    return (
        recent(gps, last_minutes * 60, as_of=as_of)
        .groupBy("vehicle_id")
        .agg(
            F.max("timestamp").alias("last_seen"),
            F.avg("speed_ms").alias("avg_speed_ms"),
            F.max("speed_ms").alias("max_speed_ms"),
        )
        .orderBy(F.desc("last_seen"), "vehicle_id")
    )


def recent_anomalies(anomalies: DataFrame | Timed, limit: int = 50) -> DataFrame:
    """Newest detections (top-k by detected_at, event_id breaks ties)."""
    found = newest(anomalies, "detected_at", limit)
    return found.orderBy(F.desc("detected_at"), F.desc("event_id")).limit(limit).select(
        "vehicle_id", "timestamp", "sensor_type", "anomaly_score", "features"
    )


def speed_timeseries(gps: DataFrame | Timed, vehicle_id: str, hours: int = 1, as_of=None) -> DataFrame:
    """G3."""
    return (
        focus(recent(gps, hours * 3600, as_of=as_of), vehicle_id)
        .select("timestamp", "speed_ms", "speed_kmh", "heading_deg")
        .orderBy("timestamp")
    )


def engine_health(can: DataFrame | Timed, hours: int = 6, as_of=None) -> DataFrame:
    """Engine-trouble rows (T9) of the last hours, newest first."""
    from roadlens.operators.validate import engine_trouble

    return (
        recent(can, hours * 3600, as_of=as_of)
        .filter(engine_trouble())
        .select(
            "vehicle_id", "timestamp", "engine_temp_celsius", "oil_pressure_kpa",
            "battery_voltage", "brake_wear_pct", "engine_overheating", "low_battery",
        )
        .orderBy(F.desc("timestamp"), "vehicle_id")
    )


def throughput_last_hour(gps: DataFrame | Timed, as_of=None) -> DataFrame:
    """Per minute, events and distinct vehicles over the last hour."""
    return (
        recent(gps, 3600, as_of=as_of)
        .groupBy(minute_bucket("timestamp").alias("minute"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("vehicle_id").alias("active_vehicles"),
        )
        .orderBy("minute")
    )


def kpi_active_vehicles(gps: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """G6."""
    return recent(gps, window_minutes * 60, as_of=as_of).agg(
        F.countDistinct("vehicle_id").alias("cnt")
    )


def kpi_anomaly_count(anomalies: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """Detections in the window (by detected_at)."""
    return recent(anomalies, window_minutes * 60, "detected_at", as_of).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def kpi_fleet_speed(gps: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """``round(avg(speed_ms) * 3.6, 1)``; null over no rows."""
    return recent(gps, window_minutes * 60, as_of=as_of).agg(
        round_half_up(F.avg("speed_ms") * 3.6, 1).alias("avg_kmh")
    )


def kpi_overheating(can: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """G9."""
    return (
        recent(can, window_minutes * 60, as_of=as_of)
        .filter(F.col("engine_overheating"))
        .agg(F.countDistinct("vehicle_id").alias("cnt"))
    )


def kpi_events(gps: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """G10."""
    return recent(gps, window_minutes * 60, as_of=as_of).agg(F.count(F.lit(1)).alias("cnt"))


def last_locations(gps: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """Newest position per vehicle (one aggregate, nulls kept)."""
    last = F.max_by(
        F.struct("latitude", "longitude", "speed_ms"),
        F.struct("timestamp", "sequence_number"),
    )
    return (
        recent(gps, window_minutes * 60, as_of=as_of)
        .groupBy("vehicle_id")
        .agg(last.alias("l"))
        .select(
            "vehicle_id",
            F.col("l.latitude").alias("lat"),
            F.col("l.longitude").alias("lon"),
            (F.col("l.speed_ms") * 3.6).alias("speed_kmh"),
        )
    )


def speed_per_minute(gps: DataFrame | Timed, window_minutes: int = 15, vehicle=None, as_of=None) -> DataFrame:
    """G12."""
    return (
        focus(recent(gps, window_minutes * 60, as_of=as_of), vehicle)
        .groupBy(minute_bucket("timestamp").alias("minute"), "vehicle_id")
        .agg((F.avg("speed_ms") * 3.6).alias("avg_speed_kmh"))
        .orderBy("minute", "vehicle_id")
    )


def engine_temp_per_minute(can: DataFrame | Timed, window_minutes: int = 15, vehicle=None, as_of=None) -> DataFrame:
    """G13."""
    return (
        focus(recent(can, window_minutes * 60, as_of=as_of), vehicle)
        .groupBy(minute_bucket("timestamp").alias("minute"), "vehicle_id")
        .agg(
            F.avg("engine_temp_celsius").alias("avg_temp"),
            F.max("engine_temp_celsius").alias("max_temp"),
        )
        .orderBy("minute", "vehicle_id")
    )


def anomaly_history(anomalies: DataFrame | Timed, window_minutes: int = 15, limit: int = 200, as_of=None) -> DataFrame:
    """Detections of the window, newest event time first, top ``limit``."""
    return (
        recent(anomalies, window_minutes * 60, "detected_at", as_of)
        .orderBy(F.desc("timestamp"), F.desc("event_id"))
        .limit(limit)
        .select("timestamp", "vehicle_id", "sensor_type", "anomaly_score", "features")
    )


def hard_brake_leaderboard(can: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """G15."""
    return (
        recent(can, window_minutes * 60, as_of=as_of)
        .filter(F.col("hard_braking"))
        .groupBy("vehicle_id")
        .agg(
            F.count(F.lit(1)).alias("hard_brake_count"),
            F.max("brake_pressure_pct").alias("max_pressure"),
        )
        .orderBy(F.desc("hard_brake_count"), "vehicle_id")
    )


def events_per_minute(gps: DataFrame | Timed, window_minutes: int = 15, as_of=None) -> DataFrame:
    """G16."""
    return (
        recent(gps, window_minutes * 60, as_of=as_of)
        .groupBy(minute_bucket("timestamp").alias("minute"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("minute")
    )


def events_received(decoded: DataFrame) -> DataFrame:
    """Decoded events by vehicle and sensor."""
    return decoded.groupBy("vehicle_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("events_received")
    )


def events_processed(processed: DataFrame) -> DataFrame:
    """Processed events by sensor."""
    return processed.groupBy("sensor_type").agg(F.count(F.lit(1)).alias("events_processed"))


def anomalies_by_vehicle(anomalies: DataFrame) -> DataFrame:
    """G18a."""
    return anomalies.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("anomalies"))


def recent_vehicle_ids(snap: DataFrame, last_seconds: int = 300, as_of=None) -> DataFrame:
    """Distinct vehicles seen in the last seconds."""
    return recent(snap, last_seconds, "ts", as_of).select("vehicle_id").distinct()


def lag_histogram(readings: DataFrame) -> DataFrame:
    """Cumulative processing-lag histogram per sensor.

    Lag is ``ingested_at - timestamp``. One pass computes every bucket with
    ``count_if``; ``stack`` turns the buckets into rows. The sum is taken in
    integer microseconds so it is exact in any order.
    """
    lag_us = F.unix_micros("ingested_at") - F.unix_micros("timestamp")
    aggs = [
        F.count_if(lag_us <= F.lit(int(b * 1_000_000))).alias(f"b{i}")
        for i, b in enumerate(LAG_BUCKETS_S)
    ]
    per = readings.groupBy("sensor_type").agg(
        *aggs,
        F.count(F.lit(1)).alias("lag_count"),
        F.sum(lag_us).alias("lag_sum_us"),
    )
    labels = [str(b) for b in LAG_BUCKETS_S] + ["+Inf"]
    stack_args = ", ".join(
        f"'{lab}', {'b' + str(i) if i < len(LAG_BUCKETS_S) else 'lag_count'}"
        for i, lab in enumerate(labels)
    )
    return per.select(
        "sensor_type",
        F.expr(f"stack({len(labels)}, {stack_args}) AS (le, bucket_count)"),
        "lag_count",
        (F.col("lag_sum_us") / 1_000_000).alias("lag_sum_seconds"),
    )


def consumer_progress(messages: DataFrame) -> DataFrame:
    """Per topic and partition, offset range and message count."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.count(F.lit(1)).alias("messages"),
    )


def latest(df: DataFrame, n: int, ts_col: str = "ts", tie: str = "event_id") -> DataFrame:
    """Newest ``n`` rows (top-k, unique tie-break)."""
    return df.orderBy(F.desc(ts_col), F.desc(tie)).limit(n)
