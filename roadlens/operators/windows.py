"""Tumbling-window summaries: W1-W5 (batch and streaming, same functions).

W1-W4 are declared as ``Summary`` records: a window length, the measures with
their rounding, and an optional row filter. ``summarise`` turns a record into
one grouped aggregate, and ``Summary.reads`` names the columns it needs, so a
reader can prune to them. Summaries never call ``withWatermark`` (R1: it is set
once upstream). All are partial + final aggregates, so a hot vehicle is
combined on the map side. Rounded measures go through ``round_half_up``, whose
results don't depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.numeric import round_half_up


@dataclass(frozen=True)
class Measure:
    """An output column: ``how`` over ``of``, rounded to ``digits`` places.
    Without ``of`` it counts rows; without ``digits`` it stays as it is."""

    name: str
    how: Callable[[str], Column]
    of: str | None = None
    digits: int | None = None

    def aggregate(self) -> Column:
        value = self.how(self.of) if self.of else F.count(F.lit(1))
        return value.alias(self.name)

    def shown(self) -> Column:
        return F.col(self.name) if self.digits is None else round_half_up(self.name, self.digits).alias(self.name)


def rows(name: str) -> Measure:
    return Measure(name, F.count)


def true_rows(flag: str) -> Column:
    return F.count_if(F.col(flag)).cast("long")


@dataclass(frozen=True)
class Summary:
    sensor: str
    window: str
    measures: tuple[Measure, ...]
    only: str | None = None
    with_end: bool = False

    @property
    def reads(self) -> tuple[str, ...]:
        """The columns that the summary reads."""
        wanted = ["timestamp", "vehicle_id", *(m.of for m in self.measures if m.of), *([self.only] if self.only else [])]
        return tuple(dict.fromkeys(wanted))


#: Measure names, rounding and window lengths.
SUMMARIES = {
    "w1": Summary("gps", "1 minute", (
        Measure("avg_speed_ms", F.avg, "speed_ms", 3), Measure("max_speed_ms", F.max, "speed_ms", 3),
        Measure("min_speed_ms", F.min, "speed_ms", 3), Measure("speed_stddev", F.stddev_samp, "speed_ms", 4),
        rows("event_count")), with_end=True),
    "w2": Summary("can_bus", "5 minutes", (
        rows("hard_brake_count"), Measure("max_brake_pressure_pct", F.max, "brake_pressure_pct", 2)),
        only="hard_braking"),
    "w3": Summary("can_bus", "5 minutes", (
        Measure("avg_engine_temp", F.avg, "engine_temp_celsius", 2),
        Measure("max_engine_temp", F.max, "engine_temp_celsius", 2),
        Measure("avg_oil_pressure", F.avg, "oil_pressure_kpa", 2),
        Measure("min_battery_voltage", F.min, "battery_voltage", 3),
        Measure("overheating_events", true_rows, "engine_overheating"))),
    "w4": Summary("imu", "1 minute", (
        Measure("avg_accel_magnitude", F.avg, "accel_magnitude", 4),
        Measure("max_accel_magnitude", F.max, "accel_magnitude", 4),
        Measure("avg_gyro_magnitude", F.avg, "gyro_magnitude", 5),
        Measure("lateral_g_stddev", F.stddev_samp, "lateral_g", 4), rows("sample_count"))),
}


def summarise(readings: DataFrame, summary: Summary, window: str | None = None) -> DataFrame:
    """``summary`` per vehicle and tumbling window of ``readings``."""
    picked = readings.filter(F.col(summary.only)) if summary.only else readings
    if not picked.isStreaming:  # a stream's watermark column must stay as it is
        picked = picked.select(*summary.reads)
    grouped = picked.groupBy(F.window("timestamp", window or summary.window).alias("w"), "vehicle_id")
    bounds = [F.col("w.start").alias("window_start"), *([F.col("w.end").alias("window_end")] if summary.with_end else [])]
    return grouped.agg(*(m.aggregate() for m in summary.measures)).select(
        *bounds, "vehicle_id", *(m.shown() for m in summary.measures))


def window_summary(key: str, readings: DataFrame, window: str | None = None) -> DataFrame:
    """The W1-W4 summary of ``key`` (w1 ... w4)."""
    return summarise(readings, SUMMARIES[key], window)


def fleet_throughput(df: DataFrame, window_duration: str = "1 minute") -> DataFrame:
    """Events and distinct vehicles per sensor type and window.

    Written as two chained aggregates (window, sensor, vehicle) -> (window,
    sensor): exact, shuffles only pre-aggregated rows, and the same plan runs
    on a stream in append mode (a distinct aggregate does not).
    """
    per_vehicle = df.groupBy(F.window("timestamp", window_duration).alias("window"), "sensor_type", "vehicle_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        per_vehicle.groupBy("window", "sensor_type")
        .agg(
            F.sum("n").cast("long").alias("event_count"),
            F.count(F.lit(1)).alias("active_vehicles"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "sensor_type",
            "event_count",
            "active_vehicles",
        )
    )


# Distinct counts that merge (opt-in beside the exact ones): 2^LOG_K registers
# give a relative standard error of 1.04 / sqrt(2^LOG_K), three of which are
# the stated bound.
LOG_K = 12
SKETCH_BOUND = 3 * 1.04 / 2 ** (LOG_K / 2)


def throughput_sketches(readings: DataFrame, window_duration: str = "1 minute") -> DataFrame:
    """W5 as mergeable rows: per window and sensor type the events and a sketch
    of the vehicles, one aggregate on batches and streams."""
    grouped = readings.groupBy(F.window("timestamp", window_duration).alias("w"), "sensor_type")
    return grouped.agg(
        F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg("vehicle_id", LOG_K).alias("vehicles"),
    ).select(F.col("w.start").alias("window_start"), "sensor_type", "event_count", "vehicles")


def merge_sketches(sketches: DataFrame, window_duration: str, *by: str) -> DataFrame:
    """Sketched windows merged into longer ones, per ``by``, without the raw
    rows; ``active_vehicles`` is within ``SKETCH_BOUND`` of the distinct count."""
    grouped = sketches.groupBy(F.window("window_start", window_duration).alias("w"), *by)
    return grouped.agg(
        F.sum("event_count").alias("event_count"), F.hll_union_agg("vehicles").alias("vehicles"),
    ).select(F.col("w.start").alias("window_start"), *by, "event_count", "vehicles",
             F.hll_sketch_estimate("vehicles").alias("active_vehicles"))


#: key -> (sensor, function of the readings, window length)
WINDOW_SUMMARIES = {key: (s.sensor, partial(window_summary, key), s.window) for key, s in SUMMARIES.items()}
