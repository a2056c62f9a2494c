"""Row-local enrichment: P2-P14. Every function maps a DataFrame to a DataFrame
and uses built-in expressions only (stays inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.numeric import magnitude

# Thresholds and unit factors.
KMH_PER_MS = 3.6
MOVING_MS = 0.5
G = 9.81
HARD_BRAKE_PCT = 70.0
OVERHEAT_C = 105.0
LOW_BATTERY_V = 11.9
HIGH_WEAR_PCT = 80.0
ANOMALY_SCORE_CUT = -0.1


def processing_lag_ms(ts_col: str = "timestamp", as_of=None) -> Column:
    """Milliseconds between the event time and ``as_of`` (default now)."""
    if as_of is None:
        anchor = F.current_timestamp()
    elif isinstance(as_of, Column):
        anchor = as_of
    else:
        anchor = F.lit(as_of).cast("timestamp")
    return F.unix_millis(anchor) - F.unix_millis(F.col(ts_col))


#: The decoded columns that each derived column is computed from.
INPUTS: dict[str, dict[str, tuple[str, ...]]] = {
    "gps": {"speed_kmh": ("speed_ms",), "is_moving": ("speed_ms",), "processing_lag_ms": ("timestamp",)},
    "imu": {"accel_magnitude": ("accel_x", "accel_y", "accel_z"), "lateral_g": ("accel_y",), "longitudinal_g": ("accel_x",),
            "gyro_magnitude": ("gyro_x", "gyro_y", "gyro_z")},
    "can_bus": {"speed_kmh": ("speed_ms",), "hard_braking": ("brake_pressure_pct",),
                "engine_overheating": ("engine_temp_celsius",), "low_battery": ("battery_voltage",),
                "high_wear_brakes": ("brake_wear_pct",)},
}


def inputs_of(sensor: str, columns) -> list[str]:
    """The decoded columns that ``columns`` (decoded or derived) need."""
    derived = INPUTS.get(sensor, {})
    return list(dict.fromkeys(i for c in columns for i in derived.get(c, (c,))))


def _derive(df: DataFrame, sensor: str, derived: dict[str, Column]) -> DataFrame:
    """``df`` with the derived columns whose inputs it holds."""
    held = set(df.columns)
    return df.withColumns({c: e for c, e in derived.items() if held.issuperset(INPUTS[sensor][c])})


def enrich_gps(df: DataFrame, as_of=None) -> DataFrame:
    """P2, P3, P4 on gps readings."""
    return _derive(
        df, "gps", {
            "speed_kmh": F.round(F.col("speed_ms") * KMH_PER_MS, 2),
            "is_moving": F.col("speed_ms") > MOVING_MS,
            "processing_lag_ms": processing_lag_ms("timestamp", as_of),
        }
    )


def enrich_imu(df: DataFrame) -> DataFrame:
    """P5-P8 on imu readings."""
    return _derive(
        df, "imu", {
            "accel_magnitude": F.round(magnitude("accel_x", "accel_y", "accel_z"), 4),
            "lateral_g": F.round(F.col("accel_y") / G, 4),
            "longitudinal_g": F.round(F.col("accel_x") / G, 4),
            "gyro_magnitude": F.round(magnitude("gyro_x", "gyro_y", "gyro_z"), 5),
        }
    )


def enrich_can_bus(df: DataFrame) -> DataFrame:
    """P2, P9-P12 on can_bus readings (null inputs give null flags)."""
    return _derive(
        df, "can_bus", {
            "speed_kmh": F.round(F.col("speed_ms") * KMH_PER_MS, 2),
            "hard_braking": F.col("brake_pressure_pct") > HARD_BRAKE_PCT,
            "engine_overheating": F.col("engine_temp_celsius") > OVERHEAT_C,
            "low_battery": F.col("battery_voltage") < LOW_BATTERY_V,
            "high_wear_brakes": F.col("brake_wear_pct") > HIGH_WEAR_PCT,
        }
    )


def flag_anomaly(df: DataFrame, cut: float | Column = ANOMALY_SCORE_CUT) -> DataFrame:
    """``is_anomaly = anomaly_score < cut``."""
    cut_col = cut if isinstance(cut, Column) else F.lit(cut)
    return df.withColumn("is_anomaly", F.col("anomaly_score") < cut_col)


ENRICHERS = {"gps": enrich_gps, "imu": enrich_imu, "can_bus": enrich_can_bus}


def enrich(df: DataFrame, sensor: str) -> DataFrame:
    fn = ENRICHERS.get(sensor)
    return fn(df) if fn else df


SNAPSHOT_COLUMNS = [
    "ts", "vehicle_id", "sensor_type", "speed_ms", "accel_magnitude", "engine_temp",
    "anomaly_score", "is_anomaly", "lat", "lon",
]


def snapshot(*frames: DataFrame) -> DataFrame:
    """Flattened current readings over any sensor frames.

    Missing readings default to 0 (speed, accel, engine temp), false
    (is_anomaly) or null (score, position), as in the snapshot record.
    """
    parts = []
    for df in frames:
        cols = set(df.columns)

        def pick(name: str, alias: str, default=None, dtype="double"):
            if name in cols:
                c = F.col(name)
                return (F.coalesce(c, F.lit(default)) if default is not None else c).cast(dtype).alias(alias)
            return F.lit(default).cast(dtype).alias(alias)

        parts.append(
            df.select(
                F.col("timestamp").alias("ts"),
                F.col("vehicle_id"),
                F.col("sensor_type"),
                pick("speed_ms", "speed_ms", 0.0),
                pick("accel_magnitude", "accel_magnitude", 0.0),
                pick("engine_temp_celsius", "engine_temp", 0.0),
                pick("anomaly_score", "anomaly_score"),
                pick("is_anomaly", "is_anomaly", False, "boolean"),
                pick("latitude", "lat"),
                pick("longitude", "lon"),
                F.col("event_id"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
