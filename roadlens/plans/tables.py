"""Processed sensor tables over the telemetry view (the batch form of the
streaming path: decode -> sanity filter -> dedup -> enrich -> time parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.time import time_parts
from roadlens.operators.enrich import enrich, enrich_gps, inputs_of
from roadlens.operators.validate import DEDUP_ORDER, deduplicate, filter_invalid
from roadlens.plans.telemetry_view import raw_messages
from roadlens.schemas import SANITY_BOUNDS, SENSOR_SCHEMAS, SERVING_TABLES, TOPICS
from roadlens.session import ensure_utc, scratch_path
from roadlens.sources.kafka import parse_messages
from roadlens.sources.store import StoredTable

TIME_PARTS = {"year", "month", "day", "hour"}


def messages(spark: SparkSession, sf_dir: str, sensors=None) -> DataFrame:
    ensure_utc(spark)
    return raw_messages(spark, sf_dir, sensors)


def parsed(spark: SparkSession, sf_dir: str, sensor: str, columns=None) -> DataFrame:
    """S3 over one topic of the view (duplicates still present)."""
    msgs = messages(spark, sf_dir, [sensor]).filter(F.col("topic") == TOPICS[sensor])
    return parse_messages(msgs, SENSOR_SCHEMAS[sensor], columns)


def processed(spark: SparkSession, sf_dir: str, sensor: str, with_hour: bool = True, columns=None) -> DataFrame:
    """Decoded, filtered (T1-T4), deduplicated (T5), enriched (P*) readings with
    year/month/day/hour (P1).

    With ``columns`` (decoded, derived or time parts) only what these, the filter and the
    deduplication need is decoded, and only what the ``columns`` need goes
    through the shuffle of the deduplication."""
    timed = columns is None or not TIME_PARTS.isdisjoint(columns)
    if columns is None:
        df = deduplicate(filter_invalid(parsed(spark, sf_dir, sensor), sensor))
    else:
        needs = inputs_of(sensor, ("timestamp" if c in TIME_PARTS else c for c in columns))
        bounds = inputs_of(sensor, (c.column for c in SANITY_BOUNDS.get(sensor, [])))
        df = filter_invalid(parsed(spark, sf_dir, sensor, {*needs, *bounds, "event_id", "ingested_at"}), sensor)
        df = deduplicate(df.select(*dict.fromkeys(["event_id", *DEDUP_ORDER, *needs])))
    if sensor == "gps":
        # Lag is measured against the ingestion time carried by each reading.
        df = enrich_gps(df, as_of=F.col("ingested_at"))
    else:
        df = enrich(df, sensor)
    if timed:
        df = time_parts(df, "timestamp", with_hour=with_hour)
    return df if columns is None else df.select(*columns)


def served(spark, sf_dir, sensor):
    """Processed readings in the columns of their serving table."""
    return processed(spark, sf_dir, sensor, columns=[f.name for f in SERVING_TABLES[f"{sensor}_events"].schema.fields])


def gps_events(spark, sf_dir):
    return processed(spark, sf_dir, "gps")


def imu_events(spark, sf_dir):
    return processed(spark, sf_dir, "imu")


def can_bus_events(spark, sf_dir):
    return processed(spark, sf_dir, "can_bus")


# ---------------------------------------------------------------------------
# Stand-in anomaly scores for the serving and alert queries. The seeded
# forest (M2-M4) scores rows too, but its scores are not SQL-expressible;
# the serving queries need a score column an oracle can reproduce.
# ---------------------------------------------------------------------------

STANDIN_CUT = -0.7
FEATURES_JSON = ("speed_ms", "steering_angle_deg", "brake_pressure_pct", "engine_temp_celsius")


def standin_score():
    return -(F.lit(0.25) + ((F.col("sequence_number") * 13) % 512).cast("double") / 1024)


def scored_can(spark, sf_dir):
    """Processed can_bus readings with ``anomaly_score`` and ``is_anomaly``."""
    can = can_bus_events(spark, sf_dir).withColumn("anomaly_score", standin_score())
    return can.withColumn("is_anomaly", F.col("anomaly_score") < STANDIN_CUT)


DETECTION_COLUMNS = ["event_id", "vehicle_id", "timestamp", "sensor_type", "anomaly_score", "features", "detected_at"]


def scored_detections(spark, sf_dir):
    """M14 record layout over the flagged readings (detected at ingestion)."""
    scored = serving_table(spark, sf_dir, "can_bus").rows(spark).withColumn("anomaly_score", standin_score())
    return scored.filter(F.col("anomaly_score") < STANDIN_CUT).withColumns(
        {"features": F.to_json(F.struct(*FEATURES_JSON)), "detected_at": F.col("ingested_at")}
    ).select(*DETECTION_COLUMNS)


def anomaly_detections(spark, sf_dir):
    """The stored detections (M14): scored once, kept by event."""
    return stored(spark, sf_dir, "detections", lambda: scored_detections(spark, sf_dir), key=("event_id",),
                  time_cols=("timestamp", "detected_at")).timed(spark)


def snapshots(spark, sf_dir):
    """P14 over gps, imu and scored can_bus readings."""
    from roadlens.operators.enrich import snapshot

    reads = {
        "gps": ("speed_ms", "latitude", "longitude"),
        "imu": ("accel_magnitude",),
        "can_bus": ("speed_ms", "engine_temp_celsius", "sequence_number"),
    }
    gps, imu, can = (processed(spark, sf_dir, s, columns=("event_id", "vehicle_id", "sensor_type", "timestamp", *cols))
                     for s, cols in reads.items())
    can = can.withColumn("anomaly_score", standin_score()).withColumn("is_anomaly", F.col("anomaly_score") < STANDIN_CUT)
    return snapshot(gps, imu, can)


# ---------------------------------------------------------------------------
# Serving store: processed readings and detections, appended once per session to
# stored tables (what the streaming sinks land). Their zone maps give the
# look-back queries their anchors and days.
# ---------------------------------------------------------------------------

_STORE: dict[tuple[str, str, str], StoredTable] = {}


def stored(spark, sf_dir, name, frame, **settings) -> StoredTable:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORE:
        table = StoredTable(scratch_path(spark, f"serving-{name}"), **settings)
        table.append(frame(), "view")
        _STORE[key] = table
    return _STORE[key]


def serving_table(spark, sf_dir, sensor) -> StoredTable:
    """Processed readings: their events are already distinct."""
    return stored(spark, sf_dir, sensor, lambda: processed(spark, sf_dir, sensor))


def gps_store(spark, sf_dir):
    return serving_table(spark, sf_dir, "gps").timed(spark)


def can_store(spark, sf_dir):
    return serving_table(spark, sf_dir, "can_bus").timed(spark)


def imu_store(spark, sf_dir):
    return serving_table(spark, sf_dir, "imu").timed(spark)


def store(spark, sf_dir, sensor):
    return serving_table(spark, sf_dir, sensor).rows(spark)
