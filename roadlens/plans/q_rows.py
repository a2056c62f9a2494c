"""Registered row-local queries (P*, T*) and source queries (S*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.time import time_parts
from roadlens.operators import validate as V
from roadlens.operators import windows as W
from roadlens.operators.enrich import enrich_imu
from roadlens.plans import tables
from roadlens.plans.oracle import CTES, dupes, with_ctes
from roadlens.plans.registry import W1_SQL, register
from roadlens.plans.telemetry_view import duck_readings_cte
from roadlens.schemas import SENSOR_SCHEMAS, SENSOR_TYPES, SERVING_TABLES
from roadlens.session import scratch_path
from roadlens.sources import landing
from roadlens.sources.kafka import decode_stats, quarantine, to_messages

# ---------------------------------------------------------------------------
# P1-P14
# ---------------------------------------------------------------------------

register(
    "p_time_parts",
    "SELECT *, CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month, "
    f"CAST(day(window_start) AS INTEGER) AS day FROM ({W1_SQL}) w",
)(lambda spark, sf: time_parts(
    W.window_summary("w1", tables.gps_events(spark, sf)), "window_start", with_hour=False))

register("p_enrich_gps", with_ctes("SELECT * FROM gps_events", "gps_events"))(
    lambda spark, sf: tables.gps_events(spark, sf))
register("p_enrich_imu", with_ctes("SELECT * FROM imu_events", "imu_events"))(
    lambda spark, sf: tables.imu_events(spark, sf))
register("p_enrich_can", with_ctes("SELECT * FROM can_bus_events", "can_bus_events"))(
    lambda spark, sf: tables.can_bus_events(spark, sf))
register("p_snapshot", with_ctes("SELECT * FROM snapshots", "snapshots"))(
    lambda spark, sf: tables.snapshots(spark, sf))

# ---------------------------------------------------------------------------
# T1-T5 (decoded rows, duplicates still present except for T5)
# ---------------------------------------------------------------------------

register(
    "t_valid_gps",
    with_ctes(
        "SELECT * FROM gps_all WHERE latitude BETWEEN -90 AND 90 "
        "AND longitude BETWEEN -180 AND 180 AND speed_ms >= 0",
        "gps_raw", extra={"gps_all": dupes("gps_raw")},
    ),
)(lambda spark, sf: V.filter_invalid(tables.parsed(spark, sf, "gps"), "gps"))

register(
    "t_valid_imu",
    with_ctes(
        "SELECT * FROM imu_all WHERE accel_magnitude < 100",
        "imu_enriched", extra={"imu_all": dupes("imu_enriched")},
    ),
)(lambda spark, sf: V.filter_invalid(enrich_imu(tables.parsed(spark, sf, "imu")), "imu"))

register(
    "t_valid_can",
    with_ctes(
        "SELECT * FROM can_all WHERE engine_rpm BETWEEN 0 AND 8000 "
        "AND engine_temp_celsius BETWEEN -40 AND 200",
        "can_raw", extra={"can_all": dupes("can_raw")},
    ),
)(lambda spark, sf: V.filter_invalid(tables.parsed(spark, sf, "can_bus"), "can_bus"))

register(
    "t_sanity_drops",
    with_ctes(
        "".join(
            f"{' UNION ALL ' if i else ''}SELECT '{sensor}' AS sensor_type, '{col}:range' AS rule, "
            f"count(*) FILTER (WHERE ({ok}) IS NOT TRUE) AS rows FROM {cte}_all"
            for i, (sensor, cte, col, ok) in enumerate([
                ("gps", "gps", "latitude", "latitude BETWEEN -90 AND 90"),
                ("gps", "gps", "longitude", "longitude BETWEEN -180 AND 180"),
                ("gps", "gps", "speed_ms", "speed_ms >= 0"),
                ("imu", "imu", "accel_magnitude", "accel_magnitude < 100"),
                ("can_bus", "can", "engine_rpm", "engine_rpm BETWEEN 0 AND 8000"),
                ("can_bus", "can", "engine_temp_celsius", "engine_temp_celsius BETWEEN -40 AND 200"),
            ])
        ),
        "gps_raw", "imu_enriched", "can_raw",
        extra={"gps_all": dupes("gps_raw"), "imu_all": dupes("imu_enriched"), "can_all": dupes("can_raw")},
    ),
)(lambda spark, sf: reduce(DataFrame.unionByName, [
    V.sanity_drops(tables.parsed(spark, sf, s), s) for s in ("gps", "imu", "can_bus")]))

register("t_dedup", with_ctes("SELECT * FROM can_raw", "can_raw"))(
    lambda spark, sf: V.deduplicate(tables.parsed(spark, sf, "can_bus")))

register(
    "t_hard_braking",
    with_ctes("SELECT * FROM can_bus_events WHERE hard_braking", "can_bus_events"),
)(lambda spark, sf: V.hard_braking_only(tables.can_bus_events(spark, sf)))

register(
    "t_engine_trouble",
    with_ctes(
        "SELECT * FROM can_bus_events WHERE engine_overheating OR low_battery OR brake_wear_pct > 80",
        "can_bus_events",
    ),
)(lambda spark, sf: tables.can_bus_events(spark, sf).filter(V.engine_trouble()))

# ---------------------------------------------------------------------------
# Decoding every topic (lidar shown; the others feed the P/T queries)
# ---------------------------------------------------------------------------

register(
    "s_parse_json",
    with_ctes("SELECT * FROM lidar_all", "lidar_raw", extra={"lidar_all": dupes("lidar_raw")}),
)(lambda spark, sf: tables.parsed(spark, sf, "lidar"))

register(
    "s_parse_camera",
    with_ctes("SELECT * FROM camera_all", "camera_raw", extra={"camera_all": dupes("camera_raw")}),
)(lambda spark, sf: tables.parsed(spark, sf, "camera"))

register(
    "s_parse_system",
    with_ctes("SELECT * FROM system_all", "system_raw", extra={"system_all": dupes("system_raw")}),
)(lambda spark, sf: tables.parsed(spark, sf, "system_health"))

# ---------------------------------------------------------------------------
# Constraint validation over all six sensors
# ---------------------------------------------------------------------------


def _checked(spark, sf):
    parts = []
    for sensor in SENSOR_TYPES:
        # Checked before the deduplication, so that its shuffle carries the names only.
        c = V.with_violations(tables.parsed(spark, sf, sensor), sensor)
        c = V.deduplicate(c.select("event_id", *V.DEDUP_ORDER, "sensor_type", "vehicle_id", "violations"))
        parts.append(c.select(
            "event_id", "sensor_type", "vehicle_id", "violations",
            F.array_join("violations", ",").alias("violation_list"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _duck_violations(sensor: str) -> str:
    """Violation list of one sensor, same order as the declared constraints."""
    from roadlens.operators.validate import constraints_for

    names = {f.name for f in SENSOR_SCHEMAS[sensor].fields}
    items = []
    for c in constraints_for(sensor):
        if c.column not in names:
            continue
        col = f'"{c.column}"'
        if c.kind == "required":
            cond = f"{col} IS NULL"
        elif c.kind == "prefix":
            cond = f"{col} IS NOT NULL AND NOT starts_with({col}, '{c.values[0]}')"
        elif c.kind == "one_of":
            vals = ", ".join(f"'{v}'" for v in c.values)
            cond = f"{col} IS NOT NULL AND {col} NOT IN ({vals})"
        else:
            bad = []
            if c.lo is not None:
                bad.append(f"{col} < {c.lo}")
            if c.hi is not None:
                bad.append(f"{col} {'>=' if c.hi_open else '>'} {c.hi}")
            cond = f"{col} IS NOT NULL AND ({' OR '.join(bad)})"
        items.append(f"CASE WHEN {cond} THEN '{c.column}:{c.kind}' END")
    return f"concat_ws(',', {', '.join(items)})"


_RAW = {"gps": "gps_raw", "imu": "imu_raw", "can_bus": "can_raw", "lidar": "lidar_raw",
        "camera": "camera_raw", "system_health": "system_raw"}

CHECKED_SQL = " UNION ALL ".join(
    f"SELECT event_id, sensor_type, vehicle_id, {_duck_violations(s)} AS violation_list FROM {_RAW[s]}"
    for s in SENSOR_TYPES
)

register(
    "s_validate",
    with_ctes("SELECT event_id, sensor_type, vehicle_id, violation_list FROM checked",
              *_RAW.values(), extra={"checked": CHECKED_SQL}),
)(lambda spark, sf: _checked(spark, sf).drop("violations"))

register(
    "s_quarantine",
    with_ctes("SELECT event_id, sensor_type, vehicle_id, violation_list FROM checked "
              "WHERE violation_list <> ''", *_RAW.values(), extra={"checked": CHECKED_SQL}),
)(lambda spark, sf: _checked(spark, sf).filter(F.size("violations") > 0).drop("violations"))

register(
    "s_validation_stats",
    with_ctes(
        "SELECT sensor_type, count(*) AS checked, count(*) FILTER (WHERE violation_list = '') AS valid, "
        "count(*) FILTER (WHERE violation_list <> '') AS rejected FROM checked GROUP BY 1",
        *_RAW.values(), extra={"checked": CHECKED_SQL},
    ),
)(lambda spark, sf: V.validation_stats(_checked(spark, sf))[0])

register(
    "s_violations_by_rule",
    with_ctes(
        "SELECT sensor_type, violation, count(*) AS \"rows\" FROM "
        "(SELECT sensor_type, unnest(string_split(violation_list, ',')) AS violation FROM checked "
        "WHERE violation_list <> '') GROUP BY 1, 2",
        *_RAW.values(), extra={"checked": CHECKED_SQL},
    ),
)(lambda spark, sf: V.validation_stats(_checked(spark, sf))[1])

ALL_MSGS_SQL = " UNION ALL ".join(
    f"SELECT topic, \"partition\", \"offset\", sequence_number FROM ({dupes(_RAW[s])})"
    for s in SENSOR_TYPES
)
_ALL_RAW_WITH_BAD = {
    f"{k}_all": duck_readings_cte(s, clean=False) for s, k in _RAW.items()
}

register(
    "s_decode_stats",
    with_ctes(
        "SELECT topic, count(*) AS received, "
        "count(*) FILTER (WHERE sequence_number % 103 = 0) AS parse_errors, "
        "count(*) FILTER (WHERE sequence_number % 103 <> 0) AS decoded FROM ("
        + " UNION ALL ".join(
            f"SELECT topic, sequence_number FROM ({dupes(k)})" for k in _ALL_RAW_WITH_BAD
        )
        + ") GROUP BY 1",
        extra=_ALL_RAW_WITH_BAD,
    ),
)(lambda spark, sf: decode_stats(tables.messages(spark, sf)))

register(
    "s_quarantine_malformed",
    with_ctes(
        "SELECT topic, \"offset\", vehicle_id AS \"key\", '{not json' AS \"value\", 'malformed' AS reason FROM ("
        + " UNION ALL ".join(
            f"SELECT topic, \"offset\", vehicle_id, sequence_number FROM ({dupes(k)})" for k in _ALL_RAW_WITH_BAD
        )
        + ") WHERE sequence_number % 103 = 0",
        extra=_ALL_RAW_WITH_BAD,
    ),
)(lambda spark, sf: quarantine(tables.messages(spark, sf)))

# ---------------------------------------------------------------------------
# Serialisation (compare decoded fields, not bytes)
# ---------------------------------------------------------------------------


def _serialize(spark, sf):
    msgs = to_messages(tables.gps_events(spark, sf))
    v = F.col("value").cast("string")
    return msgs.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.get_json_object(v, "$.event_id").alias("event_id"),
        F.get_json_object(v, "$.sensor_type").alias("sensor_type"),
        F.get_json_object(v, "$.speed_ms").cast("double").alias("speed_ms"),
        F.get_json_object(v, "$.is_moving").cast("boolean").alias("is_moving"),
    )


register(
    "s_serialize",
    with_ctes(
        "SELECT 'av.telemetry.gps' AS topic, vehicle_id AS \"key\", event_id, sensor_type, speed_ms, "
        "is_moving FROM gps_events",
        "gps_events",
    ),
)(_serialize)

# ---------------------------------------------------------------------------
# Landing, load by name, partition catalog
# ---------------------------------------------------------------------------

PROCESSED_UNION_SQL = (
    "SELECT sensor_type, vehicle_id, \"timestamp\", year, month, day, hour FROM gps_events "
    "UNION ALL SELECT sensor_type, vehicle_id, \"timestamp\", year, month, day, hour FROM imu_events "
    "UNION ALL SELECT sensor_type, vehicle_id, \"timestamp\", year, month, day, hour FROM can_bus_events"
)


def _processed_union(spark, sf, cols):
    parts = [tables.processed(spark, sf, s).select(*cols) for s in ("gps", "imu", "can_bus")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register(
    "s_partition_catalog",
    with_ctes(
        "SELECT sensor_type, year, month, day, vehicle_id, hour, "
        "concat_ws('#', sensor_type, CAST(year AS VARCHAR), lpad(CAST(month AS VARCHAR), 2, '0'), "
        "lpad(CAST(day AS VARCHAR), 2, '0')) AS partition_key, "
        "concat_ws('#', vehicle_id, lpad(CAST(hour AS VARCHAR), 2, '0')) AS sort_key, "
        "count(*) AS \"rows\", min(\"timestamp\") AS first_ts, max(\"timestamp\") AS last_ts "
        "FROM u GROUP BY 1, 2, 3, 4, 5, 6",
        "gps_events", "imu_events", "can_bus_events", extra={"u": PROCESSED_UNION_SQL},
    ),
)(lambda spark, sf: landing.partition_catalog(
    _processed_union(spark, sf, ["sensor_type", "vehicle_id", "timestamp", "year", "month", "day", "hour"])))


def _landing(spark, sf):
    path = scratch_path(spark, "raw-landing")
    readings = _processed_union(spark, sf, ["event_id", "sensor_type", "vehicle_id", "timestamp"])
    landing.write_landing(readings, path)
    return landing.landing_report(spark, path)


register(
    "s_raw_landing",
    with_ctes(
        "SELECT sensor_type, lpad(CAST(year AS VARCHAR), 4, '0') AS year, "
        "lpad(CAST(month AS VARCHAR), 2, '0') AS month, lpad(CAST(day AS VARCHAR), 2, '0') AS day, "
        "vehicle_id, count(*) AS \"rows\" FROM u GROUP BY 1, 2, 3, 4, 5",
        "gps_events", "imu_events", "can_bus_events", extra={"u": PROCESSED_UNION_SQL},
    ),
)(_landing)


def _load_by_name(spark, sf):
    path = scratch_path(spark, "gps-table")
    gps = tables.gps_events(spark, sf)
    landing.write_partitioned(gps, path, ["year", "month", "day", "vehicle_id"])
    return landing.load_table(spark, path, SERVING_TABLES["gps_events"])


register(
    "s_load_by_name",
    with_ctes(
        "SELECT " + ", ".join(f'"{f.name}"' for f in SERVING_TABLES["gps_events"].schema.fields)
        + " FROM gps_events",
        "gps_events",
    ),
)(_load_by_name)


# ---------------------------------------------------------------------------
# Append into a serving table (by name, NOT NULL, key dedup)
# Training scan (available features, no nulls, hash sample)
# ---------------------------------------------------------------------------


def _columns(table: str) -> str:
    return ", ".join(f'"{f.name}"' for f in SERVING_TABLES[table].schema.fields)


def _append_table(spark, sf):
    path = scratch_path(spark, "gps-events-table")
    landing.append(tables.served(spark, sf, "gps"), SERVING_TABLES["gps_events"], path)
    return landing.table_rows(spark, SERVING_TABLES["gps_events"], path)


register("s_append_table", with_ctes(f"SELECT {_columns('gps_events')} FROM gps_events", "gps_events"))(_append_table)


def _append_twice(spark, sf):
    """The second append finds every key stored."""
    path = scratch_path(spark, "gps-events-twice")
    for _ in range(2):
        landing.append(tables.served(spark, sf, "gps"), SERVING_TABLES["gps_events"], path)
    return landing.table_rows(spark, SERVING_TABLES["gps_events"], path)


register("s_append_twice", with_ctes(f"SELECT {_columns('gps_events')} FROM gps_events", "gps_events"))(_append_twice)


def _append_rejects(spark, sf):
    """Every row of vehicles ending in 7 loses its vehicle: those are rejected."""
    from pyspark.sql import functions as F

    path = scratch_path(spark, "gps-events-rejects")
    gps = tables.gps_events(spark, sf)
    landing.append(gps.withColumn("vehicle_id", F.when(~F.col("vehicle_id").endswith("7"), F.col("vehicle_id"))),
                   SERVING_TABLES["gps_events"], path)
    return landing.rejected_rows(spark, SERVING_TABLES["gps_events"], path).select(
        "event_id", "vehicle_id", "timestamp", "speed_ms")


register("s_append_rejects", with_ctes(
    'SELECT event_id, CAST(NULL AS VARCHAR) AS vehicle_id, "timestamp", speed_ms FROM gps_events '
    "WHERE vehicle_id LIKE '%7'", "gps_events"))(_append_rejects)


def _in_batches(spark, df, table, path, n=3):
    """Overlapping appends: batch k brings the keys that fall into k or k + 1,
    and the first one is repeated at the end."""
    from pyspark.sql import functions as F

    part = F.crc32(F.concat_ws("|", *[F.col(c).cast("string") for c in (table.key or ("event_id",))])) % n
    for k in [*range(n), 0]:
        own = (part == k) if not table.key else part.isin(k, (k + 1) % n)
        landing.append(df.filter(own), table, path, batch=str(k))


def _append_other(name, frame):
    table = SERVING_TABLES[name]

    def run(spark, sf):
        path = scratch_path(spark, f"{name}-batches")
        _in_batches(spark, frame(spark, sf), table, path)
        return landing.table_rows(spark, table, path)

    return run


register("s_append_imu", with_ctes(f"SELECT {_columns('imu_events')} FROM imu_events", "imu_events"))(
    _append_other("imu_events", lambda spark, sf: tables.served(spark, sf, "imu")))
register("s_append_can", with_ctes(f"SELECT {_columns('can_bus_events')} FROM can_bus_events", "can_bus_events"))(
    _append_other("can_bus_events", lambda spark, sf: tables.served(spark, sf, "can_bus")))
register("s_append_detections", with_ctes(
    f"SELECT {_columns('anomaly_detections')} FROM anomaly_detections", "anomaly_detections"))(
    _append_other("anomaly_detections", tables.scored_detections))


def _append_summary(spark, sf):
    """W1 fills its table."""
    from roadlens.plans.registry import w1_speed_summary

    table, path = SERVING_TABLES["vehicle_summary_1min"], scratch_path(spark, "summary-batches")
    _in_batches(spark, w1_speed_summary(spark, sf), table, path)
    return landing.table_rows(spark, table, path)


register("s_append_summary", W1_SQL)(_append_summary)


def _batched_store(spark, sf):
    path = scratch_path(spark, "gps-batches")
    _in_batches(spark, tables.served(spark, sf, "gps"), SERVING_TABLES["gps_events"], path)
    return landing.serving_store(SERVING_TABLES["gps_events"], path), path


register("s_zone_map", with_ctes(
    'SELECT year, month, day, hour, count(*) AS "rows", min("timestamp") AS first_timestamp, '
    'max("timestamp") AS last_timestamp FROM gps_events GROUP BY 1, 2, 3, 4', "gps_events"))(
    lambda spark, sf: _batched_store(spark, sf)[0].zones(spark))


def _compacted(spark, sf):
    """The rows after compaction and one more append of keys already stored."""
    store, path = _batched_store(spark, sf)
    store.compact(spark)
    landing.append(tables.served(spark, sf, "gps"), SERVING_TABLES["gps_events"], path)
    return landing.table_rows(spark, SERVING_TABLES["gps_events"], path)


register("s_compact", with_ctes(f"SELECT {_columns('gps_events')} FROM gps_events", "gps_events"))(_compacted)


def _training_scan(spark, sf):
    from roadlens.ml.iforest import FEATURE_COLS

    path = scratch_path(spark, "can-history")
    tables.can_bus_events(spark, sf).write.parquet(path)
    # A 10 % sample by a hash of the key that SQL engines share.
    return landing.training_scan(spark, path, FEATURE_COLS, fraction=0.1)


register("s_training_scan", with_ctes(
    "SELECT event_id, speed_ms, steering_angle_deg, brake_pressure_pct, engine_temp_celsius FROM can_bus_events "
    "WHERE speed_ms IS NOT NULL AND steering_angle_deg IS NOT NULL AND brake_pressure_pct IS NOT NULL "
    "AND engine_temp_celsius IS NOT NULL "
    "AND CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT) < 429496729", "can_bus_events"))(_training_scan)
