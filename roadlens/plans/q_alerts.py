"""Registered alert queries A1-A7 (snapshots of gps, imu and scored can_bus
readings; event-time cool-downs)."""

from __future__ import annotations

from roadlens.operators import alerts as A
from roadlens.plans import tables
from roadlens.plans.oracle import with_ctes
from roadlens.plans.registry import ORACLES, register
from roadlens.session import scratch_path

def _iso(ts: str) -> str:
    """ISO 8601 in UTC, as the alert texts spell it."""
    return (f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 <> 0 "
            f"THEN strftime({ts}, '.%f') ELSE '' END || '+00:00'")


_TS = _iso("ts")


def _r(expr: str, n: int) -> str:
    return f"coalesce(printf('%.{n}f', CAST(round(CAST({expr} AS DECIMAL(38,12)), {n}) AS DOUBLE)), 'n/a')"


# One SELECT per rule: (name, severity, cooldown, condition, message).
RULES_SQL = {
    "anomaly_detected": (
        "high", 60, "coalesce(is_anomaly, false)",
        f"concat('[ANOMALY] Vehicle ', vehicle_id, ' | sensor=', sensor_type, ' | score=', "
        f"{_r('anomaly_score', 3)}, ' | ts=', {_TS})",
    ),
    "engine_overheat": (
        "critical", 120, "engine_temp > 105.0",
        f"concat('[ENGINE OVERHEAT] Vehicle ', vehicle_id, ' | temp=', {_r('engine_temp', 1)}, "
        f"'°C | ts=', {_TS})",
    ),
    "high_speed": (
        "medium", 300, "speed_ms > 25.0",
        f"concat('[HIGH SPEED] Vehicle ', vehicle_id, ' | speed=', {_r('speed_ms * 3.6', 1)}, "
        f"' km/h | ts=', {_TS})",
    ),
    "high_acceleration": (
        "medium", 60, "accel_magnitude > 15.0",
        f"concat('[HIGH ACCEL] Vehicle ', vehicle_id, ' | accel=', {_r('accel_magnitude', 2)}, "
        f"' m/s² | ts=', {_TS})",
    ),
}


def cands_sql(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, '{sev}' AS severity, CAST({cd} AS DOUBLE) AS cooldown_s, vehicle_id, ts, "
        f"event_id, {msg} AS message FROM snapshots WHERE {cond}"
        for n, (sev, cd, cond, msg) in RULES_SQL.items() if n in names
    )


def fired_ctes(names, cands: str | None = None) -> dict[str, str]:
    return {
        "cands": cands if cands is not None else cands_sql(names),
        "h": "SELECT *, row_number() OVER (PARTITION BY rule, vehicle_id ORDER BY ts, event_id) AS rn FROM cands",
        "nx": (
            "SELECT a.rule, a.vehicle_id, a.rn, min(b.rn) AS next_rn FROM h a LEFT JOIN h b "
            "ON a.rule = b.rule AND a.vehicle_id = b.vehicle_id "
            "AND epoch_us(b.ts) - epoch_us(a.ts) >= CAST(a.cooldown_s * 1000000 AS BIGINT) "
            "GROUP BY 1, 2, 3"
        ),
        "chain": (
            "SELECT rule, vehicle_id, rn FROM h WHERE rn = 1 UNION ALL "
            "SELECT n.rule, n.vehicle_id, n.next_rn FROM chain c JOIN nx n "
            "ON n.rule = c.rule AND n.vehicle_id = c.vehicle_id AND n.rn = c.rn WHERE n.next_rn IS NOT NULL"
        ),
        "fired": (
            "SELECT h.rule, h.severity, h.vehicle_id, h.message, h.ts, h.event_id "
            "FROM chain JOIN h USING (rule, vehicle_id, rn)"
        ),
    }


def fired_sql(select: str, names) -> str:
    return with_ctes(select, "snapshots", extra=fired_ctes(names), recursive=True)


ALL = tuple(RULES_SQL)


def _rules(names):
    return [r for r in A.default_rules() if r.name in names]


register("a_candidates", with_ctes("SELECT * FROM cands", "snapshots", extra={"cands": cands_sql(ALL)}))(
    lambda spark, sf: A.candidates(tables.snapshots(spark, sf)))

for key, rule in [("a1_anomaly", "anomaly_detected"), ("a2_engine_overheat", "engine_overheat"),
                  ("a3_high_speed", "high_speed"), ("a4_high_accel", "high_acceleration")]:
    register(key, fired_sql("SELECT * FROM fired", [rule]))(
        (lambda r: lambda spark, sf: A.evaluate(tables.snapshots(spark, sf), _rules([r])))(rule))

register("a_cooldown_all", fired_sql("SELECT * FROM fired", ALL))(
    lambda spark, sf: A.evaluate(tables.snapshots(spark, sf)))

register("a_fired_counts", fired_sql("SELECT rule, count(*) AS fired FROM fired GROUP BY 1", ALL))(
    lambda spark, sf: A.fired_counts(A.evaluate(tables.snapshots(spark, sf))))

AS_OF = "2024-01-20 00:00:00"
register(
    "a_history",
    fired_sql(
        "SELECT *, sha256(concat_ws('|', rule, vehicle_id, CAST(epoch_us(ts) AS VARCHAR))) AS alert_id, "
        "ts + INTERVAL 30 DAY AS expires_at FROM fired "
        f"WHERE ts + INTERVAL 30 DAY > TIMESTAMP '{AS_OF}'",
        ALL,
    ),
)(lambda spark, sf: A.history(A.evaluate(tables.snapshots(spark, sf)), as_of=AS_OF))

_HISTORY: dict[tuple[str, str], A.AlertHistory] = {}


def stored_alerts(spark, sf) -> A.AlertHistory:
    """The view's alerts, stored once per session; the batch then comes again,
    once under its name and once under another."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _HISTORY:
        kept = A.AlertHistory(scratch_path(spark, "alert-history"))
        path = scratch_path(spark, "alerts-fired")  # one evaluation for all appends
        A.evaluate(tables.snapshots(spark, sf)).write.parquet(path)
        fired = spark.read.parquet(path)
        kept.append(fired, "view")
        kept.append(fired, "view")
        kept.append(fired, "view-again")
        _HISTORY[key] = kept
    return _HISTORY[key]


register("a_stored_history", ORACLES["a_history"])(lambda spark, sf: stored_alerts(spark, sf).rows(spark, AS_OF))

register("g21_recent_alerts",
         fired_sql("SELECT * FROM fired ORDER BY ts DESC, event_id DESC, rule LIMIT 50", ALL))(
    lambda spark, sf: A.recent_alerts(stored_alerts(spark, sf).rows(spark, AS_OF), 50).drop("alert_id", "expires_at"))


# Q8: the documented hard-braking alert, as an extra configurable rule over
# can_bus readings (60 s cool-down).
HARD_BRAKE_CANDS = (
    "SELECT 'hard_braking' AS rule, 'medium' AS severity, CAST(60 AS DOUBLE) AS cooldown_s, vehicle_id, "
    "\"timestamp\" AS ts, event_id, concat('[HARD BRAKING] Vehicle ', vehicle_id, ' | ts=', "
    + _iso('"timestamp"') + ") AS message FROM can_bus_events WHERE hard_braking"
)


def _hard_braking_alerts(spark, sf):
    from pyspark.sql import functions as F

    can = tables.can_bus_events(spark, sf).select(
        F.col("timestamp").alias("ts"), "vehicle_id", "event_id", "hard_braking")
    return A.evaluate(can, [A.hard_braking_rule(60)])


register(
    "a5_hard_braking_rule",
    with_ctes("SELECT * FROM fired", "can_bus_events",
              extra=fired_ctes([], cands=HARD_BRAKE_CANDS), recursive=True),
)(_hard_braking_alerts)
