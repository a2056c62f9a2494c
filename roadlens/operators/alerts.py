"""Alert rules and per-vehicle cool-downs: A1-A7.

Rules are data: a name, a severity, a cool-down and two Columns (condition,
message). All rules are evaluated in one scan of the snapshots: each row
carries an array of the rules it matches, exploded into candidates.

The cool-down (A5) is a greedy recurrence per (rule, vehicle): the first hit
fires; a later hit fires only if at least ``cooldown`` seconds have passed since
the last *fired* alert (suppressed hits do not extend it). It is evaluated on
event time. The batch form first splits each key's hits into independent
segments (a hit at least one cool-down after the previous hit always fires),
then streams every segment in time order through one Arrow-batched fold:
segments are hash-partitioned, sorted within the partition, and the fold keeps
only the last fire time of the segment in progress, so memory is one batch
plus one timestamp, never a whole group, and a hot vehicle's segments spread
over many tasks.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from dataclasses import dataclass
from datetime import timedelta
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from roadlens.functions.numeric import round_half_up
from roadlens.functions.time import time_parts
from roadlens.sources.store import StoredTable


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    condition: Column
    message: Column
    cooldown_s: float = 300  # 0: every hit fires


def _ts_text(ts: str = "ts") -> Column:
    """ISO 8601 in UTC: microseconds only where there are any."""
    fraction = F.when(F.unix_micros(ts) % 1_000_000 != 0, F.date_format(ts, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def _fmt(pattern: str, c: Column, digits: int) -> Column:
    """The rounded number; ``n/a`` for a null."""
    return F.when(c.isNotNull(), F.format_string(pattern, round_half_up(c, digits))).otherwise("n/a")


def _text(tag: str, value: Column, *, before: str = "", unit: str = "") -> Column:
    """``[TAG] Vehicle v | <before><value><unit> | ts=...``"""
    return F.concat(F.lit(f"[{tag}] Vehicle "), "vehicle_id", F.lit(f" | {before}"), value, F.lit(f"{unit} | ts="), _ts_text())


def default_rules() -> list[Rule]:
    """A1-A4. Names, severities, thresholds, cool-downs and the
    message texts."""
    sensor_score = F.concat(F.col("sensor_type"), F.lit(" | score="), _fmt("%.3f", F.col("anomaly_score"), 3))
    kmh = F.col("speed_ms") * 3.6
    return [
        Rule("anomaly_detected", "high", F.coalesce(F.col("is_anomaly"), F.lit(False)),
             _text("ANOMALY", sensor_score, before="sensor="), cooldown_s=60),
        Rule("engine_overheat", "critical", F.col("engine_temp") > 105.0,
             _text("ENGINE OVERHEAT", _fmt("%.1f", F.col("engine_temp"), 1), before="temp=", unit="°C"), cooldown_s=120),
        Rule("high_speed", "medium", F.col("speed_ms") > 25.0,
             _text("HIGH SPEED", _fmt("%.1f", kmh, 1), before="speed=", unit=" km/h")),
        Rule("high_acceleration", "medium", F.col("accel_magnitude") > 15.0,
             _text("HIGH ACCEL", _fmt("%.2f", F.col("accel_magnitude"), 2), before="accel=", unit=" m/s²"), cooldown_s=60),
    ]


def hard_braking_rule(cooldown_s: float = 60) -> Rule:
    """Optional extra rule (promised by the reference's documentation only);
    evaluates snapshots that carry a ``hard_braking`` flag."""
    return Rule(
        "hard_braking", "medium", F.coalesce(F.col("hard_braking"), F.lit(False)),
        F.concat(F.lit("[HARD BRAKING] Vehicle "), F.col("vehicle_id"), F.lit(" | ts="), _ts_text()), cooldown_s,
    )


def candidates(snap: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """A6 (first half): every (rule, snapshot) match, in one scan."""
    rules = rules or default_rules()
    hits = F.filter(
        F.array(*[
            F.when(r.condition, F.struct(
                F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                F.lit(float(r.cooldown_s)).alias("cooldown_s"), r.message.alias("message"),
            ))
            for r in rules
        ]),
        lambda x: x.isNotNull(),
    )
    return (
        snap.select("vehicle_id", "ts", "event_id", F.explode(hits).alias("h"))
        .select(
            F.col("h.rule").alias("rule"), F.col("h.severity").alias("severity"),
            F.col("h.cooldown_s").alias("cooldown_s"), "vehicle_id", "ts", "event_id",
            F.col("h.message").alias("message"),
        )
    )


def _fold(batches):
    """Greedy cool-down over rows sorted by (rule, vehicle, segment, ts, event_id).

    State carried across batches: the last fire time of the key in progress
    (the sort guarantees a key's rows are contiguous). A new segment starts
    with a hit that fires whatever came before, so the state resets there.
    """
    cur_key = None
    last_fire = None
    for pdf in batches:
        if pdf.empty:
            continue
        ts = pdf["ts"].to_numpy(dtype="datetime64[ns]").astype("int64") // 1000
        cds = (pdf["cooldown_s"].to_numpy() * 1e6).astype("int64")
        keys = pdf[["rule", "vehicle_id", "_seg"]]
        starts = np.flatnonzero(np.r_[True, (keys.ne(keys.shift())).any(axis=1).to_numpy()[1:]])
        keep = []
        for lo, hi in zip(starts, np.r_[starts[1:], len(pdf)]):
            key = tuple(keys.iloc[lo])
            last_fire = last_fire if key == cur_key else None
            cur_key = key
            i = lo
            while i < hi:  # from one fire to the next
                if last_fire is not None:
                    i = max(i, lo + int(np.searchsorted(ts[lo:hi], last_fire + cds[lo])))
                    if i >= hi:
                        break
                last_fire = int(ts[i])
                keep.append(i)
                i += 1
        if keep:
            yield pdf.iloc[keep].drop(columns=["_seg"])


def segments(cands: DataFrame) -> DataFrame:
    """Split each (rule, vehicle) hit sequence into independent segments.

    A hit at least one cool-down after the previous hit (or the first hit)
    always fires, so the recurrence restarts there. With buckets one cool-down
    wide, two hits of the same bucket are less than a cool-down apart, so a
    restart can only be the first hit of a bucket: bucket b restarts when the
    previous non-empty bucket's last hit is at least a cool-down before b's
    first hit. Only per-bucket min/max are needed (a map-side combined
    aggregate); the running segment id is computed over one row per bucket
    and joined back on (rule, vehicle, bucket), so a hot vehicle's hits are
    never gathered in one task. ``_seg`` is the bucket where the segment
    starts.
    """
    us = F.unix_micros("ts")
    cd = (F.col("cooldown_s") * 1_000_000).cast("long")
    key = ["rule", "vehicle_id"]
    hits = cands.withColumn("_b", F.floor(us / F.greatest(cd, F.lit(1))).cast("long"))  # cool-down 0: all fire
    per_bucket = hits.groupBy(*key, "_b").agg(
        F.min(us).alias("_mn"), F.max(us).alias("_mx"), F.first("cooldown_s").alias("_cd")
    )
    by_b = Window.partitionBy(*key).orderBy("_b")
    prev_mx = F.lag("_mx").over(by_b)
    restart = prev_mx.isNull() | (F.col("_mn") - prev_mx >= (F.col("_cd") * 1_000_000).cast("long"))
    seg = per_bucket.withColumn("_start", F.when(restart, F.col("_b"))).withColumn(
        "_seg", F.max("_start").over(by_b.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).select(*key, "_b", "_seg")
    return hits.join(seg, [*key, "_b"]).drop("_b")


def apply_cooldown(cands: DataFrame, partitions: int | None = None, cut_lineage: bool = True) -> DataFrame:
    """A5 (batch): keep the hits that fire under the per-(rule, vehicle) cool-down.

    The hits feed both the bucket summaries and the fold; a reliable checkpoint
    (to ``spark.checkpoint.dir``, a shared folder on a cluster) computes them
    once and cuts the lineage back to the raw readings.
    """
    from roadlens.session import ship_package

    ship_package(cands.sparkSession)
    if cut_lineage:
        from roadlens.session import checkpoint_root

        checkpoint_root(cands.sparkSession)
        cands = cands.checkpoint(eager=True)
    seg = segments(cands)
    keyed = seg.repartition(*([partitions] if partitions else []), "rule", "vehicle_id", "_seg")
    ordered = keyed.sortWithinPartitions("rule", "vehicle_id", "_seg", "ts", "event_id")
    return ordered.mapInPandas(_fold, schema=cands.schema)


def evaluate(snap: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Fired alerts (rule, severity, vehicle_id, message, ts, event_id)."""
    return apply_cooldown(candidates(snap, rules)).select(
        "rule", "severity", "vehicle_id", "message", "ts", "event_id"
    )


def fired_counts(alerts: DataFrame) -> DataFrame:
    """Fired count per rule."""
    return alerts.groupBy("rule").agg(F.count(F.lit(1)).alias("fired"))


# Fixed value: alert history retention.
HISTORY_TTL_DAYS = 30


def history(alerts: DataFrame, ttl_days: int = HISTORY_TTL_DAYS, as_of=None) -> DataFrame:
    """History records keyed by a deterministic alert_id, with expiry;
    expired records are filtered against ``as_of`` (default: now)."""
    return unexpired(alerts.withColumn("alert_id", alert_id()), ttl_days, as_of)


def alert_id() -> Column:
    return F.sha2(F.concat_ws("|", "rule", "vehicle_id", F.unix_micros("ts").cast("string")), 256)


def unexpired(identified: DataFrame, ttl_days: int, as_of=None) -> DataFrame:
    anchor = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return identified.withColumn("expires_at", F.col("ts") + F.expr(f"INTERVAL {int(ttl_days)} DAYS")).filter(
        F.col("expires_at") > anchor)


@dataclass(frozen=True)
class AlertHistory:
    """The fired alerts in a stored table, one per alert id and time. A batch
    that is stored again adds nothing; ``expire`` hides whole days."""

    path: str
    ttl_days: int = HISTORY_TTL_DAYS

    @property
    def table(self) -> StoredTable:
        return StoredTable(self.path, key=("alert_id", "ts"), time_cols=("ts",))

    def append(self, fired: DataFrame, batch: str | None = None) -> int:
        """The number of alerts that were not stored yet."""
        identified = fired.withColumn("alert_id", alert_id())
        return self.table.append(time_parts(identified, "ts", with_hour=False), batch)

    def expire(self, spark: SparkSession, as_of) -> None:
        """Hides the days all of whose alerts are past their time at ``as_of``."""
        self.table.expire(spark, (as_of - timedelta(days=self.ttl_days)).date())

    def rows(self, spark: SparkSession, as_of=None) -> DataFrame:
        """The alerts that have not expired at ``as_of`` (default: now)."""
        kept = self.table.rows(spark).drop("year", "month", "day")
        return unexpired(kept, self.ttl_days, as_of)


def recent_alerts(alerts: DataFrame, n: int = 50) -> DataFrame:
    """Newest ``n`` alerts."""
    return alerts.orderBy(F.desc("ts"), F.desc("event_id"), "rule").limit(n)


# ---------------------------------------------------------------------------
# The same cool-down on a stream, in event time. Hits wait in a key's state,
# many to a state row. A row whose first hit is not due yet is left as it is.
# ---------------------------------------------------------------------------

WAITING_ROW = "first_us long, hits string"
HIT = ["us", "event_id", "severity", "cooldown_us", "message"]
#: Hits that came together lie in state rows of successive times: in so many
#: rows, or one each where they are fewer, of so many hits at most.
ROWS, ROW_HITS = 16, 512


def _due_ms(us: int) -> int:
    return -(-us // 1000)


def _in_time(hit):
    return hit[0], hit[1] or ""


class CooldownState(StatefulProcessor):
    """State of a (rule, vehicle): its last fire, and the hits that wait for the
    watermark, with a timer at the first of them. All that are due are folded
    together in event-time order, whatever order they came in: hits that come
    later lie behind the watermark that they were folded at. A last fire is
    dropped once its cool-down is over."""

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last_fire", "us long, until_us long")
        self.waiting = handle.getMapState("waiting", "place string", WAITING_ROW)

    def handleInputRows(self, key, rows, timerValues):
        return self._wait((r.us, r.event_id, r.severity, r.cooldown_us, r.message) for r in rows)

    def _wait(self, hits):
        first = None
        while some := sorted(islice(hits, ROWS * ROW_HITS), key=_in_time):
            first = some[0][0] if first is None else min(first, some[0][0])
            step = -(-len(some) // ROWS)
            for i in range(0, len(some), step):
                self._put((uuid.uuid4().hex,), some[i:i + step])
        if first is not None:
            self.handle.registerTimer(_due_ms(first))
        return iter(())

    def _put(self, place, hits):
        """One state row: hits in order of time."""
        self.waiting.updateValue(place, (hits[0][0], json.dumps(hits, ensure_ascii=False)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now_us = timerValues.getCurrentWatermarkInMs() * 1000
        due, rest, left = [], [], {}
        for place, (first_us, packed) in self.waiting.iterator():
            if first_us > now_us:
                rest.append(first_us)
                continue
            hits = json.loads(packed)
            n = bisect_right(hits, now_us, key=lambda h: h[0])
            due += hits[:n]
            left[tuple(place)] = hits[n:]
        for place, hits in left.items():
            if hits:
                self._put(place, hits)
                rest.append(hits[0][0])
            else:
                self.waiting.removeKey(place)
        if left and rest:
            self.handle.registerTimer(_due_ms(min(rest)))
        until = self.last.get()[1] if self.last.exists() else None
        fired = []
        for us, event_id, severity, cooldown_us, message in sorted(due, key=_in_time):
            if until is None or us >= until:
                until = us + cooldown_us
                fired.append(Row(rule=key[0], severity=severity, vehicle_id=key[1], us=us, event_id=event_id,
                                 cooldown_us=cooldown_us, message=message))
        if fired:
            self.last.update((fired[-1].us, until))
            self.handle.registerTimer(_due_ms(until))
        elif until is not None and until <= now_us:
            self.last.clear()
        return iter(fired)

    def close(self):
        pass


class CooldownFrames(CooldownState):
    """The same on pandas frames of hits: Spark makes a ``Row`` value by value."""

    def handleInputRows(self, key, rows, timerValues):
        return self._wait(hit for frame in rows for hit in zip(*(frame[c].tolist() for c in HIT)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired = list(super().handleExpiredTimer(key, timerValues, expiredTimerInfo))
        return iter([pd.DataFrame(fired, columns=fired[0].__fields__)] if fired else [])


FIRED = ("rule string, severity string, vehicle_id string, us long, event_id string, cooldown_us long, message string")


def apply_cooldown_stream(cands: DataFrame) -> DataFrame:
    """Stateful cool-down on a streaming frame of candidates whose ``ts``
    carries a watermark. A hit fires, or not, once the watermark has passed it,
    so the alerts don't depend on the order of arrival or on the micro-batches.
    The query needs the RocksDB state store when it starts
    (``streaming.jobs.rocksdb_state``)."""
    from roadlens.session import ship_package

    ship_package(cands.sparkSession)
    hits = cands.withColumns({"us": F.unix_micros("ts"), "cooldown_us": (F.col("cooldown_s") * 1_000_000).cast("long")})
    fired = hits.select("rule", "vehicle_id", "ts", *HIT).groupBy("rule", "vehicle_id").transformWithStateInPandas(
        CooldownFrames(), outputStructType=FIRED, outputMode="append", timeMode="EventTime")
    return fired.withColumns({"ts": F.timestamp_micros("us"), "cooldown_s": F.col("cooldown_us") / 1_000_000.0}).select(
        *cands.columns)
