"""Cool-down (A5) against a brute-force loop on a small fixture with a hot
vehicle, and the streaming state (R10) against the batch fold."""

import datetime as dt
import json
import random
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import functions as F

from roadlens.operators import alerts as A
from roadlens.streaming.jobs import rocksdb_state

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def fixture(spark, n=3000, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of the rows belong to one hot vehicle.
        v = "ZX-HOT" if i % 3 == 0 else f"ZX-{rng.randrange(20):03d}"
        ts = BASE + dt.timedelta(seconds=rng.uniform(0, 3600))
        rows.append((v, ts, f"e{i:05d}", "can_bus", rng.uniform(0, 40), rng.uniform(0, 20),
                     rng.uniform(60, 130), rng.random() < 0.1))
    return spark.createDataFrame(
        rows, "vehicle_id string, ts timestamp, event_id string, sensor_type string, speed_ms double, "
              "accel_magnitude double, engine_temp double, is_anomaly boolean",
    ).withColumn("anomaly_score", F.lit(-0.5))


def brute(rows, rules):
    cds = {r.name: r.cooldown_s for r in rules}
    out = set()
    last = {}
    for r in sorted(rows, key=lambda x: (x["rule"], x["vehicle_id"], x["ts"], x["event_id"])):
        k = (r["rule"], r["vehicle_id"])
        t = r["ts"].timestamp()
        if k not in last or t - last[k] >= cds[r["rule"]] - 1e-9:
            last[k] = t
            out.add((r["rule"], r["vehicle_id"], r["event_id"]))
    return out


def test_cooldown_matches_brute_force(spark):
    snap = fixture(spark)
    rules = A.default_rules()
    cands = A.candidates(snap, rules).collect()
    expect = brute(cands, rules)
    got = {(r["rule"], r["vehicle_id"], r["event_id"]) for r in A.evaluate(snap, rules).collect()}
    assert got == expect
    # The first hit of every key always fires.
    assert len(got) >= len({(r["rule"], r["vehicle_id"]) for r in cands})


def test_cooldown_is_partitioning_independent(spark):
    snap = fixture(spark, 1500, seed=3)
    a = {tuple(r) for r in A.apply_cooldown(A.candidates(snap), partitions=1).select("rule", "event_id").collect()}
    b = {tuple(r) for r in A.apply_cooldown(A.candidates(snap), partitions=13).select("rule", "event_id").collect()}
    assert a == b


def test_suppressed_hits_do_not_extend_cooldown(spark):
    rows = [("ZX-001", BASE + dt.timedelta(seconds=s), f"e{s}", "can_bus", 30.0, 0.0, 0.0, False)
            for s in (0, 200, 299, 300, 450, 601)]
    snap = spark.createDataFrame(rows, "vehicle_id string, ts timestamp, event_id string, sensor_type string, "
                                       "speed_ms double, accel_magnitude double, engine_temp double, is_anomaly boolean"
                                 ).withColumn("anomaly_score", F.lit(None).cast("double"))
    fired = sorted(r["event_id"] for r in A.evaluate(snap).collect())
    assert fired == ["e0", "e300", "e601"]


def test_stream_cooldown_matches_batch(spark, tmp_path):
    # Six micro-batches in no order of time; a last, later reading moves the watermark.
    snap = fixture(spark, 1200, seed=11)
    src = str(tmp_path / "snap")
    for i in range(6):
        snap.filter(F.pmod(F.xxhash64("event_id"), F.lit(6)) == i).coalesce(1).write.mode("append").parquet(src)
    end = snap.limit(1).withColumns({"ts": F.expr("ts + INTERVAL 9 DAYS"), "event_id": F.lit("end"), "is_anomaly": F.lit(False),
                                     **{c: F.lit(0.0) for c in ("speed_ms", "accel_magnitude", "engine_temp")}})
    end.select(*snap.columns).coalesce(1).write.mode("append").parquet(src)
    stream = (spark.readStream.schema(snap.schema).option("maxFilesPerTrigger", 1).parquet(src)
              .withWatermark("ts", "3 days"))
    out = A.apply_cooldown_stream(A.candidates(stream))
    with rocksdb_state(spark):
        q = (out.writeStream.format("memory").queryName("alerts_stream_test").outputMode("append")
             .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r["rule"], r["event_id"]) for r in spark.table("alerts_stream_test").collect()}
    batch = {(r["rule"], r["event_id"]) for r in A.evaluate(snap).collect()}
    assert got == batch


def test_stream_alerts_fire_before_the_end_and_state_goes(spark, tmp_path):
    # Hits at 0, 200, 300 and 300 s, then at 2,000 s, then another vehicle's at 9,000 and 20,000 s.
    schema = ("vehicle_id string, ts timestamp, event_id string, sensor_type string, speed_ms double, "
              "accel_magnitude double, engine_temp double, is_anomaly boolean, anomaly_score double")
    src, ckpt, out = (str(tmp_path / d) for d in ("snap", "ckpt", "out"))
    spark.createDataFrame([], schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src).withWatermark("ts", "1 minute")
    alerts = A.apply_cooldown_stream(A.candidates(stream)).select("event_id", "ts", "cooldown_s")
    seen, left = [], []
    for batch in ([("a", 300, "e3"), ("a", 0, "e1"), ("a", 300, "e4"), ("a", 200, "e2")], [("a", 2000, "e5")],
                  [("b", 9000, "e6")], [("b", 20000, "e7")], [("b", 30000, "e8")]):
        rows = [(v, BASE + dt.timedelta(seconds=s), e, "can_bus", 30.0, 0.0, 0.0, False, None) for v, s, e in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        with rocksdb_state(spark):
            q = (alerts.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        q.awaitTermination()
        seen.append(sorted(r["event_id"] for r in spark.read.schema(alerts.schema).parquet(out).collect()))
        left.append(sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]))
    assert seen[-1] == ["e1", "e3", "e5", "e6", "e7"]
    assert "e1" in seen[1] and "e3" in seen[1] and "e4" not in seen[-1]
    assert left == [3, 2, 2, 2, 2]  # at the end: e8 waits, e7 fired last; nothing of vehicle a
    assert {r["cooldown_s"] for r in spark.read.schema(alerts.schema).parquet(out).collect()} == {300.0}


def test_history_ids_are_deterministic(spark):
    snap = fixture(spark, 300, seed=5)
    h1 = A.history(A.evaluate(snap), as_of="2024-01-02").select("alert_id").collect()
    h2 = A.history(A.evaluate(snap), as_of="2024-01-02").select("alert_id").collect()
    assert sorted(h1) == sorted(h2)
    assert A.history(A.evaluate(snap), as_of="2025-01-01").count() == 0


def test_segments_on_sparse_hits_match_brute_force(spark):
    # Sparse hits: many gaps longer than the cool-down, so many segments,
    # including gaps that straddle bucket edges.
    snap = fixture(spark, 400, seed=21)
    rules = A.default_rules()
    cands = A.candidates(snap, rules)
    expect = brute(cands.collect(), rules)
    got = {(r["rule"], r["vehicle_id"], r["event_id"]) for r in A.apply_cooldown(cands).collect()}
    assert got == expect
    segs = A.segments(cands).select("rule", "vehicle_id", "_seg").distinct().count()
    keys = cands.select("rule", "vehicle_id").distinct().count()
    assert segs > keys


def test_cooldown_zero_fires_every_hit(spark):
    import datetime as dt

    ts = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("r", "high", 0.0, "ZX-001", ts, f"e{i}", "m") for i in range(3)]
    rows += [("r", "high", 0.0, "ZX-001", ts + dt.timedelta(seconds=1), "e9", "m")]
    cands = spark.createDataFrame(rows, "rule string, severity string, cooldown_s double, vehicle_id string, "
                                        "ts timestamp, event_id string, message string")
    assert A.apply_cooldown(cands).count() == 4


def test_message_texts_are_iso_and_survive_null_scores(spark):
    snap = spark.sql("""SELECT 'ZX-001' vehicle_id, timestamp'2024-01-01 12:00:00' ts, 'e1' event_id, true is_anomaly,
        'can_bus' sensor_type, cast(null AS double) anomaly_score, 110.0D engine_temp, 0.0D speed_ms, 0.0D accel_magnitude
        UNION ALL SELECT 'ZX-002', timestamp'2024-01-01 12:00:00.5', 'e2', false, 'can_bus', 1.0D, 0.0D, 30.0D, 0.0D""")
    got = {r["message"] for r in A.candidates(snap).collect()}
    assert got == {
        "[ANOMALY] Vehicle ZX-001 | sensor=can_bus | score=n/a | ts=2024-01-01T12:00:00+00:00",
        "[ENGINE OVERHEAT] Vehicle ZX-001 | temp=110.0°C | ts=2024-01-01T12:00:00+00:00",
        "[HIGH SPEED] Vehicle ZX-002 | speed=108.0 km/h | ts=2024-01-01T12:00:00.500000+00:00",
    }


def test_stored_history_keeps_each_alert_once_and_expires_days(spark, tmp_path):
    rows = [("high_speed", "medium", "a", "m", BASE + dt.timedelta(days=d, hours=h), f"e{d}-{h}") for d in range(4) for h in (1, 23)]
    fired = spark.createDataFrame(rows, "rule string, severity string, vehicle_id string, message string, ts timestamp, event_id string")
    kept = A.AlertHistory(str(tmp_path / "history"), ttl_days=30)
    first, later = fired.filter(F.col("event_id") < "e2"), fired
    assert (kept.append(first, "b1"), kept.append(first, "b1"), kept.append(later, "b2")) == (4, 0, 4)
    start = BASE.replace(tzinfo=None)
    assert kept.rows(spark, start).count() == 8
    same = A.history(fired, 30, start).select(sorted(A.history(fired, 30, start).columns))
    stored = kept.rows(spark, start).select(same.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, same.collect()))
    # 32 days on, the first two days are gone for good, also for a reader of the past.
    kept.expire(spark, BASE + dt.timedelta(days=32))
    assert {r["event_id"][:2] for r in kept.rows(spark, start).collect()} == {"e2", "e3"}


class _Handle:
    """A key's state in memory, with a count of the calls to it."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, name, schema):
        return self.State(self)

    def getMapState(self, name, key, schema):
        return self.Map(self)

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    class State:
        def __init__(self, handle):
            self.handle, self.held = handle, None

        def exists(self):
            self.handle.calls += 1
            return self.held is not None

        def get(self):
            self.handle.calls += 1
            return self.held

        def update(self, value):
            self.handle.calls += 1
            self.held = value

        def clear(self):
            self.update(None)

    class Map(State):
        def __init__(self, handle):
            self.handle, self.held = handle, {}

        def containsKey(self, key):
            self.handle.calls += 1
            return key in self.held

        def getValue(self, key):
            self.handle.calls += 1
            return self.held[key]

        def updateValue(self, key, value):
            self.handle.calls += 1
            self.held[key] = value

        def removeKey(self, key):
            self.handle.calls += 1
            del self.held[key]

        def iterator(self):
            self.handle.calls += 1
            return iter(list(self.held.items()))

        def clear(self):
            self.update({})


def test_stream_state_is_called_less_than_twice_per_hit():
    rng = random.Random(3)
    state, handle = A.CooldownState(), _Handle()
    state.init(handle)
    hits = [Row(us=rng.randrange(4_000_000_000), event_id=f"e{i:05d}", severity="low", cooldown_us=60_000_000, message="m")
            for i in range(2000)]
    fired, before = [], 0
    assert len({h.us for h in hits}) == len(hits)
    for wm_s in (1000, 2000, 3000, 4000, 5000):  # readings come at most one batch ahead of the watermark
        came = [h for h in hits if before <= h.us < (wm_s + 500) * 1_000_000]
        before = (wm_s + 500) * 1_000_000
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: wm_s * 1000)
        assert not list(state.handleInputRows(("r", "v"), iter(came), now))
        for t in sorted(t for t in handle.timers if t <= wm_s * 1000):
            handle.timers.remove(t)
            fired += state.handleExpiredTimer(("r", "v"), now, SimpleNamespace(getExpiryTimeInMs=lambda: t))
    assert handle.calls < 2 * len(hits)
    want, until = [], None
    for h in sorted(hits, key=lambda h: (h.us, h.event_id)):
        if until is None or h.us >= until:
            until = h.us + h.cooldown_us
            want.append(h.event_id)
    assert [f.event_id for f in fired] == want


def test_stored_alerts_are_evaluated_once_for_all_appends(spark, monkeypatch):
    from roadlens.operators import alerts as A
    from roadlens.plans import q_alerts

    plans, append = [], A.AlertHistory.append
    monkeypatch.setattr(q_alerts, "_HISTORY", {})
    monkeypatch.setattr(A.AlertHistory, "append", lambda self, fired, batch=None: plans.append(
        fired._jdf.queryExecution().optimizedPlan().toString()) or append(self, fired, batch))
    rows = q_alerts.stored_alerts(spark, "/root/testdata/sf0.001").rows(spark, q_alerts.AS_OF)
    assert rows.count() == rows.select("alert_id", "ts").distinct().count() > 0
    assert len(plans) == 3 and not any("MapInPandas" in p for p in plans)


def test_waiting_hits_share_state_rows():
    # Under a call per five hits (two rows a hit before), rows of bounded size, and frames as rows.
    rng = random.Random(5)
    hits = [Row(us=rng.randrange(4_000_000_000), event_id=None if i == 7 else f"e{i:05d}", severity="low", cooldown_us=60_000_000,
                message=f"{i} km/h °") for i in range(20_000)]
    out = []
    for state, given in ((A.CooldownState(), iter), (A.CooldownFrames(), lambda came: (pd.DataFrame(came[i:i + 3000], columns=A.HIT)
                                                                                        for i in range(0, len(came), 3000)))):
        handle, fired = _Handle(), []
        state.init(handle)
        for wm_s, came in ((0, hits[:12_000]), (1500, hits[12_000:]), (2500, []), (9000, [])):
            now = SimpleNamespace(getCurrentWatermarkInMs=lambda: wm_s * 1000)
            assert not list(state.handleInputRows(("r", "v"), given([h for h in came if h.us > wm_s * 1_000_000]), now))
            assert max((len(json.loads(v[1])) for v in state.waiting.held.values()), default=0) <= A.ROW_HITS
            for t in sorted(t for t in handle.timers if t <= wm_s * 1000):
                handle.timers.remove(t)
                fired += [tuple(r) for f in state.handleExpiredTimer(("r", "v"), now, SimpleNamespace(getExpiryTimeInMs=lambda: t))
                          for r in (f.itertuples(index=False) if isinstance(f, pd.DataFrame) else [f])]
        assert handle.calls < len(hits) / 5 and not state.waiting.held
        out.append(fired)
    want, until = [], None
    for h in sorted([*hits[:12_000], *(h for h in hits[12_000:] if h.us > 1_500_000_000)], key=lambda h: (h.us, h.event_id or "")):
        if until is None or h.us >= until:
            until = h.us + h.cooldown_us
            want.append(("r", "low", "v", h.us, h.event_id, h.cooldown_us, h.message))
    assert out[0] == out[1] == want
