"""F1-F3 against brute-force pandas on a small fixture with a hot vehicle
and readings on bucket edges."""

import datetime as dt
import random

import pandas as pd

from roadlens.operators import features as FT

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def can_fixture(spark, n=800, seed=1, span=40.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = "ZX-HOT" if i % 3 == 0 else f"ZX-{rng.randrange(5):03d}"
        # Whole-second times put readings exactly on bucket edges too.
        sec = rng.randrange(int(span)) if i % 4 == 0 else rng.uniform(0, span)
        rows.append((f"c{i:04d}", v, BASE + dt.timedelta(seconds=sec), i, rng.randrange(64) / 4,
                     rng.random() < 0.3, rng.random() < 0.2))
    return spark.createDataFrame(
        rows, "event_id string, vehicle_id string, timestamp timestamp, sequence_number long, "
              "speed_ms double, hard_braking boolean, engine_overheating boolean")


def test_rolling_matches_brute_force(spark):
    can = can_fixture(spark)
    win = 5_000_000
    got = FT.rolling_features(can, win).toPandas().set_index("event_id").sort_index()
    pdf = can.toPandas()
    pdf["us"] = pdf["timestamp"].astype("datetime64[us]").astype("int64")
    exp = {}
    for _, r in pdf.iterrows():
        m = pdf[(pdf.vehicle_id == r.vehicle_id) & (pdf.us <= r.us) & (pdf.us >= r.us - win)]
        exp[r.event_id] = (m.speed_ms.mean(), int(m.hard_braking.sum()), int(m.engine_overheating.sum()))
    for eid, (a, h, o) in exp.items():
        g = got.loc[eid]
        assert abs(g.avg_speed_ms_1h - a) < 1e-12
        assert g.hard_brake_count_1h == h and g.engine_overheating_count_1h == o


def test_align_matches_brute_force(spark):
    can = can_fixture(spark, 400, seed=2)
    imu = can_fixture(spark, 400, seed=3).selectExpr(
        "vehicle_id", "timestamp", "sequence_number", "speed_ms AS accel_magnitude")
    tol = 1_000_000
    got = FT.align_imu(can, imu, tol).toPandas().set_index("event_id")
    c = can.toPandas()
    i = imu.toPandas()
    for df in (c, i):
        df["us"] = df["timestamp"].astype("datetime64[us]").astype("int64")
    for _, r in c.iterrows():
        m = i[(i.vehicle_id == r.vehicle_id) & (i.us <= r.us)]
        m = m.sort_values(["us", "sequence_number"])
        g = got.loc[r.event_id]
        if len(m) and r.us - m.us.iloc[-1] <= tol:
            assert g.accel_magnitude == m.accel_magnitude.iloc[-1]
        else:
            assert pd.isna(g.accel_magnitude)


def test_labels_match_brute_force(spark):
    can = can_fixture(spark, 400, seed=4)
    ev = can_fixture(spark, 60, seed=5).select("vehicle_id", "timestamp")
    h = 3_000_000
    got = FT.maintenance_labels(can, ev, h).toPandas().set_index("event_id")
    c, e = can.toPandas(), ev.toPandas()
    for df in (c, e):
        df["us"] = df["timestamp"].astype("datetime64[us]").astype("int64")
    for _, r in c.iterrows():
        m = e[(e.vehicle_id == r.vehicle_id) & (e.us > r.us) & (e.us <= r.us + h)]
        assert bool(got.loc[r.event_id].needs_maintenance_24h) == (len(m) > 0)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_feature_frames_only_grow(spark):
    can = can_fixture(spark, 50)
    for df in (FT.rolling_features(can), FT.maintenance_labels(can, can.select("vehicle_id", "timestamp"), 10**6)):
        frames = [x for x in plan_of(df).splitlines() if "specifiedwindowframe" in x.lower()]
        assert frames and all("unboundedpreceding$(), currentrow$()" in x.lower() for x in frames)
    # One shuffle: the probes meet their readings where the window left them.
    assert plan_of(FT.rolling_features(can)).split("== Physical Plan ==")[1].count("Exchange") == 1


def test_rolling_with_ties_nulls_and_long_vehicles(spark):
    t = [BASE + dt.timedelta(seconds=s) for s in (0, 0, 3600, 3600.000001, 7200)]
    rows = [(f"e{i}", "v", x, i, sp, hb, None) for i, (x, sp, hb) in enumerate(
        zip(t, (1.0, None, 4.0, float("nan"), 2.0), (True, True, None, False, True)))]
    rows += [("n1", "v", None, 9, 8.0, True, True), ("n2", None, t[0], 9, 8.0, True, True), ("e0", "v", t[0], 0, 1.0, True, None)]
    can = spark.createDataFrame(rows, "event_id string, vehicle_id string, timestamp timestamp, sequence_number long, "
                                      "speed_ms double, hard_braking boolean, engine_overheating boolean")
    got = sorted((r.event_id, r.avg_speed_ms_1h, r.hard_brake_count_1h, r.engine_overheating_count_1h)
                 for r in FT.rolling_features(can).collect())
    assert got == [("e0", 1.0, 3, 0), ("e0", 1.0, 3, 0), ("e1", 1.0, 3, 0), ("e2", 2.0, 3, 0), ("e3", 4.0, 0, 0),
                   ("e4", 3.0, 1, 0), ("n1", 8.0, 1, 1), ("n2", 8.0, 1, 1)]


def test_next_event_at_the_edges_of_the_horizon(spark):
    at = lambda s: BASE + dt.timedelta(seconds=s)
    rd = spark.createDataFrame([("a", "v", at(0)), ("b", "v", at(24)), ("c", "v", at(0.000001)), ("d", "w", at(0))],
                               "event_id string, vehicle_id string, timestamp timestamp")
    ev = spark.createDataFrame([("v", at(24)), ("v", at(24)), ("v", at(100)), (None, at(5))], "vehicle_id string, timestamp timestamp")
    got = {r.event_id: r.next_maintenance and r.next_maintenance.replace(tzinfo=dt.timezone.utc)
           for r in FT.maintenance_labels(rd, ev, 24_000_000).collect()}
    assert got == {"a": at(24), "b": None, "c": at(24), "d": None}
    late = FT.maintenance_labels(rd, ev, 76_000_000).filter("event_id = 'b'").first()
    assert late.needs_maintenance_24h


def test_model_input_decodes_readings_once_and_joins_nothing(spark):
    from roadlens.operators import features as FT
    from roadlens.plans import q_ml, tables
    from roadlens.plans.q_features import HORIZON_US, ROLLING_US, maintenance_log

    sf = "/root/testdata/sf0.001"
    made = q_ml._labelled_readings(spark, sf)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert plan.count("from_json") == 3  # can_bus once; the log of maintenance feeds two parts
    can = tables.can_bus_events(spark, sf)
    feats = FT.rolling_features(can, ROLLING_US).drop("vehicle_id", "timestamp")
    labels = FT.maintenance_labels(can, maintenance_log(spark, sf), HORIZON_US).select("event_id", "needs_maintenance_24h")
    joined = can.join(feats, "event_id").join(labels, "event_id").select(*made.columns)
    assert joined.count() > 0 and sorted(map(str, made.collect())) == sorted(map(str, joined.collect()))
