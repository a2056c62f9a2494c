"""Property tests: the segmented cool-down equals a brute-force loop on
random hit sequences (ties, exact cool-down gaps, one hot key)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roadlens.operators import alerts as A

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = ("rule string, severity string, cooldown_s double, vehicle_id string, ts timestamp, "
          "event_id string, message string")

hit = st.tuples(
    st.sampled_from(["r60", "r300"]),
    st.sampled_from(["ZX-HOT", "ZX-HOT", "ZX-HOT", "ZX-001", "ZX-002"]),
    # Whole and half seconds over 20 minutes: many ties and exact gaps.
    st.integers(min_value=0, max_value=2400).map(lambda x: x / 2),
)


def brute(rows):
    fired, last = set(), {}
    for rule, v, t, eid, cd in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        k = (rule, v)
        if k not in last or t - last[k] >= cd:
            last[k] = t
            fired.add(eid)
    return fired


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(hit, min_size=1, max_size=120))
def test_cooldown_property(spark, hits):
    rows, plain = [], []
    for i, (rule, v, t) in enumerate(hits):
        cd = 60.0 if rule == "r60" else 300.0
        eid = f"e{i:04d}"
        rows.append((rule, "medium", cd, v, BASE + dt.timedelta(seconds=t), eid, "m"))
        plain.append((rule, v, t, eid, cd))
    cands = spark.createDataFrame(rows, SCHEMA)
    got = {r["event_id"] for r in A.apply_cooldown(cands, cut_lineage=False).collect()}
    assert got == brute(plain)
