"""Plan assertions: decode once, partition pruning, no cartesian products,
no Python outside the operators that need it, no joins in the as-of step."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["w1_speed_summary", "w3_engine_health", "t_valid_gps", "t_dedup"])
def test_decode_once_and_pruned(spark, name):
    p = plan(spark, name)
    # Each scan decodes once, inside the Generate; no predicate decodes again.
    # (Look-back queries scan twice: the query and its max(timestamp) subquery.)
    lines = [ln for ln in p.splitlines() if "from_json(" in ln]
    assert lines and all("Generate" in ln for ln in lines), p
    assert all(ln.count("from_json(") == 1 for ln in lines), p
    assert "PartitionFilters: [isnotnull(topic" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


@pytest.mark.parametrize("name", ["w1_speed_summary", "w2_hard_braking", "w3_engine_health", "w4_imu_vibration", "w5_throughput"])
def test_summaries_decode_their_columns_only(spark, name):
    """The decoder's schema: the summary's inputs, the filter's bounds, the
    deduplication's key and order, nothing else."""
    import re

    from roadlens.operators.enrich import inputs_of
    from roadlens.operators.windows import SUMMARIES
    from roadlens.schemas import SANITY_BOUNDS, SENSOR_SCHEMAS

    df = E.queries()[name](spark, SF)
    p = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    decoded = [set(re.findall(r"StructField\((\w+),", ln)) for ln in p.splitlines() if "from_json(StructField" in ln]
    assert decoded, p
    key = name[:2]
    sensors = [SUMMARIES[key].sensor] if key in SUMMARIES else ["gps", "imu", "can_bus"]
    reads = SUMMARIES[key].reads if key in SUMMARIES else ("timestamp", "sensor_type", "vehicle_id", "event_id")
    allowed = {s: set(inputs_of(s, [*reads, *(c.column for c in SANITY_BOUNDS[s])])) | {"event_id", "ingested_at", "vehicle_id"}
               for s in sensors}
    for fields in decoded:
        assert any(fields <= allowed[s] for s in sensors), fields
        assert len(fields) < min(len(SENSOR_SCHEMAS[s].fields) for s in sensors)


def test_asof_alignment_has_no_join(spark):
    p = plan(spark, "f2_align_imu")
    assert "Join" not in p


def test_rolling_window_is_bucketed(spark):
    p = plan(spark, "f1_rolling_features")
    assert "_bucket" in p and "Join" not in p


def test_cooldown_python_only_in_fold(spark):
    p = plan(spark, "a_cooldown_all")
    assert "MapInPandas" in p
    assert "CartesianProduct" not in p and "BatchEvalPython" not in p


def test_dedup_is_an_aggregate_not_a_window(spark):
    p = plan(spark, "t_dedup")
    assert "min_by" in p and "Window" not in p


def test_lookback_prunes_day_partitions(spark, tmp_path):
    import datetime as dt

    from roadlens.operators.serving import recent

    rows = [(f"e{i}", "ZX-001", dt.datetime(2024, 1, 1 + i % 5, 12, 0, tzinfo=dt.timezone.utc), float(i))
            for i in range(50)]
    df = spark.createDataFrame(rows, "event_id string, vehicle_id string, timestamp timestamp, speed_ms double")
    from roadlens.functions.time import time_parts

    path = str(tmp_path / "gps")
    time_parts(df, with_hour=False).write.partitionBy("year", "month", "day").parquet(path)
    table = spark.read.parquet(path)
    out = recent(table, 3600)
    p = out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    part = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters")]
    assert part and "day#" in part[0] and "Subquery" in part[0]
    assert out.count() == 10


@pytest.mark.parametrize("name", ["w1_speed_summary", "w5_throughput", "g11_last_locations", "t_dedup"])
def test_partial_aggregation_before_shuffle(spark, name):
    # A hot key is combined on the map side: a partial aggregate sits below
    # every exchange on the aggregation keys.
    p = plan(spark, name)
    assert "partial_" in p


@pytest.mark.parametrize("name", ["g1_active_vehicles", "g11_last_locations", "g15_hard_brake_leaderboard"])
def test_serving_reads_store_with_day_pruning(spark, name):
    df = E.queries()[name](spark, SF)
    p = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    part = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters")]
    assert any("day#" in ln and "Subquery" in ln for ln in part), p
    assert "from_json(" not in p


def test_first_partitions_rise_with_the_rows_and_the_callers_number_stays(spark, monkeypatch):
    from roadlens import session

    monkeypatch.setattr(session, "_SET", {})
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(session.INITIAL_PARTITIONS)
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        for rows, want in ((1000, shuffles), (400 * session.ROWS_PER_PARTITION, 400), (5000, 400)):
            session.ensure_partitions(spark, rows)
            assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == want
        spark.conf.set(session.INITIAL_PARTITIONS, "7")
        session.ensure_partitions(spark, 10**9)
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "7"
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS)
        if before is not None:
            spark.conf.set(session.INITIAL_PARTITIONS, before)
