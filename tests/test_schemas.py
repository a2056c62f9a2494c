"""Cases carried over from the reference's schema tests (FIXTURES §5),
run through the set-oriented validation (S5) and serialisation (S7)."""

import datetime as dt

from pyspark.sql import functions as F

from roadlens.operators.enrich import enrich_can_bus
from roadlens.operators.validate import split_valid, with_violations
from roadlens.schemas import SENSOR_SCHEMAS
from roadlens.sources.kafka import parse_messages, to_messages

T0 = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone.utc)


def gps_row(**kw):
    row = dict(event_id="e1", vehicle_id="ZX-001", sensor_type="gps", timestamp=T0,
               sequence_number=0, ingested_at=T0, latitude=37.386, longitude=-122.083,
               altitude_m=10.0, speed_ms=5.0, heading_deg=90.0, accuracy_m=1.2, num_satellites=12)
    row.update(kw)
    return row


def gps_df(spark, *rows):
    schema = SENSOR_SCHEMAS["gps"]
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)


def test_valid_gps_accepted(spark):
    ok, bad = split_valid(gps_df(spark, gps_row()), "gps")
    assert ok.count() == 1 and bad.count() == 0
    assert ok.first()["sensor_type"] == "gps"


def test_bad_vehicle_rejected_names_prefix(spark):
    _, bad = split_valid(gps_df(spark, gps_row(vehicle_id="BAD-001")), "gps")
    v = bad.first()["violations"]
    assert any("vehicle_id:prefix" == x for x in v)


def test_bad_latitude_rejected(spark):
    _, bad = split_valid(gps_df(spark, gps_row(latitude=91.0)), "gps")
    assert bad.first()["violations"] == ["latitude:range"]


def test_heading_upper_bound_is_open(spark):
    _, bad = split_valid(gps_df(spark, gps_row(heading_deg=360.0)), "gps")
    assert bad.first()["violations"] == ["heading_deg:range"]


def test_serialise_key_and_value(spark):
    msg = to_messages(gps_df(spark, gps_row(event_id="id-2", vehicle_id="ZX-002"))).first()
    assert msg["topic"] == "av.telemetry.gps"
    assert bytes(msg["key"]) == b"ZX-002"
    assert "id-2" in bytes(msg["value"]).decode() and "gps" in bytes(msg["value"]).decode()


def test_round_trip_decode(spark):
    msgs = to_messages(gps_df(spark, gps_row()))
    back = parse_messages(msgs.withColumns({"partition": F.lit(0), "offset": F.lit(0)}), SENSOR_SCHEMAS["gps"])
    r = back.first()
    assert r["latitude"] == 37.386 and r["timestamp"].replace(tzinfo=None) == T0.replace(tzinfo=None)


def test_malformed_json_dropped(spark):
    df = spark.createDataFrame([("t", 0, 0, bytearray(b"{oops"))], "topic string, partition int, offset long, value binary")
    assert parse_messages(df, SENSOR_SCHEMAS["gps"]).count() == 0


def test_hard_brake_flag(spark):
    schema = SENSOR_SCHEMAS["can_bus"]
    vals = dict(event_id="c1", vehicle_id="ZX-001", sensor_type="can_bus", timestamp=T0, sequence_number=0,
                ingested_at=T0, speed_ms=10.0, steering_angle_deg=0.0, throttle_pct=0.0,
                brake_pressure_pct=85.0, gear="D", engine_rpm=2000.0, engine_temp_celsius=90.0,
                oil_pressure_kpa=300.0, battery_voltage=12.6, odometer_km=1000.0, brake_wear_pct=10.0,
                turn_signal=None)
    df = spark.createDataFrame([tuple(vals[f.name] for f in schema.fields)], schema)
    r = enrich_can_bus(df).first()
    assert r["brake_pressure_pct"] == 85.0 and r["hard_braking"] is True
    assert with_violations(df, "can_bus").first()["violations"] == []


def test_defaults_fill_optional_fields(spark):
    schema = SENSOR_SCHEMAS["lidar"]
    vals = dict(event_id="l1", vehicle_id="ZX-001", sensor_type="lidar", timestamp=T0, sequence_number=None,
                ingested_at=T0, scan_id="s", point_count=10, range_min_m=0.1, range_max_m=50.0,
                field_of_view_deg=360.0, scan_duration_ms=100.0, obstacles_detected=None,
                closest_obstacle_m=None)
    df = spark.createDataFrame([tuple(vals[f.name] for f in schema.fields)], schema)
    r = with_violations(df, "lidar").first()
    assert r["obstacles_detected"] == 0 and r["sequence_number"] == 0 and r["violations"] == []
