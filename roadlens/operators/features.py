"""Time-range features: F1 trailing-hour aggregates, F2 as-of alignment of
imu readings to can_bus readings, F3 maintenance labels.

All three are range computations per vehicle. A window partitioned by vehicle
alone would put a hot vehicle's whole history in one task, so each is
partitioned by (vehicle, time bucket) instead. Rows that a neighbouring bucket
needs as context are copied into it, which keeps the result exact while a task
holds at most two buckets of one vehicle. The frames only ever grow, so the
time is linear in a bucket's rows after sorting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
#: Label buckets per horizon.
HORIZON_BUCKETS = 24


def _us(col: str = "timestamp"):
    return F.unix_micros(F.col(col))


def _bucket(width_us: int) -> Column:
    return F.floor(_us() / F.lit(width_us)).cast("long")


def rolling_features(can: DataFrame, window_us: int = HOUR_US, keep: tuple[str, ...] = ()) -> DataFrame:
    """per can_bus reading, over the trailing window (inclusive of the
    current row and of rows with the same time): average speed, hard-brake
    count, overheating count. The reading's columns ``keep`` come along.

    A window's total is the running total up to the reading less the running
    total before the window's start. Each reading therefore brings a probe to
    the start of its window, and both meet again by the reading's number; the
    input is read once and shuffled once. Speeds are added as decimals of nine
    places, so that differences of totals are exact. NaN speeds don't count.
    Readings without a time form one window of their own."""
    us, b = _us(), _bucket(window_us)
    one = F.lit(1).cast("long")
    reading = F.struct(
        F.expr("try_cast(speed_ms AS decimal(20, 9))").alias("speed"),
        F.when(F.expr("try_cast(speed_ms AS decimal(20, 9))").isNotNull(), one).otherwise(0).alias("n"),
        F.coalesce(F.col("hard_braking").cast("long"), F.lit(0)).alias("hb"),
        F.coalesce(F.col("engine_overheating").cast("long"), F.lit(0)).alias("oh"),
    )
    nothing = F.lit(None).cast("struct<speed: decimal(20, 9), n: bigint, hb: bigint, oh: bigint>")

    def copy(bucket, at, kind, what):
        kept = [(F.col(c) if kind == 1 else F.lit(None).cast(can.schema[c].dataType)).alias(f"keep_{c}") for c in keep]
        return F.struct(bucket.alias("_bucket"), at.alias("at"), F.lit(kind).alias("kind"), what.alias("x"), *kept)

    # Kinds in the order that rows of one time are added: probe, then readings (0: of the bucket before).
    copies = F.array(copy(b, us - window_us, -1, nothing), copy(b, us, 1, reading), copy(b + 1, us, 0, reading))
    rows = (
        can.withColumn("_row", F.monotonically_increasing_id())
        .select("event_id", "vehicle_id", "timestamp", "_row",
                F.explode(F.filter(copies, lambda c: c["_bucket"].isNotNull() | (c["kind"] != 0))).alias("_c"))
        .select("event_id", "vehicle_id", "timestamp", "_row", "_c.*")
    )
    w = (
        Window.partitionBy("vehicle_id", "_bucket").orderBy("at", F.col("kind") >= 0)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = ("speed", "n", "hb", "oh")
    signed = {c: F.coalesce(F.sum(f"x.{c}").over(w), F.lit(0)) * F.col("kind") for c in totals}
    ends = rows.withColumns(signed).filter("kind <> 0")
    # Still partitioned by (vehicle_id, _bucket): no further shuffle.
    both = ends.groupBy("vehicle_id", "_bucket", "_row", "event_id", "timestamp").agg(
        *[F.sum(c).alias(c) for c in totals], *[F.max(f"keep_{c}").alias(f"keep_{c}") for c in keep])
    return both.select(
        "event_id", "vehicle_id", "timestamp",
        F.when(F.col("n") > 0, F.col("speed").cast("double") / F.col("n")).alias("avg_speed_ms_1h"),
        F.col("hb").alias("hard_brake_count_1h"),
        F.col("oh").alias("engine_overheating_count_1h"),
        *[F.col(f"keep_{c}").alias(c) for c in keep],
    )


def align_imu(can: DataFrame, imu: DataFrame, tolerance_us: int = 1_000_000,
              value: str = "accel_magnitude", keep: tuple[str, ...] = ()) -> DataFrame:
    """for every can_bus reading, ``value`` of the newest imu reading of the
    same vehicle at or before it, no older than ``tolerance_us`` (else null).
    The can_bus columns ``keep`` come along.

    Union + ``last(ignorenulls)`` over (vehicle, bucket) in time order: no join
    pairs are formed. imu rows are copied into the next bucket as context.
    """
    imu_rows = imu.select(
        F.lit(None).cast("string").alias("event_id"), "vehicle_id", "timestamp",
        F.col(value).alias("_val"), F.col("timestamp").alias("_imu_ts"),
        F.lit(0).alias("_kind"), F.col("sequence_number").alias("_seq"),
        *[F.lit(None).cast(can.schema[c].dataType).alias(c) for c in keep],
    )
    can_rows = can.select(
        "event_id", "vehicle_id", "timestamp",
        F.lit(None).cast("double").alias("_val"), F.lit(None).cast("timestamp").alias("_imu_ts"),
        F.lit(1).alias("_kind"), F.col("sequence_number").alias("_seq"), *keep,
    )
    b = _bucket(tolerance_us)
    rows = imu_rows.withColumn("_bucket", F.explode(F.array(b, b + 1))).unionByName(can_rows.withColumn("_bucket", b))
    w = (
        Window.partitionBy("vehicle_id", "_bucket")
        .orderBy(_us(), "_kind", "_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    picked = rows.select(
        "event_id", "vehicle_id", "timestamp", *keep, "_kind",
        F.last(F.when(F.col("_kind") == 0, F.struct("_imu_ts", "_val")), ignorenulls=True)
        .over(w).alias("_m"),
    ).filter(F.col("_kind") == 1)
    ok = (F.col("_m._imu_ts").isNotNull()) & (
        _us() - F.unix_micros(F.col("_m._imu_ts")) <= F.lit(tolerance_us)
    )
    return picked.select(
        "event_id", "vehicle_id", "timestamp", *keep,
        F.when(ok, F.col("_m._val")).alias(value),
        F.when(ok, F.col("_m._imu_ts")).alias("imu_timestamp"),
    )


def maintenance_labels(readings: DataFrame, events: DataFrame, horizon_us: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """``needs_maintenance_24h`` = a maintenance event of the same vehicle
    strictly after the reading and within the horizon. The readings' columns
    ``keep`` come along.

    From the latest row of a bucket to the earliest, the last event seen is the
    next one of a reading. A bucket is a ``HORIZON_BUCKETS``-th of the horizon;
    the first event of each bucket is copied into the buckets before it that it
    can be the next event of."""
    width = max(1, horizon_us // HORIZON_BUCKETS)
    b = _bucket(width)
    ev = events.select("vehicle_id", "timestamp").filter("timestamp IS NOT NULL").withColumn("_bucket", b)
    back = -(-horizon_us // width)
    first = (
        ev.groupBy("vehicle_id", "_bucket").agg(F.min("timestamp").alias("timestamp"))
        .withColumn("_bucket", F.explode(F.sequence(F.col("_bucket") - back, F.col("_bucket") - 1)))
    )
    seen = ev.unionByName(first).select(
        F.lit(None).cast("string").alias("event_id"), "vehicle_id", "timestamp", "_bucket",
        F.col("timestamp").alias("_mt"), F.lit(True).alias("_is_ev"),
        *[F.lit(None).cast(readings.schema[c].dataType).alias(c) for c in keep],
    )
    rd = readings.select(
        "event_id", "vehicle_id", "timestamp", b.alias("_bucket"),
        F.lit(None).cast("timestamp").alias("_mt"), F.lit(False).alias("_is_ev"), *keep,
    )
    # Readings before events of the same time, which are not after them.
    w = (
        Window.partitionBy("vehicle_id", "_bucket").orderBy(_us().desc(), "_is_ev")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        rd.unionByName(seen)
        .select("event_id", "vehicle_id", "timestamp", *keep, "_is_ev", F.last("_mt", ignorenulls=True).over(w).alias("_next"))
        .filter(~F.col("_is_ev"))
    )
    due = F.when(F.unix_micros("_next") - _us() <= horizon_us, F.col("_next"))
    return found.select("event_id", "vehicle_id", "timestamp", *keep, due.alias("next_maintenance")).withColumn(
        "needs_maintenance_24h", F.col("next_maintenance").isNotNull()
    )
