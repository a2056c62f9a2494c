"""Filters, deduplication and constraint validation: T1-T6, T9, S5, S6.

S5 is the per-record model validation of the ingest path, re-aimed as a
set operator: each declared constraint compiles to a Catalyst boolean, the
names of the failed ones are collected into a ``violations`` array, and the
frame splits into valid rows and a quarantine. Defaults fill optional nulls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.enrich import enrich
from roadlens.schemas import (
    DEFAULTS,
    ENVELOPE_CONSTRAINTS,
    PAYLOAD_CONSTRAINTS,
    SANITY_BOUNDS,
    Constraint,
)


def sanity_checks(sensor: str) -> list[tuple[str, Column]]:
    """(name, true where the reading fails) for each bound of the sensor.
    A missing value fails; a sensor without bounds has no checks."""
    return [(f"{c.column}:range", F.col(c.column).isNull() | _check(c)[1]) for c in SANITY_BOUNDS.get(sensor, [])]


def _with_inputs(df: DataFrame, sensor: str) -> DataFrame:
    """``df`` with the derived columns that the sensor's bounds look at."""
    absent = {c.column for c in SANITY_BOUNDS.get(sensor, [])} - set(df.columns)
    return enrich(df, sensor) if absent else df


def filter_invalid(df: DataFrame, sensor: str) -> DataFrame:
    """The readings that fail no check. A derived column that a bound
    looks at is added where it is absent."""
    failed = [bad for _, bad in sanity_checks(sensor)]
    return _with_inputs(df, sensor).filter(~reduce(Column.__or__, failed)) if failed else df


def sanity_drops(df: DataFrame, sensor: str) -> DataFrame:
    """How many readings each check of T1-T4 drops: sensor_type, rule, rows (0
    where it drops none). A reading that fails two checks counts for both."""
    checks = sanity_checks(sensor)
    counts = _with_inputs(df, sensor).agg(
        *[F.count_if(bad).alias(f"n{i}") for i, (_, bad) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(sensor).alias("sensor_type"), F.lit(name).alias("rule"), F.col(f"n{i}").alias("rows"))
                     for i, (name, _) in enumerate(checks)])
    return counts.select(F.inline(rows))


#: Of the copies of an event, the first by these stays.
DEDUP_ORDER = ("ingested_at", "topic", "partition", "offset")


def deduplicate(
    df: DataFrame,
    key: str = "event_id",
    order_by: tuple[str, ...] = DEDUP_ORDER,
) -> DataFrame:
    """T5 (batch): keep one row per key, the first by ``order_by``.

    Written as an aggregate (``min_by`` of the whole row) rather than a window:
    the partial aggregate collapses copies on the map side before the shuffle,
    so a key repeated in a third of all rows never lands whole in one task.
    """
    order = [c for c in order_by if c in df.columns and c != key]
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    if not order:
        return df.dropDuplicates([key])
    picked = df.groupBy(key).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order])).alias("_r")
    )
    return picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def deduplicate_stream(df: DataFrame, key: str = "event_id") -> DataFrame:
    """T5 (stream): watermark-bounded dedup; the watermark is set upstream."""
    return df.dropDuplicatesWithinWatermark([key])


def hard_braking_only(df: DataFrame) -> DataFrame:
    """T6."""
    return df.filter(F.col("hard_braking"))


def anomalies_only(df: DataFrame) -> DataFrame:
    """T6."""
    return df.filter(F.col("is_anomaly"))


def engine_trouble() -> Column:
    """Overheating or low battery or worn brakes."""
    return (
        F.col("engine_overheating")
        | F.col("low_battery")
        | (F.col("brake_wear_pct") > 80)
    )


# ---------------------------------------------------------------------------
# S5
# ---------------------------------------------------------------------------


def _check(c: Constraint) -> tuple[str, Column]:
    """(violation name, column that is true when the constraint FAILS)."""
    col = F.col(c.column)
    if c.kind == "required":
        return f"{c.column}:required", col.isNull()
    if c.kind == "prefix":
        return f"{c.column}:prefix", col.isNotNull() & ~col.startswith(c.values[0])
    if c.kind == "one_of":
        return f"{c.column}:one_of", col.isNotNull() & ~col.isin(list(c.values))
    if c.kind == "range":
        bad = F.lit(False)
        if c.lo is not None:
            bad = bad | (col < F.lit(c.lo))
        if c.hi is not None:
            bad = bad | ((col >= F.lit(c.hi)) if c.hi_open else (col > F.lit(c.hi)))
        return f"{c.column}:range", col.isNotNull() & bad
    raise ValueError(c.kind)


def constraints_for(sensor: str) -> list[Constraint]:
    return ENVELOPE_CONSTRAINTS + PAYLOAD_CONSTRAINTS.get(sensor, [])


def with_violations(df: DataFrame, sensor: str) -> DataFrame:
    """Add ``violations`` (array of failed constraint names, empty when valid)
    and apply declared defaults to optional null fields."""
    checks = [_check(c) for c in constraints_for(sensor) if c.column in df.columns]
    names = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]) if checks else F.array()
    defaults = {**DEFAULTS["_envelope"], **DEFAULTS.get(sensor, {})}
    filled = {
        k: F.coalesce(F.col(k), F.lit(v).cast(df.schema[k].dataType))
        for k, v in defaults.items()
        if k in df.columns
    }
    return df.withColumns(filled).withColumn(
        "violations", F.filter(names, lambda x: x.isNotNull())
    )


def split_valid(df: DataFrame, sensor: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the violations column, quarantined rows with it)."""
    checked = with_violations(df, sensor)
    ok = checked.filter(F.size("violations") == 0).drop("violations")
    bad = checked.filter(F.size("violations") > 0)
    return ok, bad


def validation_stats(checked: DataFrame) -> DataFrame:
    """Per sensor, rows checked, valid and rejected, and rejects per rule."""
    per_rule = (
        checked.select("sensor_type", F.explode("violations").alias("violation"))
        .groupBy("sensor_type", "violation")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    totals = checked.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(F.size("violations") == 0).alias("valid"),
        F.count_if(F.size("violations") > 0).alias("rejected"),
    )
    return totals, per_rule
