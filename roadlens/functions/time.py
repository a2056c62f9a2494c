"""Event-time helpers (P1, T7, minute buckets)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def time_parts(df: DataFrame, ts_col: str = "timestamp", with_hour: bool = True) -> DataFrame:
    """Year, month, day (and hour) columns derived from an event-time column."""
    ts = F.col(ts_col)
    out = df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})
    if with_hour:
        out = out.withColumn("hour", F.hour(ts))
    return out


def time_bucket(ts, seconds: int) -> Column:
    """Start of the tumbling bucket of ``seconds`` that contains ``ts`` (epoch aligned)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    us = F.unix_micros(ts)
    width = F.lit(seconds * 1_000_000)
    return F.timestamp_micros(us - F.pmod(us, width))


def minute_bucket(ts) -> Column:
    """``date_trunc('minute', ts)``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("minute", ts)


def lookback_start(df: DataFrame, ts_col: str, seconds: int, as_of=None) -> Column:
    """Lower bound of a trailing look-back window.

    ``as_of`` is an explicit timestamp (string or Column); when None the
    newest event time of ``df`` is used, evaluated once as a scalar subquery
    (no join, no driver round trip).
    """
    if as_of is None:
        anchor = df.select(F.max(ts_col)).scalar()
    elif isinstance(as_of, Column):
        anchor = as_of
    else:
        anchor = F.lit(as_of).cast("timestamp")
    return anchor - F.expr(f"INTERVAL {int(seconds)} SECONDS")


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every UTC timestamp column to ``timestamp_ntz`` (zone-free results)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
