"""Scalar column helpers (all built-in Spark expressions, no UDFs)."""

from roadlens.functions.numeric import magnitude, round_half_up
from roadlens.functions.time import (
    lookback_start,
    minute_bucket,
    time_bucket,
    time_parts,
    to_ntz,
)

__all__ = [
    "magnitude",
    "round_half_up",
    "lookback_start",
    "minute_bucket",
    "time_bucket",
    "time_parts",
    "to_ntz",
]
