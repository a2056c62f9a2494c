"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int) -> Column:
    """Round half-up through a fixed-point decimal.

    ``round`` on a double depends on the last bits of the input, and those bits
    depend on summation order (partitioning, engine). Going through
    ``decimal(38,12)`` first makes the rounded aggregate independent of the
    order in which partial sums were combined.
    """
    return F.round(_col(c).cast("decimal(38,12)"), scale).cast("double")


def magnitude(*cols) -> Column:
    """Euclidean norm of the given columns."""
    acc = None
    for c in cols:
        sq = _col(c) * _col(c)
        acc = sq if acc is None else acc + sq
    return F.sqrt(acc)
