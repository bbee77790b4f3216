"""Integer arithmetic on payload values, widened before it can overflow."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_diff(a: Column, b: Column) -> Column:
    """``a - b`` of two smallints, computed as int (never overflows)."""
    return (a.cast("int") - b.cast("int")).alias("diff")


def elo_band(points: Column, floor: int = 2000, width: int = 100) -> Column:
    """Rating band: everything at or below ``floor`` is ``floor``, above it
    the value rounded down to a multiple of ``width``. NULL stays NULL."""
    p = points.cast("int")
    return F.when(p <= F.lit(floor), F.lit(floor)).otherwise((F.floor(p / F.lit(width)) * F.lit(width)).cast("int"))
