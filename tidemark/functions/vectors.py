"""Dense-vector helpers on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def round_vector(vec: str | Column, decimals: int) -> Column:
    v = F.col(vec) if isinstance(vec, str) else vec
    # + 0.0 turns a rounded -0.0 into 0.0, so equal vectors compare equal.
    return F.transform(v, lambda x: F.round(x, decimals) + F.lit(0.0))
