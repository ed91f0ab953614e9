"""Scalar helpers shared by operators and oracle-facing queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c, digits: int = 6) -> Column:
    """Round a value for engine-independent comparison; ``+ 0.0`` turns -0.0 into 0.0."""
    return F.round(as_col(c).cast("double"), digits) + F.lit(0.0)


def safe_div(num, den) -> Column:
    """num / den, or NULL when den is 0 or NULL (never raises under ANSI mode)."""
    return F.try_divide(as_col(num), as_col(den))
