"""Numeric validity and safe coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestream.functions._util import to_col


def as_double(c: Column | str) -> Column:
    """``try_cast(c as double)``: text that is not a number becomes NULL.

    Unlike a plain cast this never raises under ANSI mode.
    """
    return to_col(c).try_cast("double")


def is_numeric(c: Column | str, finite_only: bool = False) -> Column:
    """True when ``c`` converts to a double.

    By default ``NaN`` and ``Infinity`` count as numbers (they convert);
    ``finite_only=True`` rejects them too.
    """
    d = as_double(c)
    cond = d.isNotNull()
    if finite_only:
        cond = cond & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    return cond
