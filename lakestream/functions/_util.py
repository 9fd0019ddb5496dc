from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_col(c: Column | str) -> Column:
    """A column reference; plain names are quoted so dots stay literal."""
    if isinstance(c, Column):
        return c
    return F.col(f"`{c}`")
