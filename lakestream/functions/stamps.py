"""Run timestamps and micro-batch tags."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_timestamp(run_ts: str | _dt.datetime | None = None) -> Column:
    """The computation time of a run.

    ``localtimestamp()`` is evaluated once per query (once per micro-batch
    in a stream), so every row of one run carries the same value. Passing
    ``run_ts`` pins it to a literal, for reproducible runs and tests. Both are
    zone-less (TIMESTAMP_NTZ, the session's local time), so the type of a
    table doesn't depend on the argument.
    """
    if run_ts is None:
        return F.localtimestamp()
    return F.lit(run_ts).cast("timestamp_ntz")


def batch_tag(batch_id: int) -> Column:
    """The micro-batch number as a string literal (the original tag type)."""
    return F.lit(str(batch_id))
