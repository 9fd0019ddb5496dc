"""Running totals over a sorted table of any size: no task holds a whole group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestream.llm import _batches as B
from lakestream.llm._tables import written
from lakestream.operators.enrich import fits_broadcast


def running(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """The rows with ``before`` (the sum of ``value`` over the group's earlier rows) and ``total`` (over all of them).

    ``group`` (text) and ``value`` (long) hold no nulls, and ``order`` tells all
    rows of a group apart. Rows are sorted by range, so a group may lie in any
    number of partitions; each adds up its own rows, and one row for each
    partition and group tells the later ones what came before. A group's share
    of a partition fits a task, so the last join has no hot key.
    """

    def run(batches):
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups, values = B.column(batch, group), B.ints(batch, value).astype(np.int64)
            fresh = np.ones(n, bool)
            fresh[1:] = pc.not_equal(groups[1:], groups[:-1]).to_numpy(zero_copy_only=False)
            same_as_last = groups[0].as_py() == last
            sums = np.cumsum(values) - values
            starts = np.flatnonzero(fresh)
            base = sums[starts].copy()
            if same_as_last:
                base[0] -= held
            before = sums - np.repeat(base, np.diff(np.append(starts, n)))
            last, held = groups[n - 1].as_py(), int(before[-1] + values[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(before)],
                                             names=[*batch.schema.names, "range_no", "within"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    rows = written(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).mapInArrow(
        B.task(run), f"{kinds}, range_no int, within long"), name)
    sums = rows.groupBy("range_no", group).agg(F.sum(value).alias("own"))
    earlier = Window.partitionBy(group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(sums.select("range_no", group, F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("offset"),
                                  F.sum("own").over(Window.partitionBy(group)).alias("total")), f"{name}-offsets")
    joined = rows.join(F.broadcast(offsets) if fits_broadcast(offsets) else offsets, ["range_no", group])
    return joined.select(*df.columns, (F.col("within") + F.col("offset")).alias("before"), "total")
