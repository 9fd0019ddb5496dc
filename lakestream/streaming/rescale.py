"""Move a stream's running averages out of Spark's state store, whose number of partitions is fixed.

A stream that keeps its averages in Spark's state (``run_enrichment`` with
``broadcast=True`` or ``False``) has as many state partitions as it had when its
checkpoint was made. :func:`adopt_state` reads that state with Spark's state data source,
writes the groups' sums and counts as the base that
:func:`lakestream.streaming.running.running_means` adds to, and makes a
checkpoint that goes on where the old one stands: its logs of offsets and commits are
copied, its state isn't. A ``broadcast="checked"`` stream started there counts no message
twice and misses none, with any number of shuffle partitions, which may change at
every later start.

The state is read and written by tasks; the driver copies logs. The old
checkpoint stays as it is. Its stream must have ended: of a batch that was
planned but not committed only the offsets are taken, and the new stream computes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.schemas import MEASURES, STAT_KEYS
from lakestream.sources.versions import _conf, _jpath, delete_folder, file_names, put_in_place, staged_path

#: What of a checkpoint tells where its stream stands.
_LOGS = ("metadata", "sources", "offsets", "commits")


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The number of the checkpoint's last committed batch."""
    done = [int(n) for n in file_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        raise FileNotFoundError(f"{checkpoint} has no committed batch")
    return max(done)


def state_sums(spark: SparkSession, checkpoint: str, keys: Sequence[str] = STAT_KEYS, measures: Sequence[str] = MEASURES,
               batch_id: int | None = None) -> DataFrame:
    """``keys``, ``sum_<m>`` and ``n_<m>`` of a stateful stream of averages after ``batch_id`` (its last committed batch).

    Spark keeps an average as its sum and count, one after the other for each measure.
    """
    at = last_committed(spark, checkpoint) if batch_id is None else batch_id
    rows = spark.read.format("statestore").option("batchId", at).load(checkpoint)
    if len(rows.schema["key"].dataType.fields) != len(keys) or len(rows.schema["value"].dataType.fields) != 2 * len(measures):
        raise ValueError(f"the state of {checkpoint} isn't that of averages of {list(measures)} by {list(keys)}")
    totals = ", ".join(f"sum_{m}: double, n_{m}: bigint" for m in measures)
    rows = rows.select("key", F.col("value").cast(f"struct<{totals}>").alias("value"))
    pairs = [(F.when(F.col(f"value.n_{m}") > 0, F.col(f"value.sum_{m}")).alias(f"sum_{m}"), F.col(f"value.n_{m}")) for m in measures]
    return rows.select(*[F.col(f"key.`{k}`") for k in keys], *[c for pair in pairs for c in pair])


def adopt_state(spark: SparkSession, old_checkpoint: str, checkpoint: str, state: str | None = None,
                keys: Sequence[str] = STAT_KEYS, measures: Sequence[str] = MEASURES) -> int:
    """Make ``checkpoint`` and ``state`` (beside it by default) go on from a stateful stream; returns its last batch's number.

    Both must be new. A call that was cut short can be repeated: the checkpoint
    appears last and whole.
    """
    if file_names(spark, checkpoint):
        raise FileExistsError(f"{checkpoint} is there already")
    state, at = state or f"{checkpoint}-state", last_committed(spark, old_checkpoint)
    if file_names(spark, f"{state}/deltas"):
        raise FileExistsError(f"{state} has batches of another stream")
    delete_folder(spark, f"{state}/base")  # of a call that was cut short
    staged = staged_path(f"{state}/base/{at}")
    state_sums(spark, old_checkpoint, keys, measures, at).write.parquet(staged)
    put_in_place(spark, staged, f"{state}/base/{at}")
    conf, made = _conf(spark), staged_path(checkpoint)
    for log in _LOGS:
        here, there = _jpath(spark, f"{old_checkpoint}/{log}"), _jpath(spark, f"{made}/{log}")
        fs = here.getFileSystem(conf)
        if fs.exists(here):
            target = there.getFileSystem(conf)
            target.mkdirs(there.getParent())
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, here, target, there, False, conf)
    put_in_place(spark, made, checkpoint)
    return at
