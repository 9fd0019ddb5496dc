"""Running averages of a stream whose dimension may change and grow: sums of each micro-batch, joined anew.

Spark plans a stateful streaming query once, so its join can neither see a file
dimension's new rows nor give up a broadcast that has become too large. Here
each micro-batch is a batch query of its own: the dimension is looked up, measured
and joined as it is now (broadcast below the bound, counts shuffled beyond it), and
the batch leaves one row of sums and counts a group, its *delta*:

* ``<state>/deltas/<batch>``: the batch's sums; a replay replaces its own;
* ``<state>/base/<batch>``: the sums of all batches up to that one, made every
  ``compact_every`` batches from the base before and the deltas since, after
  which those are deleted. It is written aside and renamed, so it is whole or absent;
* ``<state>/snapshots/<batch>.json``: the dimension's version that the batch used
  (:func:`pinned_versions`), so a replay joins the same rows.

An event is joined once, to the dimension at its batch, as in Spark's own
stream-static join. The averages of a batch's groups are the sums of the base,
the later deltas and its own. State grows with the number of groups.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.functions import as_double, is_utf8, parsed_once, run_timestamp, utf8_text
from lakestream.operators import drop_shared_columns, enrich, fits_broadcast, numeric_rows, require_not_null
from lakestream.operators.enrich import DEFAULT_MAX_BROADCAST_BYTES
from lakestream.plans.medallion import NOT_NULL_KEYS, used_dimension_columns
from lakestream.schemas import ATHLETE_KEY, MEASURES, RESULT_EVENT_SCHEMA, STAT_KEYS, TIMESTAMP_COL
from lakestream.sources.versions import (delete_folder, file_names, get_text, put_in_place, put_text, read_version, staged_path,
                                         version_numbers)
from lakestream.streaming.fanout import BatchFunction, Sink, fan_out

Dimension = Callable[[int], DataFrame]


def pinned_versions(spark: SparkSession, path: str, state: str) -> Dimension:
    """Reader of a versioned table for :func:`running_means`: its latest version when a batch first runs, the same on replay."""
    def read(batch_id: int) -> DataFrame:
        log = f"{state}/snapshots/{batch_id}.json"
        known = get_text(spark, log)
        if known is None:
            put_text(spark, log, json.dumps({"version": version_numbers(spark, path)[-1]}))
            known = get_text(spark, log)
        return read_version(spark, path, json.loads(known)["version"])
    return read


def split_messages(messages: DataFrame, schema=RESULT_EVENT_SCHEMA) -> DataFrame:
    """``key``, ``value`` as text, ``is_utf8``, ``data`` (the parsed value) and ``good``.

    A message is not good if its bytes are broken or the schema makes nothing of them.
    """
    parsed = messages.select(utf8_text("key").alias("key"), utf8_text("value").alias("value"),
                             F.coalesce(is_utf8("value"), F.lit(True)).alias("is_utf8"),
                             parsed_once("value", schema).alias("data"))
    some = reduce(lambda a, b: a | b, [F.col(f"data.`{f}`").isNotNull() for f in schema.fieldNames()])
    return parsed.withColumn("good", some & F.col("is_utf8"))


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n) for n in file_names(spark, folder) if n.isdigit())


def batch_sums(events: DataFrame, dim: DataFrame, key: str, keys: Sequence[str], measures: Sequence[str],
               max_broadcast_bytes: int) -> DataFrame:
    """``sum_<m>`` and ``n_<m>`` of each group of a batch.

    A dimension that measures below the bound is broadcast to the events; else
    they are counted per key and group first, and only the counts are shuffled.
    """
    events = drop_shared_columns(events, dim, key)
    if fits_broadcast(dim, max_broadcast_bytes):
        weighed = events.withColumn("_events", F.lit(1).cast("long"))
        joined = enrich(weighed, dim, key, "inner", broadcast=True, drop_shared=False)
    else:
        counts = events.groupBy(key, *[k for k in keys if k in events.columns]).agg(F.count("*").alias("_events"))
        joined = enrich(counts, dim, key, "inner", broadcast=False, skew="split", drop_shared=False)
    kept = require_not_null(joined.select(*keys, *measures, "_events"), [k for k in NOT_NULL_KEYS if k in keys])
    sums = []
    for m in measures:
        v = as_double(kept[m])
        sums += [F.sum(v * kept["_events"]).alias(f"sum_{m}"),
                 F.coalesce(F.sum(F.when(v.isNotNull(), kept["_events"])), F.lit(0).cast("long")).alias(f"n_{m}")]
    return kept.groupBy(*keys).agg(*sums)


def running_means(state: str, dimension: Dimension, *sinks: Sink, rejected: Sequence[Sink] = (), key: str = ATHLETE_KEY,
                  keys: Sequence[str] = STAT_KEYS, measures: Sequence[str] = MEASURES, schema=RESULT_EVENT_SCHEMA, run_ts=None,
                  digits: int | None = None, finite_only: bool = False, compact_every: int = 16,
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> BatchFunction:
    """A ``foreachBatch`` function over messages: the new averages of the groups that a batch changes, to all ``sinks``.

    ``dimension`` is called with the batch's number and gives the rows to join.
    Messages that aren't good (:func:`split_messages`) count nowhere and go to
    the ``rejected`` sinks, from the same pass.
    """
    totals = [f"{p}_{m}" for m in measures for p in ("sum", "n")]
    write, write_rejected = fan_out(*sinks), fan_out(*rejected)

    def added(df: DataFrame, *more) -> DataFrame:
        return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in totals), *more)

    def before(spark: SparkSession, batch_id: int) -> tuple[list[str], int, int]:
        """Folders that hold the sums of the batches before, the last of the base, and how many follow it."""
        bases = [n for n in _numbers(spark, f"{state}/base") if n < batch_id]
        upto = bases[-1] if bases else -1
        deltas = [n for n in _numbers(spark, f"{state}/deltas") if upto < n < batch_id]
        return ([f"{state}/base/{upto}"] if bases else []) + [f"{state}/deltas/{n}" for n in deltas], upto, len(deltas)

    def compact(spark: SparkSession, batch_id: int) -> None:
        """The batches before this one are done, so no replay asks for less than all of them."""
        folders, upto, since = before(spark, batch_id)
        if since < compact_every:
            return
        staged = staged_path(f"{state}/base/{batch_id - 1}")
        added(spark.read.parquet(*folders)).write.parquet(staged)
        put_in_place(spark, staged, f"{state}/base/{batch_id - 1}")
        for folder in folders:
            delete_folder(spark, folder)

    def run(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        compact(spark, batch_id)
        split = split_messages(messages, schema)
        if rejected:
            split = split.persist()
        try:
            if rejected:
                write_rejected(split.where(~F.col("good")).select("key", "value", "is_utf8"), batch_id)
            events = split.where("good").select("data.*")
            dim = used_dimension_columns(numeric_rows(dimension(batch_id), measures, finite_only=finite_only), key)
            own = f"{state}/deltas/{batch_id}"
            batch_sums(events, dim, key, keys, measures, max_broadcast_bytes).write.mode("overwrite").parquet(own)
        finally:
            if rejected:
                split.unpersist()
        now = spark.read.parquet(own)
        folders, _, _ = before(spark, batch_id)
        parts = now.withColumn("_new", F.lit(True))
        if folders:
            parts = parts.unionByName(spark.read.schema(now.schema).parquet(*folders).withColumn("_new", F.lit(False)))
        changed = added(parts, F.max("_new").alias("_new")).where("_new")
        means = [F.col(f"sum_{m}") / F.col(f"n_{m}") for m in measures]
        if digits is not None:
            means = [F.round(a, digits) for a in means]
        stats = changed.select(*keys, *(a.alias(f"avg_{m}") for a, m in zip(means, measures)), run_timestamp(run_ts).alias(TIMESTAMP_COL))
        write(stats, batch_id)

    return run
