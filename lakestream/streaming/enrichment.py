"""The streaming enrichment job and its building blocks.

messages → parse JSON (fixed schema) → join the static dimension (only rows
whose measures are numeric) → running averages per group (update mode) →
fan-out of every micro-batch to the sinks.

By default the averages come from sums kept by batch (:mod:`lakestream.streaming.running`),
so every batch sees the dimension as it is and plans its join anew. Scale notes
on the form with Spark's own state: the running aggregate keeps one state row per group in the
state store of its shuffle partition, so state grows with the number of
groups, not with the number of events; there is no event-time column, so no
watermark. Each micro-batch aggregates partially before the shuffle, so a hot
group costs one row per task. The number of state partitions is fixed by
``spark.sql.shuffle.partitions`` at the first start of a checkpoint. The
dimension is re-read every micro-batch, so rows added to it are joined by
later batches.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestream.functions import as_double, is_utf8, run_timestamp
from lakestream.operators import drop_shared_columns, enrich, estimate_size, parse_json
from lakestream.operators.enrich import DEFAULT_MAX_BROADCAST_BYTES
from lakestream.plans.medallion import enriched_stats, used_dimension_columns
from lakestream.schemas import ATHLETE_KEY, BATCH_COL, MEASURES, RESULT_EVENT_SCHEMA, STAT_KEYS
from lakestream.streaming.fanout import BatchFunction, Sink, fan_out, per_batch
from lakestream.streaming.running import running_means, split_messages


def parse_results(messages: DataFrame, schema=RESULT_EVENT_SCHEMA) -> DataFrame:
    """Message ``value`` bytes → one typed column per payload field."""
    return parse_json(messages, schema)


def start(stream: DataFrame, batch_fn: BatchFunction, checkpoint: str,
          output_mode: str = "update", trigger: str | None = "available_now",
          query_name: str | None = None) -> StreamingQuery:
    """Start a checkpointed ``foreachBatch`` query.

    ``trigger="available_now"`` processes everything present (honouring the
    per-trigger rate cap) and then stops; a duration string such as
    ``"10 seconds"`` runs continuously; ``None`` runs as fast as possible.
    A restart on the same checkpoint resumes after the last committed batch.
    """
    writer = (stream.writeStream.foreachBatch(batch_fn).outputMode(output_mode)
              .option("checkpointLocation", checkpoint))
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


class DimensionTooLarge(RuntimeError):
    """The broadcast dimension of a running stream outgrew its size bound."""


def broadcast_guard(batch_fn: BatchFunction, dim: DataFrame, max_bytes: int,
                    every: int) -> BatchFunction:
    """Re-measure a broadcast dimension every ``every`` micro-batches.

    The check runs before the micro-batch is computed, so an oversized
    dimension is never broadcast: the query stops with
    :class:`DimensionTooLarge`, nothing of that batch is committed, and a
    restart on the same checkpoint measures again and plans a shuffle join.
    """
    def run(batch_df: DataFrame, batch_id: int) -> None:
        if batch_id % every == 0:
            size = estimate_size(dim).bytes
            if size > max_bytes:
                raise DimensionTooLarge(
                    f"dimension is {size} bytes, above the {max_bytes}-byte broadcast bound; "
                    "restart the query to plan a shuffle join")
        batch_fn(batch_df, batch_id)
    return run


def run_enrichment(messages: DataFrame, bio: DataFrame | Callable[[int], DataFrame], sinks: Sequence[Sink], checkpoint: str,
                   key: str = ATHLETE_KEY, run_ts=None, digits: int | None = None,
                   broadcast: bool | str = "checked", trigger: str | None = "available_now",
                   finite_only: bool = False, refresh_dimension: bool = True,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                   recheck_every: int | None = 10,
                   rejected: Sequence[Sink] | None = None, state: str | None = None,
                   compact_every: int = 16, hot: DataFrame | None = None) -> StreamingQuery:
    """The whole streaming job; returns the running query (callers may await it).

    ``broadcast="checked"``: every micro-batch measures the dimension and joins
    it as fits, and its sums are kept in the folder ``state`` (beside the
    checkpoint by default; see :mod:`lakestream.streaming.running`). ``bio`` may
    then be a function of the batch's number that reads the dimension, such as
    :func:`lakestream.streaming.running.pinned_versions`, so rows added to
    files while the stream runs are joined by later batches, and a dimension
    that outgrows the bound is joined by a shuffle from then on.
    ``broadcast=True`` or ``False`` keeps the averages in Spark's state store with
    one plan for all batches: the caller vouches for the dimension's size
    (measured again every ``recheck_every`` batches, see :func:`broadcast_guard`;
    None: never), or the join is salted, so a hot key's events meet in several
    tasks. With ``hot`` (a static frame of keys, such as those of a backlog by
    :func:`lakestream.operators.hot_keys`) only those are salted, and no batch
    shuffles the rest of the dimension more than once. ``refresh_dimension=False`` persists a dimension that is a DataFrame
    instead of re-reading it every micro-batch, until the query ends.

    ``rejected`` are sinks for messages that aren't JSON of the expected shape or
    have broken bytes. Checked streams deliver them from the same pass; the others
    by a second query, which is the ``rejected`` attribute of the one returned,
    and which :func:`await_done` awaits too.
    """
    if broadcast not in (True, False, "checked"):
        raise ValueError(f"broadcast must be True, False or 'checked', not {broadcast!r}")
    kept = None
    if not refresh_dimension and not callable(bio):
        bio = kept = bio.persist()
    if broadcast == "checked":
        read = bio if callable(bio) else lambda batch_id: bio
        batch_fn = running_means(state or f"{checkpoint}-state", read, *sinks, rejected=tuple(rejected or ()), key=key,
                                 run_ts=run_ts, digits=digits, finite_only=finite_only, compact_every=compact_every,
                                 max_broadcast_bytes=max_broadcast_bytes)
        query = start(messages, batch_fn, checkpoint, "append", trigger)
    else:
        events = parse_results(messages.where(F.coalesce(is_utf8("value"), F.lit(True))))
        stats = enriched_stats(events, bio, key, run_ts=run_ts, digits=digits, broadcast=broadcast, finite_only=finite_only, hot=hot)
        batch_fn = fan_out(*sinks)
        if broadcast and refresh_dimension and recheck_every:
            batch_fn = broadcast_guard(batch_fn, used_dimension_columns(bio, key), max_broadcast_bytes, recheck_every)
        query = start(stats, batch_fn, checkpoint, "update", trigger)
        if rejected:
            query.rejected = run_rejected(messages, rejected, f"{checkpoint}-rejected", trigger)
    query.persisted = kept
    return query


def run_rejected(messages: DataFrame, sinks: Sequence[Sink], checkpoint: str,
                 trigger: str | None = "available_now", schema=RESULT_EVENT_SCHEMA) -> StreamingQuery:
    """Deliver the messages that the schema makes nothing of, as text with a flag for broken UTF-8.

    Columns ``key``, ``value`` (broken bytes as U+FFFD) and ``is_utf8``. A message
    is rejected if every field of the parsed value is NULL, or its bytes are
    broken.
    """
    bad = split_messages(messages, schema).where(~F.col("good")).select("key", "value", "is_utf8")
    return start(bad, fan_out(*sinks), checkpoint, "append", trigger)


def batch_means(keys: Sequence[str], measures: Sequence[str] = MEASURES,
                run_ts=None, weight: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Per-batch averages with the non-NULL count behind each one.

    The counts let batch results be combined exactly later
    (sum(avg·n) / sum(n)). With ``weight`` each row stands for that many
    equal rows (counts joined instead of events).
    """
    def transform(df: DataFrame) -> DataFrame:
        aggs = []
        for m in measures:
            v = as_double(df[m])
            if weight is None:
                aggs += [F.avg(v).alias(f"avg_{m}"), F.count(v).alias(f"n_{m}")]
            else:
                w = F.when(v.isNotNull(), df[weight])
                aggs += [(F.sum(v * df[weight]) / F.sum(w)).alias(f"avg_{m}"),
                         F.coalesce(F.sum(w), F.lit(0).cast("long")).alias(f"n_{m}")]
        return df.groupBy(*keys).agg(*aggs).withColumn("calculated_at", run_timestamp(run_ts))
    return transform


def joined_batch_means(dim: DataFrame | Callable[[], DataFrame], broadcast: bool,
                       key: str = ATHLETE_KEY, keys: Sequence[str] = STAT_KEYS,
                       measures: Sequence[str] = MEASURES,
                       run_ts=None) -> Callable[[DataFrame], DataFrame]:
    """Per-batch join to ``dim`` and :func:`batch_means`, for :func:`per_batch`.

    ``broadcast`` is decided once by the caller (a measured check). Without
    it, each batch's events are first counted per key and event-side group
    columns, and only the counts are joined (a hot key becomes a few rows);
    inside ``foreachBatch`` the join is a batch query, so adaptive execution
    also applies. ``dim`` may be a function that reads the dimension: it is
    then read again for every micro-batch, so rows added to a file-based
    dimension between batches are joined by the later batches.
    """
    def transform(batch: DataFrame) -> DataFrame:
        dim_now = dim() if callable(dim) else dim
        return _joined_means(batch, dim_now)

    def _joined_means(batch: DataFrame, dim: DataFrame) -> DataFrame:
        if broadcast:
            joined = enrich(batch, dim, key, "inner", broadcast=True)
            return batch_means(keys, measures, run_ts)(joined)
        events = drop_shared_columns(batch, dim, key)
        event_keys = [k for k in keys if k in events.columns]
        counts = events.groupBy(key, *event_keys).agg(F.count(F.lit(1)).alias("_events"))
        joined = enrich(counts, dim, key, "inner", broadcast=False, drop_shared=False)
        return batch_means(keys, measures, run_ts, weight="_events")(joined)
    return transform


def run_microbatch_stats(events: DataFrame, transform: Callable[[DataFrame], DataFrame],
                         sinks: Sequence[Sink], checkpoint: str,
                         trigger: str | None = "available_now") -> StreamingQuery:
    """Statistics of each micro-batch on its own (no running state), fanned out."""
    return start(events, per_batch(transform, *sinks), checkpoint, "append", trigger)


def combine_batch_means(history: DataFrame, keys: Sequence[str],
                        measures: Sequence[str] = MEASURES, digits: int | None = None) -> DataFrame:
    """Merge per-batch averages into overall averages, weighting by counts.

    A batch that an append-only history holds twice (a replay) counts once: one
    row is taken per keys and batch, where the history tells batches apart.
    """
    if BATCH_COL in history.columns:
        history = history.dropDuplicates([*keys, BATCH_COL])
    aggs = []
    for m in measures:
        a = F.sum(F.col(f"avg_{m}") * F.col(f"n_{m}")) / F.sum(F.col(f"n_{m}"))
        aggs.append((F.round(a, digits) if digits is not None else a).alias(f"avg_{m}"))
    return history.groupBy(*keys).agg(*aggs)


def start_console(stream: DataFrame, output_mode: str = "update",
                  trigger: str | None = None) -> StreamingQuery:
    """Print every micro-batch in full (no truncation) — for watching a stream."""
    writer = stream.writeStream.format("console").option("truncate", False).outputMode(output_mode)
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet history written by :func:`parquet_history_sink`."""
    return spark.read.parquet(path)


def await_done(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query (and the one for its rejected messages) to finish; re-raise its failure."""
    try:
        _await_one(query, timeout_s)
        if getattr(query, "rejected", None) is not None:
            _await_one(query.rejected, timeout_s)
    finally:
        if getattr(query, "persisted", None) is not None and not query.isActive:
            query.persisted.unpersist()


def stop_when_idle(query: StreamingQuery, idle_s: float, poll_s: float = 0.5, timeout_s: float | None = None) -> None:
    """Stop a continuous query once it has had nothing to do for ``idle_s`` seconds; re-raise its failure.

    Idle: no trigger is active, no data is waiting and no batch has ended since.
    """
    begun = quiet_since = time.monotonic()
    last = None
    while query.isActive:
        status, progress = query.status, query.lastProgress
        batch = progress["batchId"] if progress and progress["numInputRows"] else last
        if batch != last or status["isDataAvailable"] or status["isTriggerActive"]:
            last, quiet_since = batch, time.monotonic()
        if time.monotonic() - quiet_since >= idle_s:
            query.stop()
            break
        if timeout_s is not None and time.monotonic() - begun >= timeout_s:
            query.stop()
            raise TimeoutError(f"stream {query.id} wasn't idle for {idle_s}s within {timeout_s}s")
        time.sleep(poll_s)
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.id} failed: {query.exception()}")


def _await_one(query: StreamingQuery, timeout_s: float | None) -> None:
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.id} failed: {query.exception()}")
