"""Fan-out of each micro-batch to several sinks.

A micro-batch is tagged with its ``batch_id``, persisted once, written to
every sink, then released. Without the persist each sink would recompute the
batch (re-reading the source and re-running the join and aggregation), and
``current_timestamp()`` could differ between sinks.

Delivery is at-least-once: after a failure Spark replays the last batch with
the same ``batch_id``. The Parquet history sink overwrites that batch's
partition, so it stays exact; append-only sinks (Kafka, JDBC, message
files) may hold the batch twice. Readers that keep the newest row per key
(:func:`lakestream.operators.latest_per_key`) or one row per key and batch
(:func:`lakestream.streaming.combine_batch_means`) aren't changed by that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import InheritableThread, StorageLevel
from pyspark.sql import DataFrame, SparkSession

from lakestream.functions import batch_tag
from lakestream.operators import estimate_size, to_envelope
from lakestream.schemas import BATCH_COL, MESSAGE_SCHEMA
from lakestream.sources.jdbc import write_jdbc
from lakestream.sources.kafka import write_topic
from lakestream.sources.topics import write_messages
from lakestream.sources.versions import delete_folder, file_names, get_text, put_text

Sink = Callable[[DataFrame, int], None]
BatchFunction = Callable[[DataFrame, int], None]


def parquet_history_sink(path: str) -> Sink:
    """Each batch into its own ``batch_id=N`` partition, replaced on replay, also by an empty batch."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.drop(BATCH_COL).write.mode("overwrite").parquet(f"{path}/{BATCH_COL}={batch_id}")
    write.replaces = True
    return write


def message_files_sink(path: str, keep_nulls: bool = False) -> Sink:
    """Each row as a JSON message appended to a file-backed topic."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_messages(to_envelope(df, keep_nulls=keep_nulls), path)
    return write


def committed_files_sink(path: str, keep_nulls: bool = False) -> Sink:
    """Each batch as JSON messages in a folder of its own, which a commit record names once it is complete.

    A replay finds its batch committed and leaves it; an attempt that failed
    half-way left a folder that no record names. Read with
    :func:`read_committed`: every batch is there once.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark, record = df.sparkSession, f"{path}/commits/{batch_id}.json"
        if get_text(spark, record) is not None:
            return
        folder = f"batches/{batch_id}-{uuid.uuid4().hex[:12]}"
        write_messages(to_envelope(df, keep_nulls=keep_nulls), f"{path}/{folder}")
        if not put_text(spark, record, json.dumps({"batch_id": batch_id, "folder": folder})):
            delete_folder(spark, f"{path}/{folder}")  # another attempt was first
    return write


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The messages of all committed batches of :func:`committed_files_sink` (the driver lists one name a batch)."""
    if not file_names(spark, f"{path}/commits"):
        return spark.createDataFrame([], MESSAGE_SCHEMA)
    names = [r["folder"] for r in spark.read.schema("folder string").json(f"{path}/commits").collect()]
    return spark.read.schema(MESSAGE_SCHEMA).parquet(*(f"{path}/{n}" for n in names))


def kafka_sink(options: dict[str, str], topic: str, keep_nulls: bool = False) -> Sink:
    """Each row as a JSON message (value only) to a Kafka topic."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_topic(to_envelope(df, keep_nulls=keep_nulls), options, topic)
    return write


def jdbc_sink(options: dict[str, str], max_connections: int | None = 64) -> Sink:
    """Append each batch to a database table over at most ``max_connections``."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_jdbc(df, options, mode="append", max_connections=max_connections)
    return write


def _write_all(sinks: tuple[Sink, ...], df: DataFrame, batch_id: int, parallel: bool) -> None:
    """Call every sink; with ``parallel`` each sink's job runs concurrently.

    Threads are ``InheritableThread``s, so the sink jobs carry the stream's
    local properties (job group: stopping the query cancels them too). The
    first sink error is raised after all sinks finished, failing the batch.
    """
    if not parallel or len(sinks) < 2:
        for sink in sinks:
            sink(df, batch_id)
        return
    errors: list[BaseException] = []

    def call(sink: Sink) -> None:
        try:
            sink(df, batch_id)
        except BaseException as e:  # re-raised on the stream's thread below
            errors.append(e)

    threads = [InheritableThread(target=call, args=(sink,)) for sink in sinks]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]


def fan_out(*sinks: Sink, tag: bool = True, skip_empty: bool = True,
            bytes_per_task: int | None = 16 << 20,
            storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
            parallel: bool = True) -> BatchFunction:
    """A ``foreachBatch`` function writing every micro-batch to all ``sinks``.

    The batch is computed once (persisted) and measured once (which also serves
    the empty-batch check). Its partitions are joined without a shuffle until
    each holds about ``bytes_per_task`` (None: never), so a batch of a few
    changed groups isn't one tiny file per state partition in every sink, and a
    large one keeps its writers. The sinks then write concurrently
    (``parallel``), each reading the cached batch. An empty batch is skipped by
    all sinks but those that replace what an earlier run of it left.
    """
    def run(batch_df: DataFrame, batch_id: int, came_from: DataFrame | None = None) -> None:
        cached = batch_df.withColumn(BATCH_COL, batch_tag(batch_id)) if tag else batch_df
        cached.persist(storage)
        try:
            size = estimate_size(cached)
            to = sinks
            # one row may be a total over nothing: then the batch itself is looked at
            empty = size.rows == 0 or size.rows == 1 and came_from is not None and came_from.isEmpty()
            if skip_empty and empty:
                to = tuple(s for s in sinks if getattr(s, "replaces", False))
            # coalesce never raises the partition count, so small batches shrink only
            out = cached.coalesce(max(1, -(-size.bytes // bytes_per_task))) if bytes_per_task else cached
            if skip_empty and empty:
                out = out.limit(0)
            _write_all(to, out, batch_id, parallel)
        finally:
            cached.unpersist()
    return run


def per_batch(transform: Callable[[DataFrame], DataFrame], *sinks: Sink,
              skip_empty: bool = True, tag: bool = True) -> BatchFunction:
    """Run a batch computation on each micro-batch alone, then fan out its result.

    No state is carried between batches: each result describes one batch. The
    batch is read once, and looked at again only if its result has one row or none.
    """
    writer = fan_out(*sinks, tag=tag, skip_empty=skip_empty)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        writer(transform(batch_df), batch_id, batch_df)
    return run
