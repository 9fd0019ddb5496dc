"""Streaming: running stats across restarts, fan-out, per-batch stats, equivalences."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakestream.operators import decode_messages, enrich, latest_per_key, to_envelope
from lakestream.plans import enriched_stats
from lakestream.schemas import BATCH_COL, RESULT_EVENT_SCHEMA, STAT_KEYS
from lakestream.sources import read_messages, read_messages_stream, write_messages
from lakestream.streaming import (await_done, batch_means, combine_batch_means, fan_out,
                                  message_files_sink, parquet_history_sink, parse_results, per_batch,
                                  run_enrichment, start)

RUN_TS = "2024-01-01 00:00:00"


def _events(spark, rows):
    full = [(1, "CAN", sport, "e", 1, "a", aid, "1", medal, "False") for aid, sport, medal in rows]
    return spark.createDataFrame(full, RESULT_EVENT_SCHEMA)


def _publish(spark, topic, rows):
    # one file per publish, so one publish is one micro-batch at one file per trigger
    write_messages(to_envelope(_events(spark, rows)).coalesce(1), topic)


def _dim(spark):
    return spark.createDataFrame(
        [(1, "M", "USA", "180", "80"), (5, "M", "UKR", "190", "90"), (7, "F", "NOR", "na", "60")],
        "athlete_id int, sex string, country_noc string, height string, weight string")


def test_running_stats_across_restarts(spark, scratch):
    topic, hist, out, ckpt = scratch("topic"), scratch("hist"), scratch("out"), scratch("ckpt")
    dim = _dim(spark)
    sinks = [parquet_history_sink(hist), message_files_sink(out)]

    def run():
        q = run_enrichment(read_messages_stream(spark, topic, 1), dim, sinks, ckpt, run_ts=RUN_TS)
        await_done(q, 300)

    _publish(spark, topic, [(1, "Swim", "Gold")])
    run()
    _publish(spark, topic, [(5, "Swim", "Gold")])
    run()
    _publish(spark, topic, [(1, "Swim", "Gold"), (5, "Row", None), (7, "Ski", "Gold")])
    run()
    run()  # restart with nothing new: no batch, no rows

    h = spark.read.parquet(hist)
    got = sorted((r.batch_id, r.sport, r.medal, r.country_noc, r.avg_height)
                 for r in h.collect())
    assert got == [
        (0, "Swim", "Gold", "USA", 180.0),
        (1, "Swim", "Gold", "UKR", 190.0),
        (2, "Row", None, "UKR", 190.0),
        (2, "Swim", "Gold", "USA", 180.0),
    ]  # athlete 7 has a non-numeric height: filtered from the dimension
    assert h.select("timestamp").distinct().count() == 1

    # fan-out: the message sink holds the same rows as the history
    schema = "sport string, medal string, sex string, country_noc string, avg_height double, " \
             "avg_weight double, timestamp timestamp_ntz, batch_id string"
    msgs = decode_messages(read_messages(spark, out), spark.createDataFrame([], schema).schema).drop("key")
    msgs = msgs.withColumn(BATCH_COL, F.col(BATCH_COL).cast("int"))
    assert msgs.select(*h.columns).exceptAll(h).count() == 0 and msgs.count() == h.count()


def test_stream_final_state_equals_batch(spark, scratch):
    topic, hist, ckpt = scratch("topic"), scratch("hist"), scratch("ckpt")
    dim = _dim(spark)
    rows = [(i % 9, ["Swim", "Row", "Ski"][i % 3], [None, "Gold", "Silver"][i % 2]) for i in range(60)]
    for k in range(0, 60, 15):
        _publish(spark, topic, rows[k:k + 15])
    q = run_enrichment(read_messages_stream(spark, topic, 1), dim, [parquet_history_sink(hist)], ckpt,
                       run_ts=RUN_TS, digits=6)
    await_done(q, 300)
    stream = latest_per_key(spark.read.parquet(hist), STAT_KEYS).drop(BATCH_COL)
    batch = enriched_stats(_events(spark, rows), dim, run_ts=RUN_TS, digits=6)
    assert spark.read.parquet(hist).select(BATCH_COL).distinct().count() == 4
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_history_sink_replay_is_idempotent(spark, scratch):
    hist = scratch("hist")
    sink = fan_out(parquet_history_sink(hist))
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    sink(df, 3)
    sink(df, 3)  # the same batch again, as after a failure
    sink(df.limit(0), 4)  # empty batch: skipped
    got = spark.read.parquet(hist).collect()
    assert [tuple(r) for r in got] == [("a", 1.0, 3)]


def test_per_batch_stats_combine_to_global(spark, scratch):
    topic, hist, ckpt = scratch("topic"), scratch("hist"), scratch("ckpt")
    rows = [(i % 4, ["Swim", "Row"][i % 2], None) for i in range(40)]
    dim = _dim(spark)
    for k in range(0, 40, 10):
        _publish(spark, topic, rows[k:k + 10])
    events = read_messages_stream(spark, topic, 1)

    def transform(batch):
        return batch_means(["sport"], ["height"])(enrich(batch, dim, "athlete_id", broadcast=True))

    q = start(parse_results(events), per_batch(transform, parquet_history_sink(hist)), ckpt, "append")
    await_done(q, 300)
    h = spark.read.parquet(hist)
    assert h.select(BATCH_COL).distinct().count() == 4
    combined = {r.sport: r.avg_height for r in combine_batch_means(h, ["sport"], ["height"], 6).collect()}
    # only athlete 1 (height 180, always "Row") has a dimension row; inner join drops the rest
    assert combined == {"Row": 180.0}
    whole = transform(_events(spark, rows))
    assert {r.sport: r.avg_height for r in whole.collect()} == combined


def test_fan_out_skips_empty_batches_and_computes_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        calls.add(1)
        return x

    got = {}

    def sink(name):
        def write(df, batch_id):
            got.setdefault(name, []).append((batch_id, sorted(tuple(r) for r in df.collect())))
        return write

    fn = fan_out(sink("a"), sink("b"))
    empty = spark.range(0).select(counted(F.col("id").cast("int")).alias("x"))
    fn(empty, 3)
    assert got == {}

    rows = spark.range(5).select(counted(F.col("id").cast("int")).alias("x"))
    fn(rows, 4)
    expected = [(4, [(i, "4") for i in range(5)])]
    assert got == {"a": expected, "b": expected}
    # persisted once: every row went through the expression once for two sinks
    assert calls.value == 5


def test_per_batch_skips_empty_batches(spark):
    seen = []
    fn = per_batch(lambda df: df.groupBy().count(), lambda df, b: seen.append(b))
    fn(spark.range(0), 0)
    fn(spark.range(3), 1)
    assert seen == [1]


def test_console_sink_prints_every_row(spark, scratch):
    from lakestream.streaming import start_console

    topic = scratch("topic")
    _publish(spark, topic, [(1, "Swim", "Gold"), (5, "Row", None)])
    parsed = parse_results(read_messages_stream(spark, topic, 1)).select("athlete_id", "sport")
    q = start_console(parsed, "append", trigger="available_now")
    await_done(q, 300)
    # the JVM prints to the stdout it was started with, out of this test's reach;
    # the query's progress shows both rows went through the console sink
    assert sum(p["numInputRows"] for p in q.recentProgress) == 2
    assert "Console" in q.lastProgress["sink"]["description"]


def test_broadcast_guard_stops_before_computing_an_oversized_batch(spark):
    from lakestream.operators import estimate_size
    from lakestream.streaming import DimensionTooLarge, broadcast_guard

    dim = _dim(spark)
    size = estimate_size(dim).bytes
    seen = []
    inner = lambda df, b: seen.append(b)
    ok = broadcast_guard(inner, dim, size, every=2)
    for b in range(3):
        ok(spark.range(1), b)
    assert seen == [0, 1, 2]

    tight = broadcast_guard(inner, dim, size - 1, every=2)
    tight(spark.range(1), 1)  # not a check batch
    with pytest.raises(DimensionTooLarge):
        tight(spark.range(1), 2)
    assert seen == [0, 1, 2, 1]


def test_enrichment_with_recheck_matches_batch(spark, scratch):
    topic, hist, ckpt = scratch("topic"), scratch("hist"), scratch("ckpt")
    _publish(spark, topic, [(1, "Swim", "Gold"), (5, "Row", None), (7, "Row", None)])
    q = run_enrichment(read_messages_stream(spark, topic, 1), _dim(spark), [parquet_history_sink(hist)],
                       ckpt, run_ts=RUN_TS, recheck_every=1)
    await_done(q, 300)
    got = latest_per_key(spark.read.parquet(hist), STAT_KEYS, BATCH_COL).drop(BATCH_COL)
    want = enriched_stats(_events(spark, [(1, "Swim", "Gold"), (5, "Row", None), (7, "Row", None)]),
                          _dim(spark), run_ts=RUN_TS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_stream_is_exact_when_tasks_fail(spark, scratch):
    """A lost task is re-run: the running state and every sink stay exact."""
    from pyspark import TaskContext

    topic, hist, out, ckpt = scratch("topic"), scratch("hist"), scratch("out"), scratch("ckpt")
    marks = scratch("failures").removeprefix("file:")  # local in tests; one file per injected failure
    os.makedirs(marks)

    @F.udf("boolean")
    def first_attempt_fails(_):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            open(os.path.join(marks, f"{ctx.stageId()}-{ctx.taskAttemptId()}"), "w").close()
            raise RuntimeError("injected task failure")
        return True

    rows = [(1, "Swim", "Gold"), (5, "Row", None), (1, "Swim", "Gold"), (5, "Swim", "Gold")]
    _publish(spark, topic, rows[:2])
    _publish(spark, topic, rows[2:])
    messages = read_messages_stream(spark, topic, 1)
    messages = messages.filter(first_attempt_fails(messages["value"]))
    q = run_enrichment(messages, _dim(spark), [parquet_history_sink(hist), message_files_sink(out)],
                       ckpt, run_ts=RUN_TS)
    await_done(q, 300)
    want = sorted(map(tuple, enriched_stats(_events(spark, rows), _dim(spark), run_ts=RUN_TS).collect()))
    got = latest_per_key(spark.read.parquet(hist), STAT_KEYS, BATCH_COL).drop(BATCH_COL)
    assert sorted(map(tuple, got.collect())) == want
    # the message sink holds each batch once (a retried task does not append twice)
    schema = "sport string, medal string, sex string, country_noc string, avg_height double, " \
             "avg_weight double, timestamp timestamp_ntz, batch_id string"
    msgs = decode_messages(read_messages(spark, out), spark.createDataFrame([], schema).schema)
    hist_rows = spark.read.parquet(hist).count()
    assert msgs.count() == hist_rows
    assert len(os.listdir(marks)) >= 2  # a failure was injected in each micro-batch


def test_fan_out_error_in_one_parallel_sink_fails_the_batch(spark):
    written = []

    def good(df, batch_id):
        written.append(df.count())

    def bad(df, batch_id):
        raise OSError("sink unavailable")

    with pytest.raises(OSError, match="sink unavailable"):
        fan_out(good, bad)(spark.range(3), 0)
    assert written == [3]  # the other sink still ran; the batch is replayed as a whole


def test_joined_batch_means_counts_first_equals_row_join(spark):
    from lakestream.streaming import joined_batch_means

    dim = spark.createDataFrame(
        [(1, "M", "USA", "180", "80"), (5, "M", "UKR", "na", "90"), (7, "F", "NOR", None, "60.5")],
        "athlete_id int, sex string, country_noc string, height string, weight string")
    # athlete 1 holds most events (a hot key); athlete 9 has no dimension row
    rows = [(1, "Swim", "Gold")] * 30 + [(5, "Swim", "Gold"), (7, "Row", None), (7, "Row", None), (9, "Row", None)]
    batch = _events(spark, rows)
    cols = ["sport", "medal", "sex", "country_noc", "avg_height", "n_height", "avg_weight", "n_weight"]
    by_rows = joined_batch_means(dim, True, run_ts=RUN_TS)(batch).select(cols)
    by_counts = joined_batch_means(dim, False, run_ts=RUN_TS)(batch).select(cols)
    assert sorted(map(str, by_rows.collect())) == sorted(map(str, by_counts.collect()))
    # UKR ('na') and NOR (NULL): groups without a numeric height, averaged as NULL over 0 values
    assert by_counts.filter("n_height = 0 and avg_height is null").count() == 2


def test_late_dimension_row_is_joined_by_later_batches(spark, scratch):
    """A dimension row inserted between micro-batches is joined from the next batch on
    when the dimension is read per batch; a dimension read once never sees it."""
    from lakestream.streaming import joined_batch_means

    schema = "athlete_id int, sex string, country_noc string, height string, weight string"
    topic = scratch("topic")
    _publish(spark, topic, [(2, "Swim", "Gold")])  # batch 0
    _publish(spark, topic, [(2, "Swim", "Gold")])  # batch 1

    def run(per_batch_read: bool):
        dim_path, hist = scratch("dim"), scratch("hist")
        spark.createDataFrame([(1, "M", "USA", "180", "80")], schema).write.parquet(dim_path)
        dim = (lambda: spark.read.parquet(dim_path)) if per_batch_read else spark.read.parquet(dim_path)
        fn = per_batch(joined_batch_means(dim, True, run_ts=RUN_TS), parquet_history_sink(hist))

        def with_late_row(df, batch_id):
            if batch_id == 1:  # the row for athlete 2 arrives after batch 0
                spark.createDataFrame([(2, "F", "NOR", "170", "60")], schema).write.mode("append") \
                    .parquet(dim_path)
            fn(df, batch_id)

        events = parse_results(read_messages_stream(spark, topic, 1))
        await_done(start(events, with_late_row, scratch("ckpt"), "append"), 300)
        try:
            return [(r.batch_id, r.country_noc, r.n_height) for r in spark.read.parquet(hist).collect()]
        except Exception:  # no batch produced rows, so nothing was written
            return []

    assert run(per_batch_read=True) == [(1, "NOR", 1)]
    assert run(per_batch_read=False) == []  # the file listing was fixed when the frame was defined
