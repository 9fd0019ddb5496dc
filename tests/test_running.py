"""Running averages from sums by batch: changing and growing dimensions, compaction, replays, rejected messages; sinks that commit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestream.operators import distinct_values, indicator_vectors, latest_per_key, to_envelope, value_dictionary
from lakestream.schemas import BATCH_COL, STAT_KEYS
from lakestream.sources import read_messages_stream, write_messages
from lakestream.sources.versions import file_names, write_version
from lakestream.streaming import (await_done, committed_files_sink, parquet_history_sink, pinned_versions, read_committed,
                                  run_enrichment, start, stop_when_idle)

RUN_TS = "2024-01-01 00:00:00"
BIO = "athlete_id int, sex string, country_noc string, height string, weight string"


def _publish(spark, topic, rows):
    df = spark.createDataFrame(rows, "athlete_id int, sport string, medal string")
    write_messages(to_envelope(df.coalesce(1)), topic)


def _bio(spark, ids):
    return spark.createDataFrame([(i, "MF"[i % 2], f"C{i % 3}", str(150 + i), str(50 + i)) for i in ids], BIO)


def _latest(spark, hist):
    rows = latest_per_key(spark.read.parquet(hist), STAT_KEYS, BATCH_COL).collect()
    return {(r.sport, r.medal, r.sex, r.country_noc): (round(r.avg_height, 6), round(r.avg_weight, 6)) for r in rows}


def _expected(events):
    """events: (athlete, sport, medal) that met their dimension row."""
    groups = {}
    for i, sport, medal in events:
        groups.setdefault((sport, medal, "MF"[i % 2], f"C{i % 3}"), []).append(i)
    return {k: (round(150 + sum(v) / len(v), 6), round(50 + sum(v) / len(v), 6)) for k, v in groups.items()}


def _events(seed, n=60):
    return [((i * 7 + seed) % 40, "SRX"[(i + seed) % 3], [None, "Gold"][i % 2]) for i in range(n)]


@pytest.mark.parametrize("bound", [1 << 20, 2000])
def test_a_dimension_that_grows_while_the_stream_runs(spark, scratch, bound):
    """From 5 to 40 rows, past the smaller broadcast bound, without a restart and exact."""
    topic, dims, hist, ckpt, state = (scratch(n) for n in ("topic", "dims", "hist", "ckpt", "state"))
    write_version(_bio(spark, range(5)), dims)
    _publish(spark, topic, _events(0))
    query = run_enrichment(read_messages_stream(spark, topic), pinned_versions(spark, dims, state), [parquet_history_sink(hist)],
                           ckpt, run_ts=RUN_TS, trigger=None, state=state, compact_every=2, max_broadcast_bytes=bound)
    joined, known = [], 5
    try:
        query.processAllAvailable()
        joined += [e for e in _events(0) if e[0] < known]
        for k, known in enumerate((5, 20, 40, 40, 40), 1):
            if known > 5:
                write_version(_bio(spark, range(known)), dims)
            _publish(spark, topic, _events(k))
            query.processAllAvailable()
            joined += [e for e in _events(k) if e[0] < known]
            assert _latest(spark, hist) == _expected(joined), k
        assert len(file_names(spark, f"{state}/base")) == 1 and len(file_names(spark, f"{state}/deltas")) <= 3
        stop_when_idle(query, idle_s=0.5, timeout_s=120)
        assert not query.isActive
    finally:
        query.stop()


def test_a_replayed_batch_joins_the_version_that_it_used_first(spark, scratch):
    topic, dims, hist, ckpt, state = (scratch(n) for n in ("topic", "dims", "hist", "ckpt", "state"))
    write_version(_bio(spark, range(10)), dims)
    failed = []

    def failing(df, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("sink failed")

    def run():
        query = run_enrichment(read_messages_stream(spark, topic, 1), pinned_versions(spark, dims, state),
                               [parquet_history_sink(hist), failing], ckpt, run_ts=RUN_TS, state=state, compact_every=1)
        await_done(query, 300)

    _publish(spark, topic, _events(0))
    run()
    _publish(spark, topic, _events(1))
    with pytest.raises(Exception, match="sink failed"):
        run()
    write_version(_bio(spark, range(40)), dims)  # not for the batch that is run again
    run()
    assert _latest(spark, hist) == _expected([e for e in _events(0) + _events(1) if e[0] < 10])


def test_rejected_messages_come_from_the_same_pass_and_count_nowhere(spark, scratch):
    topic, hist, bad, ckpt = (scratch(n) for n in ("topic", "hist", "bad", "ckpt"))
    _publish(spark, topic, [(1, "S", "Gold")])
    broken = spark.sql("select unhex('7b226174686c6574655f6964223a322c2273706f7274223a2261ff227d') as value union all select cast('nonsense' as binary)")
    write_messages(broken, topic)
    query = run_enrichment(read_messages_stream(spark, topic), _bio(spark, range(5)), [parquet_history_sink(hist)], ckpt,
                           run_ts=RUN_TS, rejected=[parquet_history_sink(bad)])
    await_done(query, 300)
    assert _latest(spark, hist) == _expected([(1, "S", "Gold")])
    got = sorted((r.value, r.is_utf8) for r in spark.read.parquet(bad).collect())
    assert got == [("nonsense", True), ('{"athlete_id":2,"sport":"a�"}', False)]


def test_salted_stream_returns_its_query_of_rejected_messages(spark, scratch):
    topic, hist, bad, ckpt = (scratch(n) for n in ("topic", "hist", "bad", "ckpt"))
    _publish(spark, topic, [(1, "S", "Gold")])
    write_messages(spark.sql("select cast('nonsense' as binary) as value"), topic)
    query = run_enrichment(read_messages_stream(spark, topic), _bio(spark, range(5)), [parquet_history_sink(hist)], ckpt,
                           run_ts=RUN_TS, broadcast=False, rejected=[parquet_history_sink(bad)])
    await_done(query, 300)
    assert not query.rejected.isActive and spark.read.parquet(bad).count() == 1
    assert _latest(spark, hist) == _expected([(1, "S", "Gold")])


def test_committed_batches_are_there_once(spark, scratch):
    out = scratch("out")
    sink = committed_files_sink(out)
    assert read_committed(spark, out).count() == 0
    for batch_id in (0, 1, 1, 2, 0):
        sink(spark.createDataFrame([(batch_id, k) for k in range(3)], "b int, k int"), batch_id)
    write_messages(to_envelope(spark.createDataFrame([(9,)], "b int")), f"{out}/batches/3-unfinished")
    values = sorted(bytes(r["value"]).decode() for r in read_committed(spark, out).collect())
    assert values == sorted(f'{{"b":{b},"k":{k}}}' for b in range(3) for k in range(3))


def test_dictionary_and_vectors(spark):
    rows = [(i, ["a", "b", None, "a=", ""][i % 5], i % 7) for i in range(300)] + [(900 + i, "hot", 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, s string, n int").repartition(5)
    known = {(r["column"], r["value"]): r["id"] for r in value_dictionary(df, ["s", "n"]).collect()}
    order = sorted(known, key=lambda k: (k[0], k[1] is not None, k[1] or ""))
    assert [known[k] for k in order] == list(range(len(known))) and len(known) == distinct_values(df, ["s", "n"]).count() == 13
    got = indicator_vectors(df, ["s", "n"], value_dictionary(df, ["s", "n"]), keep=["id"]).collect()
    want = {i: sorted([known["s", s], known["n", str(n)]]) for i, s, n in rows}
    assert {r["id"]: r["indicators"] for r in got} == want and len(got) == len(rows)
    part = value_dictionary(df.where(F.col("s") == "a"), ["s"])
    assert {tuple(r["indicators"]) for r in indicator_vectors(df, ["s"], part).collect()} == {(), (0,)}


def test_an_idle_stream_is_stopped_and_a_failed_one_raises(spark, scratch):
    topic, ckpt = scratch("topic"), scratch("ckpt")
    _publish(spark, topic, [(1, "S", "Gold")])
    seen = []
    query = start(read_messages_stream(spark, topic), lambda df, batch_id: seen.append(df.count()), ckpt, "append", None)
    stop_when_idle(query, idle_s=1, timeout_s=60)
    assert seen == [1] and not query.isActive

    def fail(df, batch_id):
        raise RuntimeError("no")

    query = start(read_messages_stream(spark, topic), fail, scratch("ckpt"), "append", None)
    with pytest.raises(RuntimeError, match="no"):
        stop_when_idle(query, idle_s=1, timeout_s=60)
