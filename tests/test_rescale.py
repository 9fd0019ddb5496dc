"""Averages moved from Spark's state store to sums by batch, with another number of partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestream.operators import group_means, parse_json, to_envelope
from lakestream.sources import read_messages_stream, write_messages
from lakestream.sources.versions import file_names
from lakestream.streaming import adopt_state, await_done, fan_out, parquet_history_sink, run_enrichment, start, state_sums
from test_running import RUN_TS, _bio, _events, _expected, _latest, _publish


@pytest.fixture
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("killed", [False, True])
def test_from_four_state_partitions_to_eight(spark, scratch, partitions, killed):
    """``killed``: the last batch of the old stream was planned but not committed, so the new stream computes it."""
    topic, hist, old, new = (scratch(n) for n in ("topic", "hist", "old", "new"))
    bio, bad = _bio(spark, range(30)), {"on": False}

    def broken(batch, batch_id):
        if bad["on"]:
            raise RuntimeError("killed on purpose")

    def run(ckpt, form):
        await_done(run_enrichment(read_messages_stream(spark, topic), bio, [parquet_history_sink(hist), broken], ckpt, run_ts=RUN_TS,
                                  broadcast=form))

    partitions(4)
    for seed in (0, 1):
        _publish(spark, topic, _events(seed))
        run(old, False)
    if killed:
        _publish(spark, topic, _events(2))
        bad["on"] = True
        with pytest.raises(Exception):
            run(old, False)
        bad["on"] = False
    assert state_sums(spark, old).select(F.sum("n_height")).first()[0] == sum(e[0] < 30 for s in (0, 1) for e in _events(s))
    at = adopt_state(spark, old, new)
    assert not [n for n in file_names(spark, new) if n == "state"]
    partitions(8)
    for seed in (2, 3):
        if seed > 2 or not killed:
            _publish(spark, topic, _events(seed))
        run(new, "checked")
    assert _latest(spark, hist) == _expected([e for s in range(4) for e in _events(s) if e[0] < 30])
    assert max(r[0] for r in spark.read.parquet(hist).select("batch_id").distinct().collect()) >= at + 2
    with pytest.raises(FileExistsError):
        adopt_state(spark, old, new)


def test_what_has_no_such_state(spark, scratch):
    topic, ckpt = scratch("topic"), scratch("ckpt")
    with pytest.raises(FileNotFoundError):
        adopt_state(spark, ckpt, scratch("new"))
    write_messages(to_envelope(spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, v double")), topic)
    events = parse_json(read_messages_stream(spark, topic), spark.createDataFrame([], "k string, v double").schema)
    await_done(start(group_means(events, ["k"], ["v"], ts_col=None), fan_out(parquet_history_sink(scratch("hist"))), ckpt))
    with pytest.raises(ValueError, match="averages"):
        adopt_state(spark, ckpt, scratch("new"))
    rows = {r.k: (r.sum_v, r.n_v) for r in state_sums(spark, ckpt, ["k"], ["v"]).collect()}
    assert rows == {"a": (1.0, 1), "b": (None, 0)}
