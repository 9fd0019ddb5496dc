"""A message is parsed once, large batches are of many files, hot keys alone are salted."""

from __future__ import annotations

import __spark_entry__ as entry
from conftest import plan_text
from pyspark.sql import functions as F

from lakestream.operators import hot_keys, latest_per_key, parse_json, salted_join, to_envelope
from lakestream.plans import enriched_stats
from lakestream.schemas import BATCH_COL, RESULT_EVENT_SCHEMA, STAT_KEYS
from lakestream.sources import read_messages, read_messages_stream, write_messages
from lakestream.streaming import await_done, parquet_history_sink, parse_results, run_enrichment, split_messages


def _inputs(spark):
    rows = [(1, "CAN", ["Swim", "Row", None][i % 3], "e", i, "a", None if i % 17 == 0 else 1 if i % 2 else i % 9, "1", "Gold", "False")
            for i in range(90)]
    dim = spark.createDataFrame([(i, "M", "USA", str(170 + i), "80") for i in range(8)],
                                "athlete_id int, sex string, country_noc string, height string, weight string")
    return spark.createDataFrame(rows, RESULT_EVENT_SCHEMA), dim


def test_a_message_is_parsed_once(spark, scratch):
    path = scratch("topic")
    events, dim = _inputs(spark)
    write_messages(to_envelope(events), path)
    messages = read_messages(spark, path)
    parsed = parse_results(messages)
    joined = salted_join(parsed.drop("country_noc"), dim, "athlete_id", "left")
    good = split_messages(messages).where("good").select("data.*")
    for df in (parsed.where("sport is not null and athlete_id > 0"), joined.where("sport is not null and sex is not null"), good):
        assert plan_text(df).split("== Physical Plan ==")[-1].count("from_json(") == 1
    assert parsed.exceptAll(events).isEmpty() and good.count() == 90


def test_odd_messages_keep_their_rows(spark):
    odd = spark.createDataFrame([("k", v) for v in ('{"a":1,"b":"x"}', "no json", "", "[]", None, '{"a":"x"}', '[{"a":1},{"a":2}]')],
                                "key string, value string")
    got = parse_json(odd, spark.createDataFrame([], "a int, b string").schema, keep=("key",))
    assert got.columns == ["key", "a", "b"]
    assert sorted((r.key, r.a or 0, r.b or "") for r in got.collect()) == [*[("k", 0, "")] * 6, ("k", 1, "x")]


def test_a_large_batch_is_of_many_files(spark, monkeypatch):
    made = []
    monkeypatch.setattr(entry, "FILE_ROWS", 10)
    monkeypatch.setattr(entry, "read_messages_stream", lambda s, path, files: made.append((path, files)) or s.range(0))
    entry._topic(spark, spark.range(400).coalesce(1), "topic", 4)
    (path, files), = made
    assert files == 10 and len(read_messages(spark, path).inputFiles()) == 40
    assert read_messages(spark, path).count() == 400


def test_stream_with_hot_keys_equals_batch(spark, scratch):
    events, dim = _inputs(spark)
    topic, hist = scratch("topic"), scratch("hist")
    for k in range(3):
        write_messages(to_envelope(events.where(F.col("result_id") % 3 == k)).coalesce(1), topic)
    hot = hot_keys(events, "athlete_id", 0.3)
    assert [r.athlete_id for r in hot.collect()] == [1]
    query = run_enrichment(read_messages_stream(spark, topic, 1), dim, [parquet_history_sink(hist)], scratch("ckpt"),
                           run_ts="2024-01-01 00:00:00", digits=6, broadcast=False, hot=hot)
    await_done(query, 300)
    stream = latest_per_key(spark.read.parquet(hist), STAT_KEYS).drop(BATCH_COL)
    batch = enriched_stats(events, dim, run_ts="2024-01-01 00:00:00", digits=6)
    assert batch.count() == 2 and stream.exceptAll(batch).isEmpty() and batch.exceptAll(stream).isEmpty()
