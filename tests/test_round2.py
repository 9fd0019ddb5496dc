"""Exact CSV, histories, replays, salted joins, rejected messages, writers of a batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from conftest import plan_text
from lakestream.functions import is_utf8, run_timestamp, utf8_text
from lakestream.operators import (decode_messages, enrich, fits_broadcast, hot_keys, latest_per_key,
                                  salted_join)
from lakestream.plans import gold_stats
from lakestream.sources import (files_per_batch, kafka_options, read_csv, read_messages, read_messages_stream,
                                write_csv, write_messages)
from lakestream.streaming import (await_done, combine_batch_means, fan_out, parquet_history_sink, run_rejected,
                                  start)


def test_csv_round_trip_is_exact(spark, scratch):
    df = spark.sql("""select * from values
        (1, 'line\\nbreak, "quoted" \\\\ back', timestamp_ntz'2024-01-01 00:00:07.179575'), (2, '  blanks  ', null),
        (3, '', timestamp_ntz'1999-12-31 23:59:59.000001'), (4, null, null), (5, 'a""b\\r\\nc', null) as t(id, text, ts)""")
    path = scratch("csv")
    write_csv(df, path, exact=True)
    got = read_csv(spark, path, df.schema, exact=True, multi_line=True)
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)


def test_csv_bad_rows_are_kept_dropped_or_fail(spark, scratch):
    path = scratch("bad")
    spark.createDataFrame([("1",), ("x",)], "id string").write.option("header", True).csv(path)
    schema = "id int, bad string"
    rows = {r["id"]: r["bad"] for r in read_csv(spark, path, schema, bad_row_column="bad").collect()}
    assert rows == {1: None, None: "x"}
    assert read_csv(spark, path, "id int", bad_rows="DROPMALFORMED").collect() == [(1,)]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, "id int", bad_rows="FAILFAST").collect()


def test_latest_orders_text_tags_as_numbers(spark):
    history = spark.createDataFrame([("k", str(b), float(b)) for b in range(12)], "key string, batch_id string, v double")
    assert latest_per_key(history, ["key"]).collect()[0]["v"] == 11.0


def test_replayed_batch_counts_once(spark):
    rows = [("k", "0", 10.0, 1), ("k", "1", 20.0, 1), ("k", "1", 20.0, 1)]
    history = spark.createDataFrame(rows, "key string, batch_id string, avg_v double, n_v long")
    assert combine_batch_means(history, ["key"], ["v"]).collect()[0]["avg_v"] == 15.0


def test_empty_replay_clears_its_partition(spark, scratch):
    path = scratch("history")
    write = fan_out(parquet_history_sink(path))
    write(spark.range(3), 0)
    write(spark.range(2), 1)
    write(spark.range(0), 1)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(0, 0), (1, 0), (2, 0)]


def test_a_large_batch_keeps_its_writers(spark):
    seen = []
    df = spark.range(900_000, numPartitions=64).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    fan_out(lambda out, b: seen.append(out.rdd.getNumPartitions()))(df, 0)
    fan_out(lambda out, b: seen.append(out.rdd.getNumPartitions()))(spark.range(100, numPartitions=64), 1)
    assert seen[0] > 4 and seen[1] == 1


def test_broken_bytes_do_not_stop_the_reader(spark, scratch):
    path = scratch("topic")
    df = spark.createDataFrame([(bytearray(b"\xffoops"),), (bytearray(b'{"k":1}'),), (None,), (bytearray(b"{"),)], "value binary")
    write_messages(df, path)
    schema = StructType([StructField("k", IntegerType())])
    messages = read_messages(spark, path)
    assert sorted(str(r.k) for r in decode_messages(messages, schema).collect()) == ["1", "None", "None", "None"]
    flags = {r[0]: r[1] for r in messages.select(utf8_text("value"), is_utf8("value")).collect()}
    assert flags == {"\ufffdoops": False, '{"k":1}': True, "{": True, None: None}
    out = scratch("rejected")
    await_done(run_rejected(read_messages_stream(spark, path), [parquet_history_sink(out)], scratch("ckpt"), schema=schema))
    got = {(r["value"], r["is_utf8"]) for r in spark.read.parquet(out).collect()}
    assert got == {("\ufffdoops", False), ("{", True), (None, True)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_joins_equal_plain_ones(spark, how):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 5 == 0, F.lit(None))
         .otherwise(F.col("id") % 200).cast("int").alias("k"), (F.col("id") % 7).alias("x"))
    dim = spark.range(150).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    dim = dim.union(spark.createDataFrame([(None, 5), (0, 77)], "k int, v long"))
    plain = facts.join(dim, "k", how)
    for joined in (salted_join(facts, dim, "k", how), salted_join(facts, dim, "k", how, 4, hot_keys(facts, "k", 0.05))):
        assert joined.columns == plain.columns
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    assert [tuple(r) for r in hot_keys(facts, "k", 0.05).collect()] == [(0,)]
    assert hot_keys(facts.limit(0), "k").isEmpty()


def test_salted_joins_keep_columns_named_like_their_helpers(spark):
    facts = spark.range(300).select((F.col("id") % 4).alias("k"), F.col("id").alias("_salt"), F.lit("a").alias("_n"))
    dim = spark.range(3).select(F.col("id").alias("k"), (F.col("id") + 7).alias("_Hot"), F.lit(1).alias("_all"))
    plain = facts.join(dim, "k")
    for joined in (salted_join(facts, dim, "k"), salted_join(facts, dim, "k", "inner", 4, hot_keys(facts, "k", 0.05))):
        assert joined.columns == plain.columns
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_stream_without_a_broadcast_is_salted(spark, scratch):
    path = scratch("topic")
    write_messages(spark.createDataFrame([("1",)] * 9, "value string"), path)
    stream = read_messages_stream(spark, path).select(F.col("value").cast("string").cast("int").alias("k"), F.lit(1).alias("x"))
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    assert "_salt" in plan_text(enrich(stream, dim, "k", "left", broadcast=False))
    for facts, side, kwargs in ((dim, stream, {}), (dim, stream, {"broadcast": False}), (stream, dim, {})):
        out = scratch("history")
        joined = enrich(facts, side, "k", "inner", **kwargs)
        assert joined.columns == ["k", *[c for c in (*facts.columns, *side.columns) if c != "k"]]
        await_done(start(joined, fan_out(parquet_history_sink(out)), scratch("ckpt"), "append"))
        rows = spark.read.parquet(out).collect()
        assert len(rows) == 9 and {(r["k"], r["name"], r["x"]) for r in rows} == {(1, "a", 1)}


def test_either_side_wins_a_shared_column(spark):
    facts = spark.createDataFrame([(1, "f")], "k int, name string")
    dim = spark.createDataFrame([(1, "d")], "k int, name string")
    assert enrich(facts, dim, "k").collect() == [(1, "d")]
    assert enrich(facts, dim, "k", keep="facts").collect() == [(1, "f")]
    with pytest.raises(ValueError):
        enrich(facts, dim, "k", broadcast="yes")
    with pytest.raises(ValueError):
        gold_stats(facts, dim, "k", broadcast="always")
    assert fits_broadcast(dim)


def test_one_timestamp_type(spark):
    df = spark.range(1).select(run_timestamp().alias("a"), run_timestamp("2024-01-01").alias("b"))
    assert [t for _, t in df.dtypes] == ["timestamp_ntz", "timestamp_ntz"]


def test_batches_follow_the_files(spark, scratch):
    path = scratch("topic")
    write_messages(spark.range(40).select(F.col("id").cast("string").alias("value")), path, rows_per_file=1)
    assert files_per_batch(spark, path, 8) == 5 and files_per_batch(spark, path, 1000) == 1


def test_login_text_is_quoted():
    line = kafka_options("b:1", "SASL_PLAINTEXT", "PLAIN", "u", 'a"b\\c')["kafka.sasl.jaas.config"]
    assert line.endswith('password="a\\"b\\\\c";')
