"""Payloads that change: typed fields, what is unknown, what doesn't fit, what is broken."""

import json

import pytest

from lakestream.operators import field_types, parse_evolving

MESSAGES = [
    (1, '{"k": 7, "n": "a"}'), (2, '{"k": "x", "extra": [1, {"y": null}]}'), (3, '{"n": null}'), (4, "{}"), (5, "[1, 2]"),
    (6, "7"), (7, "no json"), (8, None), (9, ""), (10, '{"k": 1, "k": 2}'), (11, '{"k": 99999999999, "a.b": 1, "it\'s": 2}'),
    (12, '{"K": 3}'), (13, '{"k": null, "z": null}'), (14, "null"), (15, '{"k": {"deep": 1}}'), (16, '{"k": "12"}'),
]


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(MESSAGES, "id int, value string")


def rows_of(df):
    return {r["id"]: r for r in df.collect()}


def test_nothing_of_a_message_is_lost(messages):
    rows = rows_of(parse_evolving(messages, {"k": "int", "n": "string"}, keep=("id",)))
    assert len(rows) == len(MESSAGES)
    for i, text in MESSAGES:
        r = rows[i]
        try:
            # a field twice is no object that keeps both values
            want = json.loads(text, object_pairs_hook=lambda p: dict(p) if len(dict(p)) == len(p) else None) if text else None
        except ValueError:
            want = None
        if not isinstance(want, dict):
            assert r["broken"] == text and r["k"] is r["n"] is r["unknown"] is r["misfits"] is None
            continue
        assert r["broken"] is None
        unknown = json.loads(r["unknown"] or "{}")
        assert unknown == {f: v for f, v in want.items() if f not in ("k", "n")}, i
        misfits = json.loads(r["misfits"] or "{}")
        assert all(want[f] == v and r[f] is None for f, v in misfits.items())
        for f in ("k", "n"):
            if want.get(f) is None:
                assert r[f] is None and f not in misfits
            else:
                assert (r[f] is None) == (f in misfits), (i, f)
    assert rows[1]["k"] == 7 and rows[1]["n"] == "a"
    assert rows[2]["misfits"] == '{"k":"x"}'
    assert rows[11]["misfits"] == '{"k":99999999999}' and json.loads(rows[11]["unknown"]) == {"a.b": 1, "it's": 2}
    assert rows[16]["k"] == 12  # as a cast does


def test_field_names_are_not_paths(spark):
    df = spark.createDataFrame([(1, '{"a.b": 1, "a": {"b": 2}, "it\'s": 3}')], "id int, value string")
    row = parse_evolving(df, {"a.b": "int", "it's": "int"}).first()
    assert row["a.b"] == 1 and row["it's"] == 3 and row["unknown"] == '{"a":{"b":2}}'


def test_bytes_no_fields_empty_tables_and_clashes(spark, messages):
    as_bytes = messages.selectExpr("id", "cast(value as binary) as value")
    assert rows_of(parse_evolving(as_bytes, {"k": "int"}, keep=("id",))) == rows_of(parse_evolving(messages, {"k": "int"}, keep=("id",)))
    none = rows_of(parse_evolving(messages, {}, keep=("id",)))
    assert json.loads(none[1]["unknown"]) == {"k": 7, "n": "a"} and none[1]["misfits"] is None
    assert parse_evolving(messages.limit(0), {"k": "int"}).count() == 0
    for fields, keep in (({"unknown": "int"}, ()), ({"id": "int"}, ("id",))):
        with pytest.raises(ValueError):
            parse_evolving(messages, fields, keep=keep)


def test_field_types_counts_each_type(messages):
    got = {(r["field"], r["type"]): r["messages"] for r in field_types(messages).collect()}
    assert got[("k", "BIGINT")] == 2 and got[("k", "STRING")] == 2 and got[("k", "VOID")] == 1
    assert got[("k", "OBJECT<deep: BIGINT>")] == 1 and got[("K", "BIGINT")] == 1
    assert sum(got.values()) == sum(len(json.loads(x)) for i, x in MESSAGES if x and x[0] == "{" and i != 10)
    assert field_types(messages.limit(0)).count() == 0


def test_plan_has_no_python_and_reads_what_it_needs(spark, messages):
    plan = parse_evolving(messages, {"k": "int"})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_stream_of_changing_messages(spark, tmp_path, messages):
    messages.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(messages.schema).parquet(str(tmp_path / "in"))
    query = (parse_evolving(stream, {"k": "int", "n": "string"}, keep=("id",)).writeStream.format("memory")
             .queryName("evolving").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert rows_of(spark.table("evolving")) == rows_of(parse_evolving(messages, {"k": "int", "n": "string"}, keep=("id",)))
