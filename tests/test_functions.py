"""Column expressions: cleaner, numeric tests, JSON envelopes (edge rows from FIXTURES.md)."""

from __future__ import annotations

import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestream.functions import as_double, clean_text, is_numeric, json_envelope, parse_json_column


def _one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_clean_text_edge_rows(spark):
    cases = {
        "Côte d'Ivoire": "Cted'Ivoire", "63-65": "6365", "-5": "5", 'a\\b"c': 'a\\b"c',
        "x y\tz\n": "xyz", "": "", None: "None", "😀 ok": "ok", "a(b)[c]": "abc",
    }
    df = _one_col(spark, list(cases))
    got = {r.x: r.c for r in df.select("x", clean_text("x").alias("c")).collect()}
    assert got == cases


def test_clean_text_keeps_null_when_asked(spark):
    df = _one_col(spark, [None, "a b"])
    got = [r.c for r in df.select(clean_text("x", null_text=None).alias("c")).collect()]
    assert got == [None, "ab"]


_KEPT = set(string.ascii_letters + string.digits + ",.\\\"'")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_clean_text_keeps_exactly_the_listed_characters(spark, texts):
    df = _one_col(spark, texts)
    got = [r.c for r in df.select(clean_text("x").alias("c")).collect()]
    assert got == ["".join(c for c in t if c in _KEPT) for t in texts]


def test_numeric_edge_rows(spark):
    good = {"180": 180.0, "180.5": 180.5, " 180 ": 180.0, "1e2": 100.0, "+5": 5.0, ".5": 0.5,
            "5.": 5.0, "70d": 70.0, "70f": 70.0}
    bad = ["", "na", "63-65", "1,5", "0x10", "١", None]
    df = _one_col(spark, list(good) + bad)
    rows = df.select("x", as_double("x").alias("d"), is_numeric("x").alias("ok")).collect()
    got = {r.x: (r.d, r.ok) for r in rows}
    for k, v in good.items():
        assert got[k] == (v, True)
    for k in bad:
        assert got[k] == (None, False)


def test_numeric_nan_infinity(spark):
    df = _one_col(spark, ["NaN", "Infinity", "5"])
    rows = df.select("x", is_numeric("x").alias("a"), is_numeric("x", finite_only=True).alias("f")).collect()
    assert {r.x: (r.a, r.f) for r in rows} == {"NaN": (True, False), "Infinity": (True, False),
                                               "5": (True, True)}


def test_envelope_drops_nulls_and_escapes(spark):
    df = spark.createDataFrame([(1, None, 'a"b', float("nan"))], "a int, b int, c string, d double")
    v = df.select(json_envelope("a", "b", "c", "d").alias("v")).first().v
    assert v == '{"a":1,"c":"a\\"b","d":"NaN"}'
    v2 = df.select(json_envelope("a", "b", keep_nulls=True).alias("v")).first().v
    assert v2 == '{"a":1,"b":null}'


def test_envelope_keeps_microseconds(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' as ts")
    v = df.select(json_envelope("ts").alias("v")).first().v
    assert v == '{"ts":"2024-01-01T00:00:07.179575"}'
    back = df.select(json_envelope("ts").alias("v")).select(parse_json_column("v", df.schema).alias("s"))
    assert back.select("s.ts").first()[0] == df.first().ts


def test_parse_json_edge_rows(spark):
    schema = "edition_id int, athlete_id int, pos string, isTeamSport string"
    values = [
        '{"edition_id":1,"athlete_id":2,"pos":3,"isTeamSport":true,"extra":1}',
        '{"edition_id":"x","athlete_id":2}',
        '{"edition_id":99999999999,"athlete_id":7}',
        '{"edition_id":1.5,"athlete_id":7}',
        "not json", "", "[]", None, '{"Edition_ID":4}',
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", parse_json_column("v", schema).alias("s")).select("i", "s.*").orderBy("i").collect()
    got = [tuple(r)[1:] for r in rows]
    assert got[0] == (1, 2, "3", "true")
    assert got[1] == (None, 2, None, None)
    assert got[2] == (None, 7, None, None)
    assert got[3] == (None, 7, None, None)
    for g in got[4:]:
        assert g == (None, None, None, None)


def test_binary_value_is_decoded(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":5}'),)], "v binary")
    assert df.select(parse_json_column("v", "a int").alias("s")).select("s.a").first()[0] == 5


def test_run_timestamp_constant_per_query(spark):
    from lakestream.functions import run_timestamp

    df = spark.range(1000).repartition(8).select(run_timestamp().alias("t"))
    assert df.agg(F.countDistinct("t")).first()[0] == 1
    lit = spark.range(1).select(run_timestamp("2024-01-01 00:00:00").alias("t"))
    assert lit.schema["t"].dataType.typeName() == "timestamp_ntz"
