"""DataFrame operators: quality, joins, statistics."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestream.operators import (clean_string_columns, coerce_numeric, dedup_rows, distinct_values,
                                  drop_shared_columns, enrich, estimate_size, group_means,
                                  indicator_columns, indicator_map,
                                  latest_per_key, numeric_rows, profile, quarantine_unparsed,
                                  require_not_null, split_hot_join)

from conftest import SF_SMALL, plan_text


def _plan(df) -> str:
    return plan_text(df)


def test_numeric_rows_keeps_original_types(spark):
    df = spark.createDataFrame([(1, "180", "80"), (2, "na", "80"), (3, "170", ""), (4, None, "1")],
                               "id int, height string, weight string")
    out = numeric_rows(df, ["height", "weight"])
    assert out.columns == df.columns and out.schema == df.schema
    assert [r.id for r in out.collect()] == [1]


def test_coerce_numeric_nulls_bad_text(spark):
    df = spark.createDataFrame([("180", 5), ("63-65", 6)], "height string, weight int")
    out = coerce_numeric(df, ["height", "weight"]).collect()
    assert [tuple(r) for r in out] == [(180.0, 5.0), (None, 6.0)]


def test_clean_string_columns_only_strings_and_excludes(spark):
    df = spark.createDataFrame([(1, "a b", "c d", 2.5)], "id int, s string, keep string, x double")
    out = clean_string_columns(df, exclude=["keep"]).first()
    assert tuple(out) == (1, "ab", "c d", 2.5)


def test_dedup_null_safe(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert dedup_rows(df).count() == 2


def test_require_not_null_keeps_nan(spark):
    df = spark.createDataFrame([("a", float("nan")), (None, 1.0), ("b", None)], "k string, v double")
    assert require_not_null(df, ["k"]).count() == 2


def test_quarantine_unparsed(spark):
    df = spark.createDataFrame([('{"a":1}',), ("junk",)], "v string").select(
        F.from_json("v", "a int").alias("s"))
    good, bad = quarantine_unparsed(df, "s")
    assert good.count() == 1 and bad.count() == 1


def test_drop_shared_columns_other_side_wins(spark):
    facts = spark.createDataFrame([(1, "X", "swim")], "athlete_id int, country_noc string, sport string")
    dim = spark.createDataFrame([(1, "USA")], "athlete_id int, country_noc string")
    assert drop_shared_columns(facts, dim, "athlete_id").columns == ["athlete_id", "sport"]
    row = enrich(facts, dim, "athlete_id").first()
    assert row.country_noc == "USA" and row.sport == "swim"


def test_estimate_size_counts_rows_and_text(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, None)], "a int, s string")
    est = estimate_size(df)
    assert est.rows == 2
    assert est.bytes == 2 * 2 * 16 + 4


def test_enrich_checked_broadcast_and_fallback(spark):
    facts = spark.range(1000).select((F.col("id") % 10).cast("int").alias("k"), F.col("id"))
    dim = spark.range(10).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    small = enrich(facts, dim, "k", broadcast="checked")
    assert "BroadcastHashJoin" in _plan(small)
    # over the limit: no hint; with Spark's own size-based broadcast off, a shuffle join
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        big = enrich(facts, dim, "k", broadcast="checked", max_broadcast_bytes=10)
        assert "BroadcastHashJoin" not in plan_text(big)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    finally:
        for k, v in before.items():  # restore the session's values, not Spark's defaults
            spark.conf.set(k, v)


def test_no_nested_loop_join_for_the_enrichment(spark):
    facts = spark.createDataFrame([(1, "swim")], "athlete_id int, sport string")
    dim = spark.createDataFrame([(1, "M")], "athlete_id int, sex string")
    plan = _plan(enrich(facts, dim, "athlete_id", "left", broadcast=True))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_hot_join_equals_plain_join(spark, how):
    # key 0 holds a third of all facts; key NULL and unmatched keys must survive a left join
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 97 == 0, F.lit(None))
         .otherwise(F.col("id") % 200).cast("int").alias("k"), F.col("id"))
    dim = spark.range(150).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    split = split_hot_join(facts, dim, "k", how, hot_key_share=0.05)
    plain = facts.join(dim, "k", how)
    assert split.count() == plain.count()
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_group_means_null_group_and_bad_measures(spark):
    df = spark.createDataFrame(
        [("swim", None, "M", "USA", "180", "80"), ("swim", None, "M", "USA", "na", "90"),
         ("swim", "Gold", "M", "USA", "170", None)],
        "sport string, medal string, sex string, country_noc string, height string, weight string")
    out = {r.medal: (r.avg_height, r.avg_weight) for r in group_means(df, run_ts="2024-01-01").collect()}
    assert out == {None: (180.0, 85.0), "Gold": (170.0, None)}


def test_distinct_values_one_pass(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1)], "x string, y int")
    got = sorted(distinct_values(df, ["x", "y"]).collect(), key=lambda r: (r.column, str(r.value)))
    assert [tuple(r) for r in got] == [("x", "a"), ("x", "b"), ("y", "1"), ("y", None)]


def test_indicator_columns_and_map(spark):
    df = spark.createDataFrame([(1, "Gold", "Men s"), (2, None, "Women")], "id int, medal string, sex string")
    df = df.union(spark.createDataFrame([(3, "None", "Men_s")], df.schema))
    pairs = [tuple(r) for r in distinct_values(df, ["medal", "sex"]).collect()]
    wide = indicator_columns(df, ["medal", "sex"], pairs, keep=["id"])
    assert wide.columns == ["id", "medal__Gold", "medal__None", "medal___null_", "sex__Men_20_s", "sex__Men_5f_s", "sex__Women"]
    assert [tuple(r) for r in wide.orderBy("id").collect()] == [
        (1, 1, 0, 0, 1, 0, 0), (2, 0, 0, 1, 0, 0, 1), (3, 0, 1, 0, 0, 1, 0)]
    m = [{tuple(k): v for k, v in r.indicators.items()}
         for r in indicator_map(df, ["medal", "sex", "sex"], keep=["id"]).orderBy("id").collect()]
    assert m[0] == {("medal", "Gold"): 1, ("sex", "Men s"): 1}
    assert m[1] == {("medal", None): 1, ("sex", "Women"): 1}
    assert m[2] == {("medal", "None"): 1, ("sex", "Men_s"): 1}
    with pytest.raises(ValueError):
        indicator_columns(df.withColumn("medal__Gold", F.lit(1)), ["medal"], pairs)


def test_profile_single_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    rows = {r.column: (r.data_type, r.non_null, r.rows) for r in profile(df).collect()}
    assert rows == {"a": ("int", 2, 2), "b": ("string", 1, 2)}


def test_latest_per_key_numeric_batch_order(spark):
    hist = spark.createDataFrame([("a", 1.0, 9), ("a", 2.0, 10), ("b", 5.0, 2), (None, 7.0, 1)],
                                 "k string, v double, batch_id int")
    got = {r.k: r.v for r in latest_per_key(hist, ["k"]).collect()}
    assert got == {"a": 2.0, "b": 5.0, None: 7.0}


def test_flagship_on_smoke_tables(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["sport", "medal", "sex", "country_noc", "avg_height", "avg_weight", "timestamp"]
    assert df.count() > 0
    assert "BroadcastHashJoin" in _plan(entry.q_gold_stats(spark, SF_SMALL))


def test_weighted_means_equal_means_of_expanded_rows(spark):
    from lakestream.operators import weighted_means

    rows = [("a", "1.5", "x", 3), ("a", "na", "2", 2), ("a", None, "4", 1), ("b", "NaN", "1", 2),
            ("c", "bad", None, 5)]
    df = spark.createDataFrame(rows, "g string, height string, weight string, n long")
    expanded = df.select("g", "height", "weight", F.explode(F.sequence(F.lit(1), "n")).alias("_"))
    want = sorted(map(tuple, group_means(expanded, ["g"], ["height", "weight"], ts_col=None).collect()),
                  key=str)
    got = sorted(map(tuple, weighted_means(df, "n", ["g"], ["height", "weight"], ts_col=None).collect()),
                 key=str)
    assert str(got) == str(want)  # str() so NaN == NaN


# text → value as try_cast(x as double) gives it, for the strings generated below
_AS_DOUBLE = {"150": 150.0, "180.5": 180.5, "-5": -5.0, "NaN": float("nan"), "Infinity": float("inf"),
              "na": None, "": None, None: None}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(sorted(_AS_DOUBLE, key=str)),
                          st.integers(1, 5)), min_size=1, max_size=25))
def test_weighted_means_property(spark, rows):
    import math

    from lakestream.operators import weighted_means

    df = spark.createDataFrame(rows, "g string, height string, n long")
    got = {r.g: r.avg_height for r in weighted_means(df, "n", ["g"], ["height"], ts_col=None).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        pairs = [(_AS_DOUBLE[h], n) for gg, h, n in rows if gg == g and _AS_DOUBLE[h] is not None]
        want[g] = sum(v * n for v, n in pairs) / sum(n for _, n in pairs) if pairs else None
    assert got.keys() == want.keys()
    for g, w in want.items():
        a = got[g]
        if w is None:
            assert a is None
        elif math.isnan(w):
            assert math.isnan(a)
        else:
            assert a == w or math.isclose(a, w, rel_tol=1e-12), (g, a, w)
