"""Types of text columns observed while a layer is written."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestream.plans import landing_to_bronze
from lakestream.sources import layer_path, read_csv, read_layer, write_csv, write_layer
from lakestream.sources.types import TYPES, fitting_types, known_types, type_of

CASES = {
    "int": ["1", "-7", "+3", "2147483647"],
    "bigint": ["1", "2147483648"],
    "decimal(38,0)": ["5", "9223372036854775808"],
    "double": ["1", "9223372036854775808", "1.5", ".5", "1e9", "NaN", "-Inf"],
    "date": ["2024-01-31", "1999-12-01"],
    "timestamp": ["2024-01-31", "2024-01-31T10:00:00.123456Z", "2024-02-01 00:00:00"],
    "boolean": ["true", "FALSE"],
    "string": ["1", "true"],
}


def test_a_column_has_the_narrowest_type_that_all_values_fit(spark):
    rows = [(t, v) for t, vs in CASES.items() for v in [*vs, None]]
    rows += [(t, v) for t, v in [("s1", "2024-13-01"), ("s2", " 1"), ("s3", "1d"), ("s4", ""), ("s5", "2024-01-01 1"), ("s6", None)]]
    df = spark.createDataFrame(rows, "t string, v string")
    found = {r.t: type_of(r.bits) for r in df.groupBy("t").agg(F.bit_and(fitting_types(F.col("v"))).alias("bits")).collect()}
    assert found == {**{t: t for t in CASES}, **{f"s{i}": "string" for i in range(1, 7)}}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from([v for vs in CASES.values() for v in vs] + ["x", ""]), min_size=1, max_size=6))
def test_any_value_read_back_is_the_value_written(spark, values):
    """Whatever the type, no value is lost by the cast."""
    df = spark.createDataFrame([(v,) for v in values], "v string")
    kind = type_of(df.agg(F.bit_and(fitting_types(F.col("v")))).first()[0])
    assert kind in (*TYPES, "string")
    assert df.select(F.col("v").cast(kind)).where("v is null").count() == 0


@pytest.mark.parametrize("versions", [False, True])
def test_landing_is_read_once(spark, scratch, versions):
    root = scratch("lake")
    rows = [(i, f"{i}.5", "x\ny" if i % 2 else None, "2024-01-31") for i in range(2000)]
    write_csv(spark.createDataFrame(rows, "a int, b string, `c d.e` string, day string"), f"{root}/landing/t.csv", exact=True)
    spark.sparkContext.setJobGroup("landing", "landing")
    try:
        landing_to_bronze(spark, f"{root}/landing", root, ["t"], csv={"exact": True, "multi_line": True}, versions=versions,
                          observed_types=True)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    back = read_layer(spark, root, "bronze", "t")
    assert back.dtypes == [("a", "int"), ("b", "double"), ("c d.e", "string"), ("day", "date")]
    assert sorted(tuple(r[:3]) for r in back.collect()) == sorted((a, float(b), c) for a, b, c, _ in rows)


def test_one_scan_in_the_plan(spark, scratch):
    from conftest import plan_text
    from lakestream.sources.types import observe_types
    path = scratch("csv")
    write_csv(spark.range(100), path)
    df, found = observe_types(read_csv(spark, path, infer=False))
    text = plan_text(df)
    assert text.count("FileScan csv") == 1 and "Exchange" not in text and "CollectMetrics" in text
    df.write.format("noop").mode("overwrite").save()
    assert type_of(found()["id"]) == "int"


def test_a_later_write_widens_a_type(spark, scratch):
    root = scratch("lake")
    def put(values, mode="append", observed=True):
        df = spark.createDataFrame([(v,) for v in values], "v string")
        write_layer(df, root, "bronze", "t", mode, versions=True, observed_types=observed)
    put(["1", None], "overwrite")
    put([None])  # no value: fits whatever there is
    put(["2.5"])
    kinds = [dict(read_layer(spark, root, "bronze", "t", v).dtypes)["v"] for v in (1, 2, 3)]
    assert kinds == ["int", "int", "double"]
    put(["x"], observed=False)  # not observed: the whole column is text again
    assert dict(read_layer(spark, root, "bronze", "t").dtypes)["v"] == "string"
    assert read_layer(spark, root, "bronze", "t").count() == 5


def test_odd_tables(spark, scratch):
    root = scratch("lake")
    write_layer(spark.createDataFrame([], "a string, b int"), root, "bronze", "empty", observed_types=True)
    assert read_layer(spark, root, "bronze", "empty").dtypes == [("a", "string"), ("b", "int")]
    write_layer(spark.range(3), root, "bronze", "numbers", observed_types=True)  # no text column
    assert read_layer(spark, root, "bronze", "numbers").dtypes == [("id", "bigint")]
    with pytest.raises(ValueError, match="overwrite"):
        write_layer(spark.range(3), root, "bronze", "numbers", "append", observed_types=True)
    write_layer(spark.createDataFrame([("7",)], "a string"), root, "bronze", "empty")  # replaced by a plain one
    assert read_layer(spark, root, "bronze", "empty").dtypes == [("a", "string")]
    assert known_types(spark, [layer_path(root, "bronze", "empty")]) == {}


def test_one_expression_observes_all_columns(spark):
    """Patterns for each column, and twice in each bit_and, were more code than the JVM compiles."""
    from conftest import plan_text
    from lakestream.sources.types import observe_types
    many = spark.createDataFrame([tuple("123456789")], [*"abcdefgh", "bits"])
    df, found = observe_types(many)
    assert plan_text(df).count("RLIKE") < 10 and df.columns == many.columns
    df.write.format("noop").mode("overwrite").save()
    assert {type_of(b) for b in found().values()} == {"int"} and len(found()) == 9


def test_values_near_the_bounds_of_cheap_checks(spark):
    cases = {"int": ["000000000000000000000000000007", "-2147483648", "12\n"], "bigint": ["-2147483649", "999999999999"],
             "decimal(38,0)": ["9" * 38, "-9223372036854775809"],
             "double": ["9" * 39, "123e-5", "1.5e-3", "5.", "+Infinity\n", "NaN\r\n", "-1.5"],
             "date": ["2024-02-29", "2024-01-31\n"], "timestamp": ["2024-02-01T00:00:00+02:00", "2024-01-31 10:00:00.5"],
             "boolean": ["TRUE", "false"],
             "string": ["1-2", "12-3-45-6", "2024-02-30", "2024-02-01 25:00:00", "N", "t", "-", "+", ".", "/", ",", "1d", "x" * 50, "NaN ", "1e"]}
    df = spark.createDataFrame([(t, v) for t, vs in cases.items() for v in vs], "t string, v string")
    found = [(r.t, r.v, type_of(r.bits)) for r in df.select("t", "v", fitting_types(F.col("v")).alias("bits")).collect()]
    assert [f for f in found if f[0] != f[2]] == []
