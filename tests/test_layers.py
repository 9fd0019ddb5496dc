"""Versioned layers and CSV files with quoted line breaks that several tasks read."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from lakestream.sources import layer_path, read_csv, read_layer, write_csv, write_layer
from lakestream.sources.csv_split import read_quoted_csv, records
from lakestream.sources.files import EXACT_CSV
from lakestream.sources.versions import (VersionConflict, describe_version, expire_versions, read_version, version_numbers,
                                         write_version)


def _local(path):
    return path.removeprefix("file://").removeprefix("file:")


@pytest.mark.parametrize("versions", [False, True])
def test_a_failed_overwrite_leaves_the_old_version(spark, scratch, versions):
    root = scratch("lake")
    write_layer(spark.range(10), root, "bronze", "t", versions=versions)
    broken = spark.range(5).withColumn("id", F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")))
    with pytest.raises(Exception, match="stop"):
        write_layer(broken, root, "bronze", "t", versions=versions)
    assert read_layer(spark, root, "bronze", "t").count() == 10
    assert version_numbers(spark, layer_path(root, "bronze", "t")) == ([1] if versions else [])
    write_layer(spark.range(3), root, "bronze", "t")
    assert read_layer(spark, root, "bronze", "t").count() == 3
    if versions:
        assert read_layer(spark, root, "bronze", "t", version=1).count() == 10


def test_a_replacement_cut_short_between_its_renames(spark, scratch):
    root = scratch("lake")
    path = _local(write_layer(spark.range(10), root, "bronze", "t"))
    os.rename(path, f"{path}.replaced")  # as if the job had died here
    assert read_layer(spark, root, "bronze", "t").count() == 10
    write_layer(read_layer(spark, root, "bronze", "t").where("id < 6"), root, "bronze", "t")
    assert spark.read.parquet(path).count() == 6 and sorted(os.listdir(os.path.dirname(path))) == ["t"]


def test_a_write_that_was_staged_but_not_committed_is_not_seen(spark, scratch):
    path = scratch("t")
    write_version(spark.range(4), path)
    spark.range(99).write.parquet(f"{path}/_data/_write=00000000000000000002-killed")
    assert read_version(spark, path).count() == 4
    assert write_version(spark.range(5), path).version == 2
    write_version(spark.range(6), path)
    dropped = expire_versions(spark, path, keep=1)
    assert len(dropped) == 3 and any("killed" in f for f in dropped)
    assert read_version(spark, path).count() == 6
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, 1)


def test_append_lists_the_old_folders_and_pushes_filters(spark, scratch):
    root = scratch("lake")
    write_layer(spark.range(10).withColumn("p", F.col("id") % 2), root, "silver", "t", partition_by=["p"], versions=True)
    write_layer(spark.range(10, 15).withColumn("p", F.col("id") % 2), root, "silver", "t", mode="append", partition_by=["p"])
    path = layer_path(root, "silver", "t")
    made = describe_version(spark, path)
    assert (made.version, made.rows, len(made.folders), made.mode) == (2, 15, 2, "append")
    got = read_layer(spark, root, "silver", "t")
    assert sorted(r["id"] for r in got.where("p = 1").collect()) == list(range(1, 15, 2))
    write_layer(spark.range(0), root, "silver", "t")
    assert read_layer(spark, root, "silver", "t").count() == 0


def test_writers_that_expect_a_version(spark, scratch):
    path = scratch("t")
    write_version(spark.range(1), path, expected=0)
    with pytest.raises(VersionConflict):
        write_version(spark.range(2), path, expected=0)
    errors = []

    def add(k):
        try:
            write_version(spark.range(k, k + 1), path, mode="append")
        except Exception as e:  # shown below
            errors.append(e)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(1, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and sorted(r["id"] for r in read_version(spark, path).collect()) == [0, 1, 2, 3, 4]
    assert version_numbers(spark, path) == [1, 2, 3, 4, 5]


def test_plain_folders_are_read_as_they_stand(spark, scratch):
    root = scratch("lake")
    spark.range(7).write.parquet(layer_path(root, "bronze", "plain"))
    assert read_layer(spark, root, "bronze", "plain").count() == 7


SCHEMA = "id int, a string, b string, c double"


def _file(scratch, text):
    path = _local(scratch("csv")) + ".csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def _many_lines(n):
    rows = []
    for i in range(n):
        a = ("x" * (i * 37 % 90)) + ("\n" * (i % 4)) + (' say ""hi"", ' if i % 3 == 0 else " plain ") + "é" * (i % 5)
        b = "line\n\n" * (40 if i % 50 == 7 else i % 3)
        rows.append(f'{i},"{a}","{b}",{i / 4}' if i % 6 else f'{i},word,,{i / 4}')
    return "id,a,b,c\n" + "\n".join(rows) + "\n"


@pytest.mark.parametrize("chunk, batch", [(257, 10000), (1000, 3), (4096, 10000), (1 << 20, 1)])
def test_one_quoted_file_is_read_by_many_tasks(spark, scratch, chunk, batch):
    path = _file(scratch, _many_lines(400))
    want = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).options(**EXACT_CSV).csv(path).collect()
    settings = {"spark.sql.files.maxPartitionBytes": str(chunk), "spark.sql.files.openCostInBytes": "0",
                "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = read_quoted_csv(spark, path, SCHEMA, options=EXACT_CSV)
        rows, tasks = got.collect(), records(spark, path).where("file is not null").rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(str, rows)) == sorted(map(str, want)) and len(rows) == 400
    assert chunk > 4096 or tasks > 4


def test_line_ends_empty_lines_and_headers(spark, scratch):
    path = _file(scratch, 'id,a,b,c\r\n1,"x\r\ny",z,1.5\r\n\r\n2,"",,\r\n')
    got = sorted(map(tuple, read_quoted_csv(spark, path, SCHEMA).collect()))
    assert got == [(1, "x\r\ny", "z", 1.5), (2, None, None, None)] or got == [(1, "x\r\ny", "z", 1.5), (2, "", None, None)]
    assert read_quoted_csv(spark, path, SCHEMA, header=False).count() == 3
    assert read_quoted_csv(spark, _file(scratch, ""), SCHEMA).count() == 0
    assert read_quoted_csv(spark, _file(scratch, "id,a,b,c\n"), SCHEMA).count() == 0


def test_texts_come_back_through_files_that_are_split(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(
        spark.createDataFrame([(None, None, "", 'a "quoted"\n\r\n end\\', 3), (-1, "\n\n", None, '"', None)],
                              "doc_id long, text string, lang string, source string, n_chars long"))
    path = scratch("docs")
    write_csv(docs.coalesce(1), path, exact=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = read_csv(spark, path, docs.schema, exact=True, multi_line=True)
        assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
