"""Quoted CSV with line breaks inside fields, read by many tasks a file.

Spark gives a multi-line CSV file to one task, as a line break may lie inside
quotes. Whether it does follows from the number of quotes before it, and that
adds up:

1. Every byte range of a file (Spark's own splits of the text source) counts its
   quotes. One row a range, summed up along each file, tells for each range
   whether it starts inside quotes.
2. With that, every range is cut into records as its lines are read: a record
   starts at a line with an even number of quotes before it. Records that lie
   whole in a range, nearly all, go straight on to the parser. Only the lines
   before a range's first record and its last record, which the next range may
   go on with, are shuffled, at most two rows a range, and put together.

Lines end at ``\\n``; a ``\\r`` before the end of a record is dropped. Quotes inside
quotes must be doubled (RFC 4180), not escaped by a backslash. Empty lines
between records are skipped. A quote that is never closed swallows the rest of
its file, as it does in any reader.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestream.operators.enrich import fits_broadcast

# tasks get this module's functions with the plan, also where the package isn't installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a piece of text is: a whole record, the first lines of a range, its last record.
_WHOLE, _HEAD, _TAIL = 0, 1, 2
_PIECES = "file string, start long, kind int, first boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file and where its byte range starts, in file order within a range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _open_at_start(lines: DataFrame) -> DataFrame:
    """For each byte range, whether it starts inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _range_runs(batch: pa.RecordBatch):
    """Runs of a batch's lines that are of one byte range."""
    start, file = batch.column("start").to_numpy(), batch.column("file")
    new = np.ones(batch.num_rows, bool)
    new[1:] = (start[1:] != start[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
    at = np.append(np.flatnonzero(new), batch.num_rows)
    return [batch.slice(a, b - a) for a, b in zip(at[:-1], at[1:])]


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """The lines from each start to the next one as one text."""
    offsets = pa.array(np.append(starts, len(lines)).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


def _cut(batches):
    """Lines of byte ranges to records, and the pieces at a range's ends."""
    # the range; its lines not yet given out; whether quotes are open; records begun in it
    key, held, inside, begun = None, [], False, 0

    def pieces(kinds, texts: pa.Array, first_record: int):
        """``first_record``: the number, in its range, of the record that the first text is (of)."""
        n = len(texts)
        first = (np.arange(first_record, first_record + n) == 0) & (key[1] == 0)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array(kinds, pa.int32()),
             pa.array(first, pa.bool_()), texts], names=["file", "start", "kind", "first", "text"])

    def rest():
        """What is held when its range ends: the last record, or lines of one that began before."""
        return pieces([_TAIL if begun else _HEAD], _joined(pa.array(held, pa.string()), np.array([0])), begun - 1)

    for batch in batches:
        if not batch.num_rows:
            continue
        for own in _range_runs(batch):
            at = own.column("file")[0].as_py(), own.column("start")[0].as_py()
            if at != key:
                if held:
                    yield rest()
                key, held, inside, begun = at, [], own.column("inside")[0].as_py(), 0
            lines = own.column("value").cast(pa.string())
            odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
            after = (np.cumsum(odd) + inside) % 2 == 1
            begins = np.flatnonzero(~np.append(inside, after[:-1]))
            inside = bool(after[-1])
            if not len(begins):
                held += lines.to_pylist()
                continue
            # what is held, and lines before the first start, are of an earlier record
            earlier = bool(held) or begins[0] > 0
            begins = begins + len(held)
            lines = pa.concat_arrays([pa.array(held, pa.string()), lines])
            starts = np.append(0, begins) if earlier else begins
            texts = _joined(lines, starts)
            kinds = np.full(len(texts) - 1, _WHOLE)
            if earlier and not begun:
                kinds[0] = _HEAD
            if len(kinds):
                yield pieces(kinds, texts.slice(0, len(kinds)), begun - earlier)
            begun += len(begins)
            held = lines.slice(int(begins[-1])).to_pylist()  # the last record may go on
    if held:
        yield rest()


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``first`` (the file's first record) and ``text`` of each record."""
    lines = _lines(spark, path)
    ranges = _open_at_start(lines)
    if fits_broadcast(ranges):  # lines stay in the order they are read in
        marked = lines.join(F.broadcast(ranges), ["file", "start"])
    else:
        marked = lines.withColumn("at", F.monotonically_increasing_id()).join(ranges, ["file", "start"]).sortWithinPartitions(
            "file", "start", "at")
    pieces = marked.select("value", "file", "start", "inside").mapInArrow(_cut, _PIECES)
    # the ends of ranges: a last record, and the lines that later ranges have of it
    ends = pieces.where(F.col("kind") != _WHOLE)
    order = Window.partitionBy("file").orderBy("start", "kind")
    ends = ends.withColumn("record", F.sum(F.expr(f"int(kind = {_TAIL})")).over(order))
    put = ends.groupBy("file", "record").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))), lambda p: p["text"]), "\n").alias("text"))
    return pieces.where(F.col("kind") == _WHOLE).select("file", "first", "text").unionByName(put.select("file", "first", "text"))


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """The rows of quoted CSV files with ``schema``, however their records lie over the byte ranges that tasks read.

    ``spark.sql.files.maxPartitionBytes`` sets the size of a range. ``options``
    are those of Spark's CSV parser.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = F.regexp_replace("text", "\r$", "")
    own = records(spark, path).select("first", text.alias("text")).where(F.col("text") != "")
    if header:
        own = own.where(~F.col("first"))
    parsed = own.select(F.from_csv("text", _ddl(schema), {**(options or {}), "mode": "PERMISSIVE", "multiLine": "true"}).alias("r"))
    return parsed.select("r.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
