"""CSV landing files and Parquet lake layers (``{root}/{layer}/{table}``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lakestream.sources.csv_split import read_quoted_csv
from lakestream.sources.types import known_types, observe_types, put_types, typed
from lakestream.sources.versions import (describe_version, last_complete, put_in_place, read_version, staged_path,
                                         version_numbers, write_version)

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


# What makes a written table read back value for value: quotes doubled inside
# quotes, blanks kept, NULL apart from empty text (a text that is just \N reads
# as NULL), all six fractional digits of timestamps.
EXACT_CSV = {
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer: bool = True, exact: bool = False, multi_line: bool = False,
             bad_rows: str = "PERMISSIVE", bad_row_column: str | None = None,
             options: Mapping[str, str] | None = None) -> DataFrame:
    """Read delimited text with a header row.

    ``exact`` reads what :func:`write_csv` writes with ``exact``, and ``multi_line`` text
    with line breaks inside quotes. With both and a ``schema`` (or a header and ``infer=False``, all text), files are split over
    many tasks at record boundaries (:func:`lakestream.sources.csv_split.read_quoted_csv`);
    otherwise a multi-line file is one task, so land many files. ``bad_rows`` is Spark's parse mode: keep rows that don't fit the
    schema (``PERMISSIVE``, their text in ``bad_row_column`` if the schema has
    it), drop them (``DROPMALFORMED``) or stop (``FAILFAST``). ``options`` are
    added last.

    With no ``schema``, types are inferred (an extra pass over the files);
    at scale pass an explicit schema, or ``infer=False`` and let :func:`write_layer` observe the types, to read the data once. Plain text files
    are split over many tasks; a gzip file is read by one task, so land large
    tables as many files or uncompressed.
    """
    if multi_line and exact and schema is None and header and not infer:
        names = spark.read.options(**{**EXACT_CSV, **(options or {})}).option("header", True).option("multiLine", True).csv(path).columns
        schema = StructType([StructField(n, StringType()) for n in names])
    if multi_line and exact and schema is not None and not bad_row_column and bad_rows == "PERMISSIVE":
        return read_quoted_csv(spark, path, schema, header, {**EXACT_CSV, **(options or {})})
    reader = spark.read.option("header", header).option("mode", bad_rows)
    if exact:
        reader = reader.options(**EXACT_CSV)
    if multi_line:
        reader = reader.option("multiLine", True)
    if bad_row_column:
        reader = reader.option("columnNameOfCorruptRecord", bad_row_column)
    reader = reader.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", exact: bool = False,
              options: Mapping[str, str] | None = None) -> None:
    """Write with a header row; ``exact``: so that ``read_csv(..., exact=True, multi_line=True)`` gives the same values."""
    writer = df.write.mode(mode).option("header", True)
    if exact:
        writer = writer.options(**EXACT_CSV)
    writer.options(**(options or {})).csv(path)


def read_layer(spark: SparkSession, root: str, layer: str, table: str, version: int | None = None) -> DataFrame:
    """A lake table; filters and column selection reach the Parquet scan.

    Of a versioned table, its latest committed version or an older one. Of a
    plain one, the folder, or the one before if a replacement was cut short.
    Text columns whose types were observed when they were written are cast to them.
    """
    path = layer_path(root, layer, table)
    if version is not None or version_numbers(spark, path):
        folders = [f"{path}/{f}" for f in describe_version(spark, path, version).folders]
        return typed(read_version(spark, path, version), known_types(spark, folders))
    whole = last_complete(spark, path)
    return typed(spark.read.parquet(whole), known_types(spark, [whole]))


def write_layer(df: DataFrame, root: str, layer: str, table: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, versions: bool = False, expected: int | None = None,
                observed_types: bool = False) -> str:
    """Write a lake table as Parquet (replacing it by default, so re-runs are safe); returns its path.

    The old table stays until the new one is complete: it is written beside it
    and then takes its place. With ``versions`` (and for tables that have some)
    it is committed as the next version instead, and the ones before stay
    readable (see :mod:`lakestream.sources.versions`; ``expected`` is a version).
    ``observed_types``: the types that text columns fit are found in the same pass,
    for :func:`read_layer` (see :mod:`lakestream.sources.types`). A plain table is then
    replaced, not appended to; a version may be.
    """
    path = layer_path(root, layer, table)
    spark, note = df.sparkSession, None
    if observed_types:
        df, found = observe_types(df)

        def note(folder: str) -> None:
            put_types(spark, folder, found())

    if versions or expected is not None or version_numbers(spark, path):
        write_version(df, path, mode, partition_by, expected, note)
        return path
    if observed_types and mode != "overwrite":
        raise ValueError("types are observed of a whole table: overwrite it, or use versions")
    staged = staged_path(path) if mode == "overwrite" else path
    writer = df.write.mode("errorifexists" if mode == "overwrite" else mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    if note:
        note(staged)
    if mode == "overwrite":
        put_in_place(spark, staged, path)
    return path
