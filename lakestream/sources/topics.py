"""A file-backed topic: folders of ``key``/``value`` byte messages.

It has the same envelope as a Kafka topic, so every downstream operator is
identical; streams read it with the file source, where ``maxFilesPerTrigger``
plays the part of ``maxOffsetsPerTrigger``. Spark's file committer makes
each message file appear atomically, which the file source relies on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from lakestream.schemas import MESSAGE_SCHEMA


def _as_bytes(df: DataFrame, name: str):
    if name not in df.columns:
        return F.lit(None).cast("binary").alias(name)
    c = df[name]
    if isinstance(df.schema[name].dataType, BinaryType):
        return c.alias(name)
    return F.encode(c.cast("string"), "UTF-8").alias(name)


def write_messages(df: DataFrame, path: str, rows_per_file: int | None = None,
                   mode: str = "append") -> None:
    """Append ``value`` (and optional ``key``) columns as messages.

    Every task writes its own files; ``rows_per_file`` splits the output into
    more, smaller files (more, smaller micro-batches for a reader).
    """
    writer = df.select(_as_bytes(df, "key"), _as_bytes(df, "value")).write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.parquet(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages currently in the topic folder."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def read_messages_stream(spark: SparkSession, path: str,
                         max_files_per_trigger: int | None = None,
                         max_bytes_per_trigger: str | int | None = None) -> DataFrame:
    """The topic folder as a stream; new files are picked up as they land.

    By default a micro-batch takes all there is. For a first start over a large
    backlog, ``max_bytes_per_trigger`` (such as ``"100g"``) or
    ``max_files_per_trigger`` (see :func:`files_per_batch`) cuts it into several.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.parquet(path)


def files_per_batch(spark: SparkSession, path: str, batches: int) -> int:
    """Files a micro-batch takes if the topic's present files are to make about ``batches`` of them."""
    return max(1, -(-len(read_messages(spark, path).inputFiles()) // batches))
