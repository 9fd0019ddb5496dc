"""Publish a table to a topic: every row becomes one JSON message.

All tasks write their own partitions; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestream.operators import to_envelope
from lakestream.sources.jdbc import read_jdbc
from lakestream.sources.kafka import write_topic
from lakestream.sources.topics import write_messages


def publish_to_kafka(df: DataFrame, options: dict[str, str], topic: str,
                     key: str | None = None, keep_nulls: bool = False) -> None:
    write_topic(to_envelope(df, keep_nulls=keep_nulls, key=key), options, topic)


def publish_table(spark: SparkSession, jdbc: dict[str, str], kafka: dict[str, str], topic: str,
                  partition_column: str | None = None, partitions: int = 1, key: str | None = None,
                  keep_nulls: bool = False) -> None:
    """The backfill job: a database table, read in ranges of a column, to a topic, a JSON message a row."""
    publish_to_kafka(read_jdbc(spark, jdbc, partition_column, partitions), kafka, topic, key, keep_nulls)


def publish_to_files(df: DataFrame, path: str, key: str | None = None, keep_nulls: bool = False,
                     rows_per_file: int | None = None) -> None:
    write_messages(to_envelope(df, keep_nulls=keep_nulls, key=key), path, rows_per_file)
