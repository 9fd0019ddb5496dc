"""Kafka topics: connection options, stream/batch readers and a writer.

The connector (``spark-sql-kafka``) must be on the cluster's classpath; it
is not bundled. Secrets are taken only from the caller's arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


def kafka_options(bootstrap_servers: str | Sequence[str], security_protocol: str | None = None,
                  sasl_mechanism: str | None = None, username: str | None = None,
                  password: str | None = None, **extra) -> dict[str, str]:
    """Connection options (``kafka.``-prefixed) including SASL/PLAIN login."""
    servers = bootstrap_servers if isinstance(bootstrap_servers, str) else ",".join(bootstrap_servers)
    opts = {"kafka.bootstrap.servers": servers}
    if security_protocol:
        opts["kafka.security.protocol"] = security_protocol
    if sasl_mechanism:
        opts["kafka.sasl.mechanism"] = sasl_mechanism
    if username is not None:
        # Fixed format: the login line of Kafka's client, text in quotes.
        opts["kafka.sasl.jaas.config"] = (
            f'{PLAIN_LOGIN} required username="{_quoted(username)}" password="{_quoted(password or "")}";')
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"')


def read_topic_stream(spark: SparkSession, options: dict[str, str], topic: str,
                      starting_offsets: str = "earliest",
                      max_offsets_per_trigger: int | None = None,
                      min_partitions: int | None = None) -> DataFrame:
    """A topic as a stream of ``key``/``value`` bytes (plus offsets metadata).

    ``startingOffsets`` applies only on the first start; afterwards the
    checkpoint decides. ``max_offsets_per_trigger`` caps each micro-batch for
    the caller who wants that; by default a batch takes what there is.
    ``min_partitions`` splits the offsets of large topic partitions over more
    tasks, so a topic partition holding a large share of the messages is not
    read by one task.
    """
    reader = (spark.readStream.format("kafka").options(**options)
              .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def read_topic(spark: SparkSession, options: dict[str, str], topic: str,
               starting_offsets: str = "earliest", ending_offsets: str = "latest",
               min_partitions: int | None = None) -> DataFrame:
    """A topic's current contents as a batch DataFrame (``min_partitions`` as above)."""
    reader = (spark.read.format("kafka").options(**options).option("subscribe", topic)
              .option("startingOffsets", starting_offsets).option("endingOffsets", ending_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def write_topic(df: DataFrame, options: dict[str, str], topic: str) -> None:
    """Write ``value`` (and optional ``key``) columns as messages, from every task."""
    df.write.format("kafka").options(**options).option("topic", topic).save()
