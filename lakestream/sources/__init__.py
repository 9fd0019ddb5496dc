"""Sources and sinks: files, lake layers, JDBC, Kafka and file-backed topics."""

from lakestream.sources.files import (BRONZE, GOLD, SILVER, layer_path, read_csv, read_layer,
                                      write_csv, write_layer)
from lakestream.sources.jdbc import jdbc_options, key_bounds, partitioned, read_jdbc, write_jdbc
from lakestream.sources.kafka import (kafka_options, read_topic, read_topic_stream, write_topic)
from lakestream.sources.topics import files_per_batch, read_messages, read_messages_stream, write_messages

__all__ = [
    "BRONZE", "GOLD", "SILVER", "files_per_batch", "jdbc_options", "kafka_options", "key_bounds", "layer_path",
    "partitioned", "read_csv", "read_jdbc", "read_layer", "read_messages", "read_messages_stream",
    "read_topic", "read_topic_stream", "write_csv", "write_jdbc", "write_layer", "write_messages",
    "write_topic",
]
