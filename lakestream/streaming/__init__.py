"""Structured Streaming: fan-out sinks and the enrichment job."""

from lakestream.streaming.enrichment import (DimensionTooLarge, await_done, batch_means,
                                             broadcast_guard, combine_batch_means,
                                             joined_batch_means, parse_results,
                                             read_history, run_enrichment, run_microbatch_stats,
                                             run_rejected, start, start_console, stop_when_idle)
from lakestream.streaming.fanout import (committed_files_sink, fan_out, jdbc_sink, kafka_sink, message_files_sink,
                                         parquet_history_sink, per_batch, read_committed)
from lakestream.streaming.rescale import adopt_state, state_sums
from lakestream.streaming.running import pinned_versions, running_means, split_messages

__all__ = [
    "DimensionTooLarge", "adopt_state", "await_done", "batch_means", "broadcast_guard", "combine_batch_means", "committed_files_sink",
    "fan_out", "jdbc_sink", "joined_batch_means", "kafka_sink", "message_files_sink",
    "parquet_history_sink", "parse_results", "per_batch", "pinned_versions", "read_committed", "read_history", "run_enrichment",
    "run_microbatch_stats", "run_rejected", "running_means", "split_messages", "start", "start_console", "state_sums", "stop_when_idle",
]
