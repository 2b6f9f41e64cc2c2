"""Structured Streaming path: micro-batches of messages -> one fleet-metrics row each."""

from dockyard.streaming.metrics_stream import metrics_batch_writer, run_metrics_stream

__all__ = ["metrics_batch_writer", "run_metrics_stream"]
