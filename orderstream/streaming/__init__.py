"""Structured Streaming: start/run helpers, batch jobs, incremental views."""

from .jobs import OrderBatchJob
from .runner import materialize, observe_intake, run, start, start_files

__all__ = ["OrderBatchJob", "materialize", "observe_intake", "run", "start", "start_files"]
