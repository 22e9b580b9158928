"""Structured Streaming form of the incremental slice."""

from tidemark.streaming.incremental import merge_new_files, run_available_now

__all__ = ["merge_new_files", "run_available_now"]
