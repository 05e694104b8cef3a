"""Incremental runs over a landing folder with Structured Streaming."""

from corpusprep.streaming.incremental import classify_new_files

__all__ = ["classify_new_files"]
