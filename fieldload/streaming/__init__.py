"""Incremental loading of newly landed project exports (Structured Streaming)."""

from .incremental import import_batch, start

__all__ = ["import_batch", "start"]
