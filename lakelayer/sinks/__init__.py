"""Sinks: versioned path tables with append, overwrite and partition overwrite."""

from lakelayer.sinks.store import BATCH_COL, PathTable, path_exists

__all__ = ["BATCH_COL", "PathTable", "path_exists"]
