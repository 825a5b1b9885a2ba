"""Scoped caching: persist for the duration of a block, then release."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """`with persisted(df) as cached: ...` — blocks spill to disk rather than
    fail, and are recomputed from lineage if an executor holding them is
    lost.  Released on exit, even on error."""
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()
