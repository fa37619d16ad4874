"""Keep a training set at hand while a model makes many passes over it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Persist for the duration of a block; lost blocks are recomputed from the plan.

    Rows the caller has persisted already are left as they are.
    """
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
