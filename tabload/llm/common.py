"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# What counts as a word in sizes and shingles: a run of anything but these ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"

BROADCAST_ROWS = 100_000

BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded(table: DataFrame, rows: int) -> DataFrame:
    """A table the driver made of so many short rows, to be joined: broadcast up to ``BROADCAST_ROWS``, shuffled beyond.

    The rows of the result are the same either way.
    """
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices of a batch whose sizes add up to about ``most``; one long item is a slice of its own."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > most:
            yield slice(start, at)
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` for all i, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.empty(0, dtype=np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


class Numbered(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: object) -> int:
        self[key] = place = len(self)
        return place


def small_batches() -> None:
    """Let Spark hand Python batches of ``BATCH_BYTES`` instead of 10,000 rows of any size; a lower setting of the session's own stays.

    Executor and worker hold each batch several times over, so its size decides how much memory a step takes beside the heap.
    """
    spark = SparkSession.active()
    if int(spark.conf.get(BATCH_BYTES_KEY).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))


def give_back() -> None:
    """Return what this process has freed to the system; the C library and Arrow would keep it for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(step: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A Python step over an iterator of batches that gives back memory when its task ends.

    Spark reuses workers and keeps idle ones of each kind of step beside those at work, so what they hold adds up in an executor.
    """
    @functools.wraps(step)
    def tidied(*args: Iterator) -> Iterator:
        try:
            yield from step(*args)
        finally:
            give_back()

    return tidied
