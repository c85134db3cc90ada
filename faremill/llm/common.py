"""Helpers the text operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faremill.session import fresh_path

# Rows handed to Python at a time are cut so that a batch holds about this many characters.
BATCH_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fewer_tasks(df: DataFrame) -> DataFrame:
    """A shuffled result in two tasks per core at most. Many shuffle partitions keep skew and memory apart; written out one by one
    they would only make many small files (and the local file system starts a process for each file's permissions)."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


class Written:
    """A table written once below the shared folder; `drop` removes it when nothing reads it any more.

    With `shuffled` the last step is behind a shuffle and is written in a few tasks per core; what comes straight from a scan keeps the
    scan's tasks, so that a lost one costs little.
    """

    def __init__(self, df: DataFrame, name: str, shuffled: bool = False):
        self.spark = df.sparkSession
        df = fewer_tasks(df) if shuffled else df
        self.path = fresh_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def bytes(self) -> int:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def side(small: Written, limit: int = 16 << 20) -> DataFrame:
    """A written join side: broadcast only while its files are below `limit` bytes, else left to a shuffle join."""
    return F.broadcast(small.df) if small.bytes() <= limit else small.df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names no column of df has, so that extra input columns never clash with working ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id's decimal text, modulo 3, is 1. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def text_batches(texts: list, limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together stay near `limit` characters; a longer text is a range of its own."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text) if text is not None else 0
        if size >= limit:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


_CACHES: dict = {}
_LAST: list = [None]


def keep_cache(name: str, clear) -> None:
    """Name a worker's cache and how to empty it."""
    _CACHES[name] = clear


def hand_back() -> None:
    """Give memory that is held but not used back to the system: a worker is used again by later stages and would keep its high-water mark."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        # not every C library can
        pass


def enter(name: str) -> None:
    """A task of operator `name` begins in this worker: what other operators remembered is forgotten, and their memory goes back."""
    if _LAST[0] != name:
        for other, clear in _CACHES.items():
            if other != name:
                clear()
        hand_back()
        _LAST[0] = name


def sized(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes together stay within `limit`; a larger row is a range of its own."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def arrow_parts(batch: pa.RecordBatch, column: str, limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts together stay near `limit` bytes; no text is turned into a Python string for it."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for start, stop in sized(sizes, limit):
        yield batch.slice(start, stop - start)
