"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Word separators of every contract here: space and TAB..CR.  Java and RE2 syntax.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores appended until no column of ``df`` has that
    name (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared scratch folder."""
    return f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared scratch folder and read
    back: lineage is cut, an executor lost later costs nothing upstream."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id, text):
    """64-bit key of a row, equal for rows that repeat each other."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), doc_id.isNull(), F.coalesce(text, F.lit("")))


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished jobs whose frames are
    no longer referred to, between two phases that shuffle much.  The cleaner
    works in the background, hence the second round."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; when a task ends, the memory it freed goes
    back to the system, as the worker waits on beside others."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return tidied


def rows_of(b: pa.RecordBatch, n: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``n`` rows."""
    for at in range(0, b.num_rows, n):
        yield b.slice(at, n)
