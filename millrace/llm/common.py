"""What the operators share: staged tables, whole-text batches for Arrow functions, row hashes."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import new_folder

# A slice handed to an Arrow function holds at most this much text, or a single row.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a frame to the shared folder and read it back; the lineage ends there."""
    path = new_folder(df.sparkSession, f"llm-{name}")
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give back to the system what a fit has freed, where the C library can; a driver lives long."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def apart(carry: tuple[str, ...], *results: str) -> tuple[str, ...]:
    """Carried columns without those named like a result, which takes their place."""
    return tuple(c for c in carry if c not in results)


def remainder(key: str, divisor: int) -> Column:
    """crc32 of a key's decimal text, modulo a divisor."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def slices(batch: pa.RecordBatch, text: int = 0, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has at most ``most`` bytes in its text column, or one row."""
    rows = batch.num_rows
    if not rows:
        return
    column = batch.column(text)
    offsets = np.frombuffer(column.buffers()[1], np.int32, rows + 1, 4 * column.offset) \
        if column.buffers()[1] is not None else np.zeros(rows + 1, np.int32)
    at = 0
    while at < rows:
        end = int(np.searchsorted(offsets, int(offsets[at]) + most, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield batch.slice(at, end - at)
        at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and the rows' bounds in them; null rows are empty."""
    rows = len(column)
    _, places, data = column.buffers()
    if rows == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)
    bounds = np.frombuffer(places, np.int32, rows + 1, 4 * column.offset).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def over_slices(work: Callable[[pa.RecordBatch], pa.RecordBatch], text: int = 0,
                most: int = SLICE_BYTES):
    """A function for mapInArrow that sees batches of bounded text only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, most):
                yield work(part)
    return run
