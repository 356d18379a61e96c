"""Helpers the operators share: Arrow batches in bounded pieces, scratch tables, byte tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path, ship_package

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000                # rows of an Arrow batch, unless the session sets its own number
PIECE_BYTES = 2_000_000          # text handled at once inside a task: bounds the Python worker's memory


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the cluster's checkpoint folder and read back: lineage ends there, and
    a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepared(df: DataFrame) -> DataFrame:
    """Ship the package to the executors once per application (Python operators need it there)."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":          # Spark's default: too many long texts
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)
    return df


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``column`` holds about ``limit`` bytes each (one long text alone)."""
    n = batch.num_rows
    if n == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    cut = np.flatnonzero(np.diff(ends // limit)) + 1
    bounds = [0, *cut.tolist(), n]
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            yield batch.slice(a, b - a)


_large: list[Callable[[], None]] = []


def large(cached):
    """Marks a cached function whose tables are too large to keep when a task has ended."""
    _large.append(cached.cache_clear)
    return cached


def give_back() -> None:
    """Return freed memory to the operating system: a reused Python worker would keep it all."""
    for clear in _large:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def trimmed(fn):
    """Task function that gives memory back when its task ends."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()
    return run


def map_pieces(fn: Callable[[pa.RecordBatch], pa.RecordBatch], column: str):
    """mapInArrow function applying ``fn`` to bounded pieces of every batch."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, column):
                yield fn(piece)
    return trimmed(run)


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts back to back, n + 1 offsets) of a string array; null counts as empty.
    The bytes are a view of Arrow's own buffer."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, kind)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns added, or replaced where a name is already taken."""
    names = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(new.values()),
                                      names=names + list(new))


def add_schema(df: DataFrame, **new) -> "T.StructType":
    """Schema of ``with_columns``: the frame's fields without those replaced, then the new ones."""
    from pyspark.sql import types as T

    kept = [f for f in df.schema.fields if f.name not in new]
    return T.StructType(kept + [T.StructField(k, v) for k, v in new.items()])
