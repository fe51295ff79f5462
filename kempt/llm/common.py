"""Shared helpers: Arrow text buffers, word hashes, deterministic samples, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import os
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.session import parallelism, scratch_path

#: Texts are worked on in slices of about this many bytes, so that a batch of long texts stays small.
SLICE_BYTES = 1 << 20

_held: list[Any] = [None, None]


def free_memory() -> None:
    """Hand memory that is no longer used back to the system, where the allocators offer it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim is not None:
        trim(0)


def task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as the work of one task, after which an idle worker holds little."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
            free_memory()

    return whole


def held(key: Any, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task, one thing at a time.

    A worker serves one operator after the other; a dictionary or table that
    one of them has built is let go when the next one asks for its own.
    """
    if _held[0] != key:
        _held[:] = [None, None]
        free_memory()
        _held[:] = [key, build()]
    return _held[1]


def let_go() -> None:
    """Called by operators that keep nothing."""
    held(("nothing",), lambda: None)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table of the given snapshot folder.

    Spark's default of 10,000 rows to an Arrow batch is made for narrow rows;
    with whole texts it holds tens of MB twice per task, so a session that
    still has the default gets 1,000.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def materialise(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a lineage cut that survives lost executors.

    ``few``, for narrow tables of ids that end in an aggregation: in no more
    than two files a core, however many partitions a shuffle has.  Every file
    costs its executor a writer and, on a file system without Hadoop's native
    library, a process for each of its permissions.
    """
    path = scratch_path(df.sparkSession, name)
    cores = parallelism(df.sparkSession) if few else None
    df = df.coalesce(2 * cores) if cores else df
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_mod(column: str, divisor: int):
    """crc32 of the column's decimal text, modulo ``divisor``; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)


def held_out(column: str, divisor: int, remainder: int):
    """Whether a row belongs to the held-out fold; a NULL id is never held out."""
    return F.coalesce(crc32_mod(column, divisor) == remainder, F.lit(False))


def bounded_sample(ids: DataFrame, key: str, limit: int, seed: str) -> DataFrame:
    """At most ``limit`` rows with the smallest hashes of ``key``: the same sample, whatever the partitioning.

    Rows far beyond the limit are dropped by their hash before the sort, so
    the sort sees little more than ``limit`` rows of any table.
    """
    total = ids.count()
    h = F.xxhash64(F.lit(seed), F.col(key).cast("string"))
    share = min(1.0, 1.3 * limit / max(total, 1))
    near = ids.withColumn("_h", h).where(F.pmod("_h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    return near.orderBy(F.pmod("_h", F.lit(1 << 30)), "_h", key).limit(limit).drop("_h")


def fit_in_task(sample: DataFrame, function: Callable[[pa.Table], Any]) -> Any:
    """``function`` over a bounded sample, run in one task; None where the sample is empty.

    Keeps the sample's texts off the driver: only the fitted model comes back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(function(pa.Table.from_batches(rows)))]})

    row = sample.repartition(1).mapInArrow(task(run), "model binary").first()
    return pickle.loads(bytes(row[0])) if row else None


def text_slices(batch: pa.RecordBatch, text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``limit`` text bytes.

    Yields (first row, end row, UTF-8 bytes, offsets relative to them); NULL
    texts are empty.  A text longer than the limit makes a slice of its own.
    """
    column = batch.column(batch.schema.get_field_index(text))
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset or len(column) == 0:
        column = pa.concat_arrays([column]) if len(column) else pa.array([], pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def _random_table(seed: int, size: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _random_table(11, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; runs end at row boundaries."""
    if len(mask) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(mask))]
    edge = np.zeros(len(mask) + 1, bool)
    edge[1:-1] = mask[1:] != mask[:-1]
    edge[0] = edge[-1] = True
    edge[inner] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = mask[starts]
    return starts[keep], ends[keep]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: one pass over the bytes, whatever the spans."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every row: starts, ends, and each row's first word (n + 1 entries)."""
    starts, ends = runs(~_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)
