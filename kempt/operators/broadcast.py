"""Size-checked broadcasts.

A side is broadcast only when its size is *proven* under a bound, in rows and
in bytes.  For fixed-width schemas (ids, counts) the row count alone gives the
byte size; otherwise one aggregate measures rows and the exact byte length of
every variable-width value (same cost as a count).  Callers fall back to a
shuffle join above the bound, where AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 16  # hashed-relation bookkeeping per row (key pointer, row header)

_FIXED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType,
          T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _slot_bytes(dt: T.DataType) -> int:
    # UnsafeRow keeps every fixed-width value in an 8-byte slot; decimals wider
    # than 18 digits add 16 bytes in the variable region
    return 8 + (16 if isinstance(dt, T.DecimalType) and dt.precision > 18 else 0)


def fixed_row_bytes(schema: T.StructType) -> int | None:
    """Bytes per row when every column is fixed-width, else None."""
    if not all(isinstance(f.dataType, _FIXED) for f in schema.fields):
        return None
    return sum(_slot_bytes(f.dataType) for f in schema.fields) + ROW_OVERHEAD_BYTES


def measure(df: DataFrame) -> tuple[int, int]:
    """Exact ``(rows, bytes)`` of a DataFrame in one aggregate."""
    width = fixed_row_bytes(df.schema)
    if width is not None:
        rows = df.count()
        return rows, rows * width
    fixed = sum(_slot_bytes(f.dataType) for f in df.schema.fields if isinstance(f.dataType, _FIXED))
    var = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0))
           for f in df.schema.fields if not isinstance(f.dataType, _FIXED)]
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(F.sum(sum(var[1:], var[0])), F.lit(0)).cast("bigint").alias("var_bytes")).first()
    rows = int(row["rows"])
    return rows, rows * (fixed + ROW_OVERHEAD_BYTES + 8 * len(var)) + int(row["var_bytes"])


def fits(rows: int, nbytes: int, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """True when both the row and the byte bound hold."""
    return rows <= max_rows and nbytes <= max_bytes


def size_checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                           max_bytes: int = DEFAULT_MAX_BYTES) -> tuple[DataFrame, int]:
    """Broadcast ``df`` only when its measured size is under both bounds; return (df, rows)."""
    rows, nbytes = measure(df)
    return (F.broadcast(df) if fits(rows, nbytes, max_rows, max_bytes) else df), rows


def bounded_by_rows(df: DataFrame, upper_rows: int, max_rows: int = DEFAULT_MAX_ROWS,
                    max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` using a known upper bound on its rows when its schema is
    fixed-width (no extra job); otherwise measure it exactly."""
    width = fixed_row_bytes(df.schema)
    if width is not None and fits(upper_rows, upper_rows * width, max_rows, max_bytes):
        return F.broadcast(df)
    side, _ = size_checked_broadcast(df, max_rows, max_bytes)
    return side
