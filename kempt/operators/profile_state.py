"""Profiles that grow with appended data: exact counters and sketches that merge.

A ``profile_state`` is one row per column: rows, NULLs, blanks, minimum and
maximum, kept exactly, and two sketches of a fixed size, HyperLogLog for distinct
values and KLL for quantiles.  States of two parts of a table merge into the
state of both, in any order, so a table that only grows is profiled by reading
each part once, when it arrives.

``ProfiledTable`` keeps a table in parts with the state of each part beside it.
``append`` writes a part, reads that part alone and stores its state;
``profile`` merges the stored states and reads no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sketch sizes: 2^LG_K counters of HyperLogLog (about 1.04 / sqrt(2^LG_K) standard error), KLL of K (about 1.3 % rank error).
LG_K = 12
KLL_K = 200

STATE_SCHEMA = ("column_name string, n_rows long, n_null long, n_blank long, min_long long, max_long long, min_double double, "
                "max_double double, min_text string, max_text string, distinct_sketch binary, quantile_sketch binary")


def _whole(c: str, dt: T.DataType) -> Column | None:
    """The value as a long where that is exact: whole numbers, dates as days, timestamps as microseconds."""
    if isinstance(dt, (T.IntegralType, T.BooleanType)):
        return F.col(c).cast("long")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(F.col(c).cast("string")))
    return None


def _column_state(c: str, dt: T.DataType) -> Column:
    value, whole = F.col(c), _whole(c, dt)
    none = {t: F.lit(None).cast(t) for t in ("long", "double", "string", "binary")}
    text = isinstance(dt, T.StringType)
    number = value.cast("double") if whole is None and isinstance(dt, (T.FractionalType, T.DecimalType)) else None
    sketched = whole if whole is not None else value if text else value.cast("string")
    ranked = whole.cast("double") if whole is not None else number
    return F.struct(
        F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(value.isNull()).alias("n_null"),
        (F.count_if(F.coalesce(F.trim(value) == "", F.lit(False))) if text else F.lit(0).cast("long")).alias("n_blank"),
        (F.min(whole) if whole is not None else none["long"]).alias("min_long"),
        (F.max(whole) if whole is not None else none["long"]).alias("max_long"),
        (F.min(number) if number is not None else none["double"]).alias("min_double"),
        (F.max(number) if number is not None else none["double"]).alias("max_double"),
        (F.min(value) if text else none["string"]).alias("min_text"), (F.max(value) if text else none["string"]).alias("max_text"),
        F.hll_sketch_agg(sketched, LG_K).alias("distinct_sketch"),
        (F.kll_sketch_agg_double(ranked, KLL_K) if ranked is not None else none["binary"]).alias("quantile_sketch"))


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One state row per column, from one pass; an empty table has counters of 0 and empty sketches."""
    chosen = list(columns) if columns is not None else df.columns
    wide = df.agg(*[_column_state(c, df.schema[c].dataType).alias(f"_{i}") for i, c in enumerate(chosen)])
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(chosen))])))


def merge_states(states: DataFrame) -> DataFrame:
    """The state of all parts together: one row per column, whatever the order of the parts."""
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_blank")]
    ends = [f(c).alias(c) for t in ("long", "double", "text") for f, c in ((F.min, f"min_{t}"), (F.max, f"max_{t}"))]
    return states.groupBy("column_name").agg(*sums, *ends, F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
                                             F.kll_merge_agg_double("quantile_sketch", KLL_K).alias("quantile_sketch"))


def counters(state: DataFrame) -> DataFrame:
    """The exact part of a state, one row per column; minimum and maximum as text."""
    low, high = (F.coalesce(F.col(f"{m}_long").cast("string"), F.col(f"{m}_double").cast("string"), F.col(f"{m}_text")) for m in ("min", "max"))
    return state.select("column_name", "n_rows", "n_null", "n_blank", low.alias("min_value"), high.alias("max_value"))


def estimates(state: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What the sketches say: distinct values, and the given quantiles of columns that have an order in numbers."""
    known = F.coalesce(F.col("min_long").cast("double"), F.col("min_double")).isNotNull()  # a sketch of no values has no quantiles
    quantiles = [F.when(known, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(r))).alias(f"q{round(r * 100):02d}") for r in ranks]
    return state.select("column_name", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), *quantiles)


@dataclass(frozen=True)
class ProfiledTable:
    """A table in parts under ``root`` (shared storage), each with its state."""

    spark: SparkSession
    root: str

    def _states(self) -> DataFrame:
        return self.spark.read.schema(STATE_SCHEMA + ", part string").parquet(f"{self.root}/states")

    def append(self, df: DataFrame, part: str) -> None:
        """Store a part and its state.  The state is written last and publishes the part; rows are read once, from the part."""
        path = f"{self.root}/rows/part={part}"
        df.write.mode("errorifexists").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        profile_state(stored).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/states/part={part}")

    def parts(self) -> list[str]:
        """Published parts."""
        return sorted(r[0] for r in self._states().select("part").distinct().collect())

    def rows(self) -> DataFrame:
        """Rows of all published parts."""
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                      [self.spark.read.parquet(f"{self.root}/rows/part={p}") for p in self.parts()])

    def profile(self) -> DataFrame:
        """The merged state of all published parts, from their states alone."""
        return merge_states(self._states().drop("part"))
