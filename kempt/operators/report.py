"""Validation reports: row counts, expectations with documented exceptions,
before/after snapshot comparison, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.operators.checks import row_count

PASS, FAIL, EXCEPTION = "PASS", "FAIL", "DOCUMENTED_EXCEPTION"

EXPECTATION_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("expected", T.LongType(), False),
    T.StructField("note", T.StringType(), True),
])


def row_count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for every table, one count job per table, unioned and sorted."""
    parts = [df.agg(row_count().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def expectations(spark, rows: Sequence[tuple[str, int, str | None]]) -> DataFrame:
    """Expected values as a (small, user-authored) DataFrame."""
    return spark.createDataFrame(list(rows), EXPECTATION_SCHEMA)


def validate(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare ``(check_name, actual)`` with ``(check_name, expected, note)``.

    A check whose expected value is non-zero and carries a note is a documented
    exception: it passes as ``DOCUMENTED_EXCEPTION`` when the actual value
    equals it.  Checks without an expectation, or expectations without a
    check, fail (the report never hides a missing check).
    """
    j = actual.select("check_name", F.col("actual").cast("bigint").alias("actual")).join(
        expected, "check_name", "full_outer")
    ok = F.coalesce(F.col("actual") == F.col("expected"), F.lit(False))
    status = (F.when(ok & F.col("note").isNotNull() & (F.col("expected") != 0), F.lit(EXCEPTION))
              .when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)))
    return j.select("check_name", "actual", "expected", status.alias("status"), "note")


def assert_valid(report: DataFrame) -> None:
    """Fail loudly (raise) when any check failed; all failing rows are named (at most one per declared check)."""
    failed = report.where(F.col("status") == FAIL).orderBy("check_name").collect()
    if failed:
        raise AssertionError("validation failed: " + "; ".join(
            f"{r['check_name']} actual={r['actual']} expected={r['expected']}" for r in failed))


def diff_snapshots(before: DataFrame, after: DataFrame, key: Sequence[str], *, null_keys: bool = True) -> DataFrame:
    """Row-level comparison of two snapshots of one table on its primary key.

    Output: key columns, ``change`` in {added, removed, changed, same} and the
    names of the changed columns.  Both sides are shuffled once on the key (a
    single full outer join); keys and values are compared exactly, NULL-safe.
    A column that only one side has is NULL on the other, so an added or
    dropped column shows as changed wherever it holds a value.  With
    ``null_keys=False`` keys are compared by plain equality, which lets two
    sides bucketed by the key meet without a shuffle; a NULL key then matches
    nothing and shows as removed and added.
    """
    value_cols = [c for c in dict.fromkeys([*before.columns, *after.columns]) if c not in key]

    def side(df: DataFrame, p: str) -> DataFrame:
        values = [(F.col(c) if c in df.columns else F.lit(None)).alias(f"{p}v_{c}") for c in value_cols]
        return df.select(*[F.col(c).alias(f"{p}k_{c}") for c in key], *values, F.lit(True).alias(f"{p}in"))

    on = [F.col(f"_bk_{c}").eqNullSafe(F.col(f"_ak_{c}")) if null_keys else F.col(f"_bk_{c}") == F.col(f"_ak_{c}") for c in key]
    j = side(before, "_b").join(side(after, "_a"), on, "full_outer").withColumnsRenamed({"_bin": "_in_b", "_ain": "_in_a"})
    j = j.select("*", *[F.coalesce(F.col(f"_bk_{c}"), F.col(f"_ak_{c}")).alias(c) for c in key])
    diffs = [F.when(~F.col(f"_bv_{c}").eqNullSafe(F.col(f"_av_{c}")), F.lit(c)) for c in value_cols]
    changed = F.array_compact(F.array(*diffs)) if diffs else F.array().cast("array<string>")
    change = (F.when(F.col("_in_b").isNull(), F.lit("added"))
              .when(F.col("_in_a").isNull(), F.lit("removed"))
              .when(F.size(changed) > 0, F.lit("changed"))
              .otherwise(F.lit("same")))
    return j.select(*key, change.alias("change"),
                    F.when(F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull(),
                           F.array_join(changed, ",")).alias("changed_columns"))


def diff_summary(diff: DataFrame) -> DataFrame:
    """Rows per change class of a ``diff_snapshots`` result."""
    return diff.groupBy("change").agg(row_count().alias("n_rows"))


def sample_first(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """``TOP n ... ORDER BY key`` (a top-k, planned as TakeOrderedAndProject)."""
    return df.orderBy(*key).limit(n)
