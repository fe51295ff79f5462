"""Snapshot sinks: publish a set of tables as a new immutable snapshot, export CSV.

The reference updates tables in place without transactions.  Parquet tables
cannot be updated in place (Spark raises on UPDATE/DELETE/MERGE for them), so
each cleaning stage writes a *new* snapshot directory; the previous one stays
untouched for before/after comparison.  Row counts are observed during the
write itself (``DataFrame.observe``), so reporting them costs no extra scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions import casts
from kempt.model import TableSpec, load_order
from kempt.sources.delimited import CSV_OPTIONS


MANIFEST = "_manifest"


def write_snapshot(tables: Mapping[str, DataFrame], root: str,
                   specs: Mapping[str, TableSpec] | None = None) -> dict[str, int]:
    """Write every table under ``root/<table>`` (parents first) and return row counts.

    ``root`` must be a fresh directory on shared storage; writing is
    ``errorifexists`` so a published snapshot is never overwritten.  Each table
    is committed by Spark's output committer (task retries survive executor
    loss); the snapshot as a whole is published by a manifest of table names and
    observed row counts written *last*, so a run that dies midway leaves no
    readable snapshot -- rerun it into a fresh folder.
    """
    names = [n for n in load_order(specs) if n in tables] if specs else list(tables)
    names += [n for n in tables if n not in names]
    counts: dict[str, int] = {}
    spark = None
    for name in names:
        obs = Observation(f"rows_{name}")
        tables[name].observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists") \
            .parquet(f"{root}/{name}")
        counts[name] = int(obs.get["rows"])
        spark = tables[name].sparkSession
    if spark is not None:
        spark.createDataFrame(list(counts.items()), "table_name string, row_count long") \
            .coalesce(1).write.mode("errorifexists").parquet(f"{root}/{MANIFEST}")
    return counts


def read_snapshot(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Tables of a *complete* snapshot (its manifest exists); all of them when ``names`` is None."""
    try:
        listed = [r["table_name"] for r in spark.read.parquet(f"{root}/{MANIFEST}").collect()]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"{root} has no manifest: the snapshot is incomplete or not a snapshot") from e
    wanted = list(names) if names is not None else listed
    missing = [n for n in wanted if n not in listed]
    if missing:
        raise KeyError(f"tables not in snapshot {root}: {missing}")
    return {n: spark.read.parquet(f"{root}/{n}") for n in wanted}


def normalise_integers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nullable-integer normalisation before export: ``'299.0'``/299.0 -> 299, junk -> NULL.

    Integral columns stay as they are; decimals and doubles are truncated."""
    cols = set(columns)

    def whole(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.IntegralType):
            return F.col(c)
        if isinstance(kind, (T.DecimalType, T.FractionalType)):
            return F.col(c).try_cast("bigint").alias(c)
        return casts.nullable_long(F.col(c)).alias(c)

    return df.select(*[whole(c) if c in cols else F.col(c) for c in df.columns])


def export_csv(df: DataFrame, path: str, key: Sequence[str], integer_columns: Sequence[str] = ()) -> int:
    """Ordered CSV export with a header row; returns the row count observed during the write.

    A global ``orderBy`` is a range-partitioned sort (one shuffle); every
    output part file holds one key range, in order.  Spark writes no BOM.
    """
    out = normalise_integers(df, integer_columns) if integer_columns else df
    opts = {k: v for k, v in CSV_OPTIONS.items() if k in ("header", "sep", "quote", "escape", "encoding",
                                                          "nullValue", "emptyValue")}
    obs = Observation("exported_rows")
    out.orderBy(*key).observe(obs, F.count(F.lit(1)).alias("rows")) \
        .write.mode("errorifexists").options(**opts).csv(path)
    return int(obs.get["rows"])
