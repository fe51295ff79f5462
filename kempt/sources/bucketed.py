"""Snapshots bucketed by key: joins on the key need no shuffle.

``write_bucketed`` stores tables bucketed and sorted by their join key, in one
number of buckets.  Checks and updates that join two of them on that key --
orphans, remaps, snapshot diffs -- then read bucket by bucket, and Spark plans
them without an Exchange.

A bucket is one task, which adaptive execution cannot split.  So keys that hold
more than ``hot_share`` buckets' worth of rows are found first and stored
beside, unbucketed; there are at most ``buckets / hot_share`` of them.  Joins
take those rows past a broadcast of the other side's rows of these keys alone.
Where those are more than the checked bound (the other side repeats them too)
they are shuffled like any rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.operators.broadcast import size_checked_broadcast
from kempt.operators.report import diff_snapshots

MANIFEST = "_bucketed"


@dataclass(frozen=True)
class BucketedTable:
    """A stored table: its bucketed rows, and the rows of hot keys."""

    name: str
    key: str
    buckets: int
    cold: DataFrame
    hot: DataFrame
    hot_keys: tuple

    def rows(self) -> DataFrame:
        """All rows."""
        return self.cold.unionByName(self.hot) if self.hot_keys else self.cold

    def _split(self, keys: Sequence) -> tuple[DataFrame, DataFrame]:
        """Rows of the given keys, and all others: the others keep their buckets if the keys are not their own hot ones."""
        chosen = F.col(self.key).isin(list(keys))
        inside = self.rows().where(chosen)
        return inside, self.cold.where(~F.coalesce(chosen, F.lit(False)))

    def join(self, other: "BucketedTable", how: str = "inner") -> DataFrame:
        """Join on both keys (inner, left, left_semi, left_anti): bucket by bucket, hot keys by broadcast.

        Keys match by equality, so NULL keys match nothing.  Columns of both
        sides stay under their names; give them different ones.
        """
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"unsupported join: {how}")
        if self.buckets != other.buckets:
            raise ValueError(f"{self.name} has {self.buckets} buckets, {other.name} {other.buckets}")
        hot = sorted({*self.hot_keys, *other.hot_keys})
        on = lambda a, b: F.col(self.key) == F.col(other.key)
        if not hot:
            return self.cold.join(other.cold, on(self, other), how)
        mine, rest = self._split(hot)
        theirs, other_rest = other._split(hot)
        small, _ = size_checked_broadcast(theirs)
        return rest.join(other_rest, on(self, other), how).unionByName(mine.join(small, on(self, other), how))


def hot_keys(df: DataFrame, key: str, buckets: int, hot_share: float = 0.5) -> list:
    """Keys with more rows than ``hot_share`` buckets should hold: fewer than buckets / hot_share.

    One aggregate, partial before the shuffle; NULL is no join key and is never hot.
    """
    counts = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    floor = max(hot_share * total / buckets, 1)
    return sorted(r["k"] for r in counts.where((F.col("n") > floor) & F.col("k").isNotNull()).select("k").collect())


def _table(root: str, name: str) -> str:
    return f"kempt_{hashlib.sha256(root.encode()).hexdigest()[:16]}_{name}"


def write_bucketed(tables: Mapping[str, tuple[DataFrame, str]], root: str, buckets: int, hot_share: float = 0.5) -> dict[str, BucketedTable]:
    """Store each ``(table, key)`` under ``root``, bucketed and sorted by its key; the manifest is written last.

    Rows are dealt to as many tasks as buckets, by the bucketing's own hash, so
    every bucket is one file.
    """
    spark, entries = None, []
    for name, (df, key) in tables.items():
        spark = df.sparkSession
        hot = hot_keys(df, key, buckets, hot_share)
        chosen = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
        (df.where(~chosen).repartition(buckets, key).write.mode("errorifexists").format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", f"{root}/{name}").saveAsTable(_table(root, name)))
        df.where(chosen).write.mode("errorifexists").parquet(f"{root}/{name}__hot")
        entries.append((name, key, buckets, df.schema.json(), json.dumps(hot)))
    if spark is None:
        raise ValueError("no tables")
    spark.createDataFrame(entries, "name string, key string, buckets int, schema string, hot string").coalesce(1) \
        .write.mode("errorifexists").parquet(f"{root}/{MANIFEST}")
    return open_bucketed(spark, root)


def open_bucketed(spark: SparkSession, root: str) -> dict[str, BucketedTable]:
    """The tables of a stored snapshot; a session that does not know them yet is told of their buckets."""
    from pyspark.sql.types import StructType

    out = {}
    for r in spark.read.parquet(f"{root}/{MANIFEST}").collect():
        table, schema = _table(root, r["name"]), StructType.fromJson(json.loads(r["schema"]))
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            location = f"{root}/{r['name']}".replace("'", "\\'")
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{r['key']}`) SORTED BY (`{r['key']}`) "
                      f"INTO {r['buckets']} BUCKETS LOCATION '{location}'")
        hot = spark.read.schema(schema).parquet(f"{root}/{r['name']}__hot")
        out[r["name"]] = BucketedTable(r["name"], r["key"], r["buckets"], spark.table(table), hot, tuple(json.loads(r["hot"])))
    return out


def remap(child: BucketedTable, moves: BucketedTable, target: str) -> DataFrame:
    """``child`` with its key moved to ``target`` where ``moves`` lists it (once a key); other keys stay."""
    joined = child.join(BucketedTable(moves.name, moves.key, moves.buckets, moves.cold.select(moves.key, target),
                                      moves.hot.select(moves.key, target), moves.hot_keys), "left")
    new = F.when(F.col(moves.key).isNotNull(), F.col(target)).otherwise(F.col(child.key)).cast(child.cold.schema[child.key].dataType)
    return joined.select(*[new.alias(c) if c == child.key else F.col(c) for c in child.cold.columns])


def diff(before: BucketedTable, after: BucketedTable) -> DataFrame:
    """``diff_snapshots`` on the bucket key (no NULLs in it), bucket by bucket."""
    return diff_snapshots(before.rows(), after.rows(), [before.key], null_keys=False)
