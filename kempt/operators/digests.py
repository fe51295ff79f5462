"""Snapshot comparison by block digests: only unlike buckets are read.

``write_digested`` stores a table partitioned by a bucket of its key, with an
order-independent digest of every bucket beside it: the row count, and an
exclusive or and two sums of 64-bit row hashes, which add up in any order.  The
digests of 16 buckets add up to that of a node above, and so on to the root.

``compare_digested`` compares two such tables from the root down and goes into
unlike nodes only.  Equal roots end the comparison after one row; otherwise the
unlike buckets, and no others, are read (a partition filter) and compared row
by row.  Work follows the number of changed buckets, not the table.

A row hash takes the values that are not NULL, each with its column's name: a
column that one side lacks counts as NULL, and column order does not matter.
Two different buckets pass as equal only if 192 bits of hashes and the count
agree.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kempt.operators.report import diff_snapshots

BUCKET = "_bucket"
FAN_BITS = 4
_DIGEST = ("n_rows", "h_xor", "h_high", "h_low")
_NODES = "node int, n_rows long, h_xor long, h_high long, h_low long, level int"
_ABOUT = "schema string, key array<string>, depth int"


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row's named values; NULL values count as absent."""
    parts = [F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c))).otherwise(F.lit(0).cast("bigint")) for c in sorted(columns)]
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseXOR(p)
    return out


def bucket_of(key: Sequence[str], depth: int) -> Column:
    """Bucket of a key (0 to 16^depth - 1), the same for all integer widths; NULLs have a bucket too."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(1 << (FAN_BITS * depth))).cast("int")


def bucket_digests(df: DataFrame, key: Sequence[str], depth: int) -> DataFrame:
    """``(_bucket, n_rows, h_xor, h_high, h_low)``; rows in any order and partitioning give the same."""
    columns = [c for c in df.columns if c != BUCKET]
    bucket = F.col(BUCKET) if BUCKET in df.columns else bucket_of(key, depth)
    hashed = df.select(bucket.alias(BUCKET), row_hash(columns).alias("_h"))
    mixed = F.xxhash64(F.col("_h"), F.lit(2))
    return hashed.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor(F.xxhash64(F.col("_h"), F.lit(1))).alias("h_xor"),
        F.sum(F.shiftrightunsigned(mixed, 32)).alias("h_high"), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))).alias("h_low"))


def digest_tree(digests: DataFrame, depth: int) -> DataFrame:
    """``(level, node, ...)``: level ``depth`` holds the buckets, level 0 the root, all from one pass over the bucket digests."""
    levels = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(F.col(BUCKET), FAN_BITS * (depth - level)).alias("node"))
                                 for level in range(depth + 1)]))
    return (digests.select(levels.alias("at"), *_DIGEST).groupBy("at.level", "at.node")
            .agg(F.sum("n_rows").alias("n_rows"), F.bit_xor("h_xor").alias("h_xor"), F.sum("h_high").alias("h_high"), F.sum("h_low").alias("h_low")))


def write_digested(df: DataFrame, root: str, key: Sequence[str], depth: int = 2) -> None:
    """Store ``df`` under ``root`` by key bucket, with the digest tree; the description is written last and publishes it."""
    bucketed = df.withColumn(BUCKET, bucket_of(key, depth))
    bucketed.hint("rebalance", BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{root}/rows")
    stored = df.sparkSession.read.schema(bucketed.schema).parquet(f"{root}/rows")
    tree = digest_tree(bucket_digests(stored, key, depth), depth)
    tree.coalesce(1).write.mode("errorifexists").partitionBy("level").parquet(f"{root}/digests")
    df.sparkSession.createDataFrame([(bucketed.schema.json(), list(key), depth)], _ABOUT).coalesce(1) \
        .write.mode("errorifexists").parquet(f"{root}/about")


@dataclass(frozen=True)
class BlockDiff:
    """What two stored tables differ in."""

    changes: DataFrame       # key, change (added, removed, changed), changed_columns
    unlike: tuple[int, ...]  # the buckets that were read
    nodes_compared: int
    rows_in_equal: int       # rows of the buckets that were not read; all of them are the same

    def summary(self) -> DataFrame:
        """``(change, n_rows)`` of all rows, ``same`` included."""
        spark = self.changes.sparkSession
        read = self._diff.groupBy("change").agg(F.count(F.lit(1)).alias("n_rows"))
        equal = spark.createDataFrame([("same", self.rows_in_equal)], "change string, n_rows long").where("n_rows > 0")
        return read.unionByName(equal).groupBy("change").agg(F.sum("n_rows").alias("n_rows"))

    _diff: DataFrame = None  # all rows of the unlike buckets


def _unlike_nodes(spark: SparkSession, before: str, after: str, level: int, parents: Sequence[int] | None):
    def side(root: str, p: str) -> DataFrame:
        nodes = spark.read.schema(_NODES).parquet(f"{root}/digests").where(F.col("level") == level)
        if parents is not None:
            nodes = nodes.where(F.shiftright("node", FAN_BITS).isin(list(parents)))
        return nodes.select("node", *[F.col(c).alias(p + c) for c in _DIGEST])

    met = side(before, "b_").join(side(after, "a_"), "node", "full_outer")
    like = F.lit(True)
    for c in _DIGEST:
        like = like & F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}"))
    return met.select("node", like.alias("like"), F.col("b_n_rows").alias("n")).collect()  # at most 16 a parent


def compare_digested(spark: SparkSession, before: str, after: str, key: Sequence[str]) -> BlockDiff:
    """The differences of two tables stored by ``write_digested`` with the same key and depth.

    The driver holds node numbers only: those of one level, 16 for each unlike
    node above, so never more than there are buckets.  Types of a column that
    both sides have should agree; a column whose type differs makes its rows
    unlike, which are then compared by value.
    """
    about = [spark.read.schema(_ABOUT).parquet(f"{r}/about").first() for r in (before, after)]
    depth = about[0]["depth"]
    if any(a["depth"] != depth or list(a["key"]) != list(key) for a in about):
        raise ValueError(f"stored by other keys or depths: {[(a['key'], a['depth']) for a in about]}")
    parents, compared, equal = None, 0, 0
    for level in range(depth + 1):
        nodes = _unlike_nodes(spark, before, after, level, parents)
        compared += len(nodes)
        equal += sum(r["n"] for r in nodes if r["like"])
        parents = sorted(r["node"] for r in nodes if not r["like"])
        if not parents:
            break
    unlike = tuple(parents or ())
    # the stored schema spares looking into a file of any bucket
    sides = [spark.read.schema(StructType.fromJson(json.loads(a["schema"]))).parquet(f"{r}/rows")
             .where(F.col(BUCKET).isin(list(unlike))).drop(BUCKET) for r, a in zip((before, after), about)]
    diff = diff_snapshots(*sides, key)
    return BlockDiff(diff.where("change <> 'same'"), unlike, compared, equal, diff)
