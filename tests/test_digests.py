"""Block diffs against row diffs; blocks that are alike are not read."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from kempt.operators import digests
from kempt.operators.report import diff_snapshots, diff_summary


def stored(spark, scratch, before, after, key, depth=2):
    for name, df in (("before", before), ("after", after)):
        digests.write_digested(df, f"{scratch}/{name}", key, depth)
    return digests.compare_digested(spark, f"{scratch}/before", f"{scratch}/after", key)


def rows(df):
    return sorted(map(str, df.collect()))


def table(spark, seed, n=300):
    rng = random.Random(seed)
    return [(i if i % 50 else None, rng.choice(["a", "b", None, ""]), rng.choice([1.5, None, -0.0])) for i in range(n)]


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_equals_row_diff(spark, scratch, depth):
    schema = "id long, t string, v double"
    before = [r for r in table(spark, 1) if r[0] is not None] + [(None, "null key", 0.0)]
    after = [r for r in before if r[0] != 7]
    after[10] = (after[10][0], "changed", None)
    after.append((999, "added", 1.0))
    b, a = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema).repartition(5)
    found = stored(spark, scratch, b, a, ["id"], depth)
    full = diff_snapshots(b, a, ["id"])
    assert rows(found.changes) == rows(full.where("change <> 'same'"))
    assert sorted(map(tuple, found.summary().collect())) == sorted(map(tuple, diff_summary(full).collect()))
    assert len(found.unlike) <= 3 and (depth == 0 or found.rows_in_equal > 0)


def test_equal_blocks_are_not_read(spark, scratch):
    b = spark.range(2000).select(F.col("id"), (F.col("id") * 3).alias("v"))
    a = b.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    for name, df in (("before", b), ("after", a)):
        digests.write_digested(df, f"{scratch}/{name}", ["id"])
    bucket = spark.range(77, 78).select(digests.bucket_of(["id"], 2)).first()[0]
    for path in glob.glob(f"{scratch}/*/rows/_bucket=*/*.parquet"):
        if f"_bucket={bucket}/" not in path:
            with open(path, "wb") as f:  # unreadable from now on
                f.write(b"no parquet")
    found = digests.compare_digested(spark, f"{scratch}/before", f"{scratch}/after", ["id"])
    assert found.unlike == (bucket,) and [tuple(r) for r in found.changes.collect()] == [(77, "changed", "v")]
    assert found.nodes_compared == 1 + 16 + 16
    assert dict(map(tuple, found.summary().collect())) == {"same": 1999, "changed": 1}


def test_equal_tables_end_at_the_root(spark, scratch):
    df = spark.range(500).select("id", F.lit("x").alias("t"))
    found = stored(spark, scratch, df, df.select("t", "id").orderBy(F.desc("id")), ["id"])
    assert found.unlike == () and found.nodes_compared == 1 and found.changes.count() == 0 and found.rows_in_equal == 500


def test_drift_empty_sides_and_repeated_rows(spark, scratch):
    b = spark.createDataFrame([(1, "x", None), (2, "y", "old")], "id long, t string, legacy string")
    a = spark.createDataFrame([(1, "x", None), (2, "y", "new")], "id int, t string, tag string")
    assert rows(stored(spark, f"{scratch}/1", b, a, ["id"]).changes) == rows(diff_snapshots(b, a, ["id"]).where("change <> 'same'"))
    empty = b.limit(0)
    assert {r.change for r in stored(spark, f"{scratch}/2", b, empty, ["id"]).changes.collect()} == {"removed"}
    assert {r.change for r in stored(spark, f"{scratch}/3", empty, b, ["id"]).changes.collect()} == {"added"}
    twice = b.unionByName(b)
    assert stored(spark, f"{scratch}/4", b, twice, ["id"]).unlike != ()  # counted, not cancelled out


def test_digest_of_any_order_and_column_order(spark):
    df = spark.range(400).select("id", (F.col("id") % 7).alias("v"))
    one = digests.bucket_digests(df, ["id"], 1)
    two = digests.bucket_digests(df.repartition(7).select("v", "id"), ["id"], 1)
    assert rows(one) == rows(two.select(one.columns))
