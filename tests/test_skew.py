"""A key holding a third of the rows: the shuffle path of the FK remap must give
the same rows as the broadcast path, and AQE must split the hot partition."""

from pyspark.sql import functions as F

from kempt.operators import checks, dimension

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _child(spark, n=30000):
    # member 1 is hot: a third of all children point at it; member 1 merges into 0
    return spark.range(n).select(F.col("id").alias("child_id"),
                                 F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 997 + 2)
                                 .cast("int").alias("fk"))


def _dim(spark):
    rows = [(0, "Hot"), (1, "Hot,"), (2, ",junk")] + [(i, f"m{i}") for i in range(3, 1000)]
    return spark.createDataFrame(rows, "id int, name string")


def test_hot_key_remap_shuffle_path_matches_broadcast_path(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        ph = {"id": -1, "name": "N/A"}
        wide = dimension.plan_dimension_merge(_dim(spark), "id", "name", placeholder=ph, materialize=False)
        narrow = dimension.plan_dimension_merge(_dim(spark), "id", "name", placeholder=ph, materialize=False,
                                                broadcast_max_rows=0)
        b = wide.remap(_child(spark), "fk")
        s = narrow.remap(_child(spark), "fk")
        agg = lambda df: sorted(tuple(r) for r in df.groupBy("fk").count().collect())
        assert agg(b) == agg(s)
        assert dict(agg(s))[0] == 10000  # the hot member's children all moved to the survivor
        s.write.format("noop").mode("overwrite").save()
        rows = s.collect()
        assert len(rows) == 30000
        plan = s._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_orphan_count_both_paths(spark):
    parent = spark.range(2, 1000).select(F.col("id").cast("int").alias("pk"))
    child = _child(spark)
    got = {checks.orphan_count(child, "fk", parent, "pk", broadcast_max_rows=b).first()["orphan_rows"]
           for b in (2_000_000, 0)}
    assert got == {10000}
