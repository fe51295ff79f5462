"""Bucketed snapshots: the plain joins' rows, without a shuffle, also with a hot key."""

import pytest
from pyspark.sql import functions as F

from kempt.operators.dimension import remap_foreign_key
from kempt.operators.report import diff_snapshots
from kempt.sources import bucketed


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture()
def star(spark):
    child = spark.range(3000).select(F.col("id").alias("c"), F.when(F.col("id") % 101 == 0, None).otherwise((F.col("id") * 7) % 400).alias("fk"))
    parent = spark.range(380).select(F.col("id").alias("pk"), F.concat(F.lit("n"), "id").alias("nm"))
    moves = spark.range(0, 400, 3).select(F.col("id").alias("source_id"), (F.col("id") + 1).alias("target_id"))
    return child, parent, moves


def test_no_exchange_above_the_broadcast_bound(spark, scratch, star, no_broadcast):
    child, parent, moves = star
    after = parent.where("pk <> 5").withColumn("nm", F.when(F.col("pk") == 9, "other").otherwise(F.col("nm")))
    t = bucketed.write_bucketed({"child": (child, "fk"), "parent": (parent, "pk"), "moves": (moves, "source_id"), "after": (after, "pk")}, scratch, 4)
    assert all(x.hot_keys == () for x in t.values())
    checks = {"orphans": (t["child"].join(t["parent"], "left_anti"), child.join(parent, child.fk == parent.pk, "left_anti")),
              "remap": (bucketed.remap(t["child"], t["moves"], "target_id"), remap_foreign_key(child, "fk", moves)),
              "diff": (bucketed.diff(t["parent"], t["after"]), diff_snapshots(parent, after, ["pk"]))}
    for name, (ours, plain) in checks.items():
        assert rows(ours) == rows(plain), name
        assert "Exchange" not in plan(ours) and "SortMergeJoin" in plan(ours), name
        assert "Exchange" in plan(plain), name


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_stand_beside(spark, scratch, star, how):
    child, parent, moves = star
    hot = child.withColumn("fk", F.when(F.col("c") % 3 == 0, 2).when(F.col("c") % 3 == 1, 395).otherwise(F.col("fk")))  # 395 has no parent
    t = bucketed.write_bucketed({"child": (hot, "fk"), "parent": (parent, "pk")}, scratch, 16)
    assert set(t["child"].hot_keys) == {2, 395} and t["child"].cold.where("fk in (2, 395)").count() == 0
    assert rows(t["child"].join(t["parent"], how)) == rows(hot.join(parent, hot.fk == parent.pk, how))
    assert rows(t["child"].rows()) == rows(hot)


def test_hot_on_the_other_side_and_in_the_remap(spark, scratch, star):
    child, parent, moves = star
    many = parent.unionByName(spark.range(600).select(F.lit(7).cast("long").alias("pk"), F.lit("again").alias("nm")))
    hot = child.withColumn("fk", F.when(F.col("c") < 1500, 3).otherwise(F.col("fk")))
    t = bucketed.write_bucketed({"child": (hot, "fk"), "parent": (many, "pk"), "moves": (moves, "source_id")}, scratch, 8)
    assert t["parent"].hot_keys == (7,) and t["child"].hot_keys == (3,)
    assert rows(t["child"].join(t["parent"])) == rows(hot.join(many, hot.fk == many.pk))
    assert rows(bucketed.remap(t["child"], t["moves"], "target_id")) == rows(remap_foreign_key(hot, "fk", moves))


def test_another_session_opens_it(spark, scratch, star, no_broadcast):
    child, parent, _ = star
    bucketed.write_bucketed({"child": (child, "fk"), "parent": (parent, "pk")}, scratch, 4)
    for name in ("child", "parent"):
        spark.sql(f"DROP TABLE {bucketed._table(scratch, name)}")  # external: the files stay
    t = bucketed.open_bucketed(spark, scratch)
    joined = t["child"].join(t["parent"], "left_anti")
    assert rows(joined) == rows(child.join(parent, child.fk == parent.pk, "left_anti")) and "Exchange" not in plan(joined)


def test_empty_tables_and_unlike_buckets(spark, scratch, star):
    child, parent, _ = star
    a = bucketed.write_bucketed({"child": (child.limit(0), "fk"), "parent": (parent, "pk")}, f"{scratch}/a", 4)
    assert a["child"].join(a["parent"]).count() == 0 and a["parent"].join(a["child"], "left_anti").count() == 380
    b = bucketed.write_bucketed({"parent": (parent, "pk")}, f"{scratch}/b", 8)
    with pytest.raises(ValueError, match="buckets"):
        a["child"].join(b["parent"])
