"""Kept merges against full runs after random changes; untouched buckets are neither read nor written."""

import glob
import random

from kempt.operators.dimension import plan_dimension_merge
from kempt.operators.incremental_merge import kept_merge

SCHEMA = "id long, nm string, note string"
PLACEHOLDER = {"id": -1, "nm": "N/A"}


def full(spark, members):
    df = spark.createDataFrame([(i, *m) for i, m in members.items()], SCHEMA)
    return rows(plan_dimension_merge(df, "id", "nm", placeholder=PLACEHOLDER).mapping)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def name(rng):
    a, b = rng.choice(["alpha", "beta", "gamma", "delta", "é"]), rng.choice(["x", "y", "alpha"])
    return rng.choice([a, f"{a},", f"{a},{b}", f",{a}", ",", f"{a},,", a.upper(), None])


def test_random_changes_equal_a_full_run(spark, scratch):
    rng = random.Random(1)
    members = {i: (name(rng), f"n{i}") for i in range(60)}
    kept = kept_merge(spark, scratch, spark.createDataFrame([(i, *m) for i, m in members.items()], SCHEMA), "id", "nm",
                      placeholder=PLACEHOLDER, buckets=16)
    assert rows(kept.mapping()) == full(spark, members)
    for step in range(4):
        new = {rng.randrange(80): (name(rng), f"s{step}") for _ in range(rng.choice([0, 1, 6]))}
        gone = rng.sample(range(90), rng.choice([0, 1, 5]))
        kept.update(spark.createDataFrame([(i, *m) for i, m in new.items()], SCHEMA), spark.createDataFrame([(i,) for i in gone], "id long"))
        members = {i: m for i, m in {**members, **new}.items() if i not in gone}
        assert rows(kept.mapping()) == full(spark, members), step


def test_only_touched_buckets_are_read_and_written(spark, scratch):
    members = {i: (f"name {i % 300}" + ("," if i >= 300 else ""), None) for i in range(600)}
    kept = kept_merge(spark, scratch, spark.createDataFrame([(i, *m) for i, m in members.items()], SCHEMA), "id", "nm",
                      placeholder=PLACEHOLDER, buckets=32)
    moved = {r.source_id: r.target_id for r in kept.moved().collect()}
    assert moved == {i: i - 300 for i in range(300, 600)}
    before = set(glob.glob(f"{scratch}/map-*/_bucket=*"))
    assert kept.update(spark.createDataFrame([(7, "name 8", None)], SCHEMA)) <= 2
    new = set(glob.glob(f"{scratch}/map-*/_bucket=*")) - before
    assert 1 <= len(new) <= 2
    for folder in before:  # unreadable from now on: an update that touches none of these does not notice
        if folder.rsplit("/", 1)[1] not in {f.rsplit("/", 1)[1] for f in new}:
            for path in glob.glob(f"{folder}/*.parquet"):
                with open(path, "wb") as f:
                    f.write(b"no parquet")
    assert kept.update(spark.createDataFrame([(7, "name 7", None)], SCHEMA)) <= 2


def test_empty_update_and_empty_dimension(spark, scratch):
    empty = spark.createDataFrame([], SCHEMA)
    kept = kept_merge(spark, f"{scratch}/a", empty, "id", "nm", placeholder=PLACEHOLDER, buckets=4)
    assert kept.mapping().count() == 0 and kept.update(empty) == 0
    kept.update(spark.createDataFrame([(1, "a", None), (2, "a,", None)], SCHEMA))
    assert {(r.source_id, r.target_id) for r in kept.moved().collect()} == {(2, 1)}
