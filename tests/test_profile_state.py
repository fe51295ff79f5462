"""Merged profile states against full scans; sketch errors; only the appended part is read."""

import glob
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from kempt.operators import profile_state as ps

SCHEMA = "i int, t string, v double, d date, m decimal(10,2), b boolean"


def some_rows(seed, n):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice([None, *x])
    return [(pick(rng.randrange(-50, 50)), pick("", " ", "a", f"w{rng.randrange(99)}"), pick(rng.random() * 9 - 4), pick(date(2020, 1, 1 + rng.randrange(28))),
             None, pick(True, False)) for _ in range(n)]


def rows(df):
    return sorted(map(str, df.collect()))


def test_counters_of_any_split_equal_a_full_scan(spark):
    data = some_rows(1, 500)
    whole = ps.counters(ps.profile_state(spark.createDataFrame(data, SCHEMA)))
    for cuts in ([0, 500], [0, 3, 3, 200, 500], [0, 0, 499, 500]):
        parts = [ps.profile_state(spark.createDataFrame(data[a:b], SCHEMA)) for a, b in zip(cuts, cuts[1:])]
        states = parts[0]
        for p in reversed(parts[1:]):
            states = p.unionByName(states)
        assert rows(ps.counters(ps.merge_states(states))) == rows(whole)
    got = {r.column_name: r for r in whole.collect()}
    ints = [r[0] for r in data if r[0] is not None]
    assert (got["i"].n_rows, got["i"].n_null, got["i"].min_value, got["i"].max_value) == (500, 500 - len(ints), str(min(ints)), str(max(ints)))
    assert got["t"].n_blank == sum(r[1] is not None and r[1].strip(" ") == "" for r in data)
    assert got["m"].min_value is None and got["m"].n_null == 500


def test_whole_numbers_beyond_doubles_are_exact(spark):
    df = spark.createDataFrame([(9007199254740993,), (9007199254740992,)], "k long")
    assert ps.counters(ps.profile_state(df)).first().max_value == "9007199254740993"


def test_empty_table(spark):
    r = ps.counters(ps.profile_state(spark.createDataFrame([], SCHEMA), ["i"])).first()
    assert tuple(r) == ("i", 0, 0, 0, None, None)
    e = ps.estimates(ps.profile_state(spark.createDataFrame([], SCHEMA), ["i"])).first()
    assert (e.n_distinct, e.q50) == (0, None)


def test_sketch_errors(spark):
    n = 60_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), (F.col("id") % 500).alias("few"), F.concat(F.lit("x"), F.col("id") % 9000).alias("t"))
    parts = [ps.profile_state(df.where(F.col("k") % 5 == i)) for i in range(5)]
    state = parts[0]
    for p in parts[1:]:
        state = state.unionByName(p)
    got = {r.column_name: r for r in ps.estimates(ps.merge_states(state)).collect()}
    for c, true in (("k", n), ("few", 500), ("t", 9000)):
        assert abs(got[c].n_distinct - true) <= 0.06 * true, c  # nearly four standard errors
    for q, rank in ((got["k"].q25, 0.25), (got["k"].q50, 0.5), (got["k"].q75, 0.75)):
        assert abs(q / n - rank) <= 0.03


def test_only_the_appended_part_is_read(spark, scratch):
    table = ps.ProfiledTable(spark, scratch)
    data = some_rows(2, 200)
    table.append(spark.createDataFrame(data[:150], SCHEMA), "a")
    for path in glob.glob(f"{scratch}/rows/part=a/*.parquet"):
        with open(path, "wb") as f:  # unreadable from now on
            f.write(b"no parquet")
    table.append(spark.createDataFrame(data[150:], SCHEMA), "b")
    assert table.parts() == ["a", "b"]
    assert rows(ps.counters(table.profile())) == rows(ps.counters(ps.profile_state(spark.createDataFrame(data, SCHEMA))))
    with pytest.raises(Exception, match="exists"):
        table.append(spark.createDataFrame(data, SCHEMA), "a")
