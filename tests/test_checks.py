from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from kempt.model import ForeignKey, TableSpec, drop_order, load_order
from kempt.operators import checks


def test_fused_null_profile_one_row(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None), (3, None, None)], "k int, a int, b string")
    r = checks.null_profile(df, ["a", "b"]).first().asDict()
    assert r == {"total_rows": 3, "null_a": 2, "null_b": 2}


def test_null_profile_empty_input_is_zero_not_null(spark):
    df = spark.createDataFrame([], "a int")
    assert checks.null_profile(df, ["a"]).first().asDict() == {"total_rows": 0, "null_a": 0}


def test_text_hygiene(spark):
    df = spark.createDataFrame([(" a",), ("b ",), ("c  d",), ("   ",), (None,), ("ok",)], "s string")
    r = checks.text_hygiene(df, ["s"]).first().asDict()
    assert r == {"column_name": "s", "null_rows": 1, "blank_rows": 1, "whitespace_rows": 3,
                 "extra_space_rows": 4}


def test_duplicate_groups_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    got = {(r["a"], r["b"]): r["n_rows"] for r in checks.duplicate_groups(df, ["a", "b"]).collect()}
    assert got == {(1, None): 2}


def test_duplicate_groups_case_insensitive(spark):
    df = spark.createDataFrame([("Abc",), ("aBC",), ("x",)], "s string")
    got = checks.duplicate_groups(df, ["s"], case_insensitive=True).collect()
    assert [(r["s"], r["n_rows"]) for r in got] == [("abc", 2)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "a b", "é", "", "long text " * 5]), min_size=0, max_size=30))
def test_duplicate_text_groups_matches_brute_force(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r["text"]: r["n_rows"] for r in checks.duplicate_text_groups(df, "text").collect()}
    want = {t: n for t, n in Counter(texts).items() if n > 1}
    assert got == want


def test_orphans_mandatory_and_optional(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "fk int")
    for bound in (2_000_000, 0):  # broadcast path and pre-aggregated shuffle path
        m = checks.orphan_count(child, "fk", parent, "pk", broadcast_max_rows=bound).first().asDict()
        o = checks.orphan_count(child, "fk", parent, "pk", optional=True, broadcast_max_rows=bound).first().asDict()
        assert m == {"orphan_rows": 3, "orphan_keys": 2}
        assert o == {"orphan_rows": 2, "orphan_keys": 1}
    assert checks.orphan_rows(child, "fk", parent, "pk").count() == 3


def test_integrity_report_from_specs(spark):
    from pyspark.sql import types as T
    s = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("p", T.IntegerType())])
    specs = {"par": TableSpec("par", s, ("id",)),
             "chi": TableSpec("chi", s, ("id",), (ForeignKey("p", "par", "id", optional=True),))}
    tables = {"par": spark.createDataFrame([(1, None)], s), "chi": spark.createDataFrame([(1, 1), (2, 9), (3, None)], s)}
    rows = checks.integrity_report(checks.spec_relations(tables, specs)).collect()
    assert [(r["check_name"], r["issue_count"]) for r in rows] == [("chi.p -> par.id", 1)]
    assert load_order(specs) == ["par", "chi"] and drop_order(specs) == ["chi", "par"]


def test_groups_over_bound(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2, "k int")
    assert checks.groups_over_bound(df, ["k"], 3).first().asDict() == {"groups_over_bound": 1, "max_group_size": 5}


def test_run_checks_and_long_format(spark):
    df = spark.createDataFrame([("a,b",), ("c",)], "s string")
    wide = checks.run_checks(df, {"rows": checks.row_count(), "commas": checks.contains_count("s", ",")})
    assert sorted((r["check_name"], r["actual"]) for r in checks.to_long(wide).collect()) == [("commas", 1), ("rows", 2)]


def test_value_summary_matches_row_level_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b  c",), (None,), (None,), (" d",)], "s string")
    r = checks.value_summary(df, "s", {"nulls": lambda v: v.isNull(), "doubles": lambda v: v.contains("  "),
                                       "edge": lambda v: v != F.trim(v)}).first().asDict()
    assert r == {"total_rows": 6, "nulls": 2, "doubles": 1, "edge": 1, "duplicate_values": 2}


def test_spec_report_covers_every_declared_constraint(spark):
    from pyspark.sql import types as T
    s = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("p", T.IntegerType()),
                      T.StructField("code", T.StringType())])
    specs = {"par": TableSpec("par", s, ("id",), unique=(("code",),)),
             "chi": TableSpec("chi", s, ("id",), (ForeignKey("p", "par", "id"),), not_null=("code",))}
    tables = {"par": spark.createDataFrame([(1, None, "a"), (2, None, "a")], s),
              "chi": spark.createDataFrame([(1, 1, "x"), (1, 9, None), (None, None, "y")], s)}
    got = {r["check_name"]: r["issue_count"] for r in checks.spec_report(tables, specs).collect()}
    assert got == {"par.id is null": 0, "par duplicate (id)": 0, "par duplicate (code)": 1,
                   "chi.code is null": 1, "chi.id is null": 1, "chi.p is null": 1,
                   "chi duplicate (id)": 1, "chi.p -> par.id": 2}


def test_fused_child_checks_equal_per_relation_counts(spark):
    p1 = spark.createDataFrame([(1,), (2,), (2,)], "k int")          # duplicate parent key must not multiply rows
    p2 = spark.createDataFrame([(10,), (20,)], "k int")
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (None, 20), (2, 10)], "a int, b int")
    rels = [checks.Relation("child.a -> p1.k", child, "a", p1, "k"),
            checks.Relation("child.b -> p2.k", child, "b", p2, "k", optional=True)]
    fused = {r["check_name"]: r["issue_count"] for r in checks.fused_child_checks(
        child, rels, {"rows": checks.row_count()}).collect()}
    single = {r.name: checks.orphan_count(r.child, r.fk, r.parent, r.pk, r.optional).first()["orphan_rows"]
              for r in rels}
    assert fused == {"rows": 5, **single} == {"rows": 5, "child.a -> p1.k": 2, "child.b -> p2.k": 1}
    report = {r["check_name"]: r["issue_count"] for r in checks.integrity_report(rels).collect()}
    assert report == single
