from pyspark.sql import functions as F

from kempt.operators import profile, report


def test_cardinality_histogram_and_frequency(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    assert [(r["children"], r["parents"]) for r in profile.cardinality_histogram(df, ["k"]).collect()] == [(1, 1), (2, 1), (3, 1)]
    assert profile.frequency(df, "k").first()["k"] == 1


def test_first_and_all_artifact_discovery(spark):
    df = spark.createDataFrame([(1, "it’s Ã¶k"), (2, "x’y"), (3, "plain")], "id int, s string")
    first = {(r["char1"], r["char2"], r["char3"]): r["affected_rows"]
             for r in profile.first_artifact_discovery(df, "s").collect()}
    assert first == {(8217, 115, 32): 1, (8217, 121, None): 1}
    runs = {r["artifact"]: (r["occurrences"], r["affected_rows"]) for r in profile.all_artifact_runs(df, "s", "id").collect()}
    assert runs == {"’": (2, 2), "Ã¶": (1, 1)}


def test_null_pattern_labels(spark):
    labels = ("B", "Mixed", "Placeholder", "Empty")
    df = spark.createDataFrame([(None, 1.0), ("a", 1.0), ("a", None), (None, None)], "s string, p double")
    got = [r["l"] for r in df.select(profile.classify_null_pattern(F.col("s"), F.col("p"), labels).alias("l")).collect()]
    assert got == list(labels)


def test_children_per_member_includes_zero(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "pk int, name string")
    child = spark.createDataFrame([(1,), (1,), (9,)], "fk int")
    got = {r["pk"]: r["child_count"] for r in profile.children_per_member(parent, "pk", child, "fk").collect()}
    assert got == {1: 2, 2: 0}


def test_null_rate_by_member(spark):
    parent = spark.createDataFrame([(1, "Tablet"), (2, "Syrup")], "pk int, form string")
    child = spark.createDataFrame([(1, None), (1, "5 mg"), (2, "1 ml"), (None, None)], "fk int, strength string")
    got = {r["form"]: (r["total_rows"], r["null_strength"])
           for r in profile.null_rate_by_member(child, "fk", parent, "pk", "form", "strength").collect()}
    assert got == {"Tablet": (2, 1), None: (1, 1)}


def test_top_n_with_parent_falls_back_when_head_has_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 99), (3, 2), (4, 3)], "cid int, fk int")
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pk int, name string")
    got = [r["cid"] for r in profile.top_n_with_parent(child, "fk", parent, "pk", ["cid"], 2).collect()]
    assert sorted(got) == [1, 3]


def test_rows_at_max_and_domain(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0)], "id int, v double")
    assert sorted(r["id"] for r in profile.rows_at_max(df, "v").collect()) == [2, 3]
    d = spark.createDataFrame([("view",), ("error",), (None,)], "t string")
    assert sorted((r["t"] or "", r["n_rows"]) for r in profile.domain_violations(d, "t", ["view"]).collect()) == [("", 1), ("error", 1)]


def test_validate_statuses(spark):
    actual = spark.createDataFrame([("rows", 10), ("dups", 0), ("enc", 1), ("extra", 3)], "check_name string, actual long")
    exp = report.expectations(spark, [("rows", 10, None), ("dups", 0, None), ("enc", 1, "intentional β"),
                                      ("missing", 0, None)])
    got = {r["check_name"]: r["status"] for r in report.validate(actual, exp).collect()}
    assert got == {"rows": "PASS", "dups": "PASS", "enc": "DOCUMENTED_EXCEPTION", "extra": "FAIL", "missing": "FAIL"}
    import pytest
    with pytest.raises(AssertionError):
        report.assert_valid(report.validate(actual, exp))


def test_diff_snapshots(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, nm string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id int, nm string")
    got = {r["id"]: (r["change"], r["changed_columns"]) for r in report.diff_snapshots(before, after, ["id"]).collect()}
    assert got == {1: ("same", ""), 2: ("changed", "nm"), 3: ("removed", None), 4: ("added", None)}


def test_row_count_report_and_sample(spark):
    a = spark.range(3)
    b = spark.range(5)
    got = [(r["table_name"], r["row_count"]) for r in report.row_count_report({"b": b, "a": a}).collect()]
    assert got == [("a", 3), ("b", 5)]
    assert [r["id"] for r in report.sample_first(b, ["id"], 2).collect()] == [0, 1]


def test_numeric_range(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    assert profile.numeric_range(df, "v").first().asDict() == {"min_value": 1.0, "max_value": 3.0,
                                                                "avg_value": 2.0, "non_null_rows": 2}


def test_first_artifact_discovery_with_example_key_is_hash_based(spark):
    df = spark.createDataFrame([(1, "it’s"), (2, "x’y"), (3, "plain")], "id int, s string")
    out = profile.first_artifact_discovery(df, "s", example_key="id")
    assert sorted((r["char1"], r["example_id"], r["affected_rows"]) for r in out.collect()) == \
        [(8217, 1, 1), (8217, 2, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_distinct_coverage_exact_and_approx(spark):
    df = spark.range(1000).selectExpr("id % 100 AS a", "id % 7 AS b")
    assert tuple(profile.distinct_coverage(df, "a", "b").first()) == (1000, 100, 7)
    r = profile.distinct_coverage(df, "a", "b", approx_rsd=0.02).first()
    assert r["total_rows"] == 1000 and abs(r["distinct_a"] - 100) <= 5 and r["distinct_b"] == 7
