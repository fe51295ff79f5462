"""Both sides of every size switch give the same rows; reports are never cut short."""

import pytest
from pyspark.sql import functions as F

from kempt.functions import text
from kempt.operators import checks, dimension, report, rules
from kempt.plans import catalogue
from kempt.sources import delimited, snapshot



SF001 = "/root/testdata/sf0.001"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("child, expected", [
    ([(1,), (2,), (2,)], (0, 0)), ([(None,), (None,)], (2, 1)), ([], (0, 0)), ([(1,), (9,), (9,), (None,)], (3, 2))])
def test_orphan_count_is_the_same_on_both_paths(spark, child, expected):
    kids, parents = frame(spark, child, "fk long"), frame(spark, [(1,), (2,)], "pk long")
    for bound in (0, 100):
        row = checks.orphan_count(kids, "fk", parents, "pk", broadcast_max_rows=bound).first()
        assert (row.orphan_rows, row.orphan_keys) == expected
        optional = checks.orphan_count(kids, "fk", parents, "pk", True, broadcast_max_rows=bound).first()
        nulls = sum(k is None for (k,) in child)
        assert (optional.orphan_rows, optional.orphan_keys) == (expected[0] - nulls, expected[1] - bool(nulls))


def test_relations_of_one_name_are_all_reported(spark):
    kids = frame(spark, [(1, 1), (2, 9)], "a long, b long")
    parents = frame(spark, [(1,), (2,)], "pk long")
    relations = [checks.Relation("r", kids, "a", parents, "pk"), checks.Relation("r", kids, "b", parents, "pk")]
    for bound in (0, 1, 100):
        rows = checks.integrity_report(relations, broadcast_max_rows=bound).collect()
        assert sorted((r.check_name, r.issue_count) for r in rows) == [("r", 0), ("r", 1)]


def test_parents_are_fused_only_while_their_sum_fits(spark):
    kids = frame(spark, [(1, 1, 1)], "a long, b long, c long")
    parents = [spark.range(n).withColumnRenamed("id", "pk") for n in (40, 50, 60)]
    relations = [checks.Relation(c, kids, c, p, "pk") for c, p in zip("abc", parents)]
    assert checks._fusable(relations, [40, 50, 60], 100) == [0, 1]
    assert checks._fusable(relations, [40, 50, 60], 1000) == [0, 1, 2]


def test_long_reports_name_every_failure(spark):
    rows = [(f"c{i:04d}", int(i >= 1100), 0, "FAIL" if i >= 1100 else "PASS") for i in range(1200)]
    with pytest.raises(AssertionError) as failed:
        report.assert_valid(frame(spark, rows, "check_name string, actual long, expected long, status string"))
    assert str(failed.value).count("actual=1") == 100 and "c1199" in str(failed.value)


def test_diff_sees_drift_and_null_keys(spark):
    before = frame(spark, [(1, "a", "x"), (None, "n", None), (3, "c", None)], "id long, v string, old string")
    after = frame(spark, [(1, "a", 5), (None, "n", None), (3, "c", None), (4, "d", None)], "id long, v string, new int")
    got = {r.id: (r.change, r.changed_columns) for r in report.diff_snapshots(before, after, ["id"]).collect()}
    assert got == {1: ("changed", "old,new"), None: ("same", ""), 3: ("same", ""), 4: ("added", None)}


def test_export_keeps_long_keys_and_line_breaks(spark, scratch):
    df = frame(spark, [(9007199254740993, "a\nb"), (2, "c")], "id long, t string")
    path = f"{scratch}/csv"
    assert snapshot.export_csv(df, path, ["id"], integer_columns=["id"]) == 2
    back = delimited.read_delimited(spark, path, df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_repeated_placeholder_is_inserted_once_at_most(spark):
    dim = frame(spark, [(0, "N/A")] * 5 + [(1, "x")], "id long, nm string")
    assert dimension.add_member_once(dim, "id", {"id": 0, "nm": "N/A"}).count() == 6


def test_repair_rules_stay_in_generated_code(spark):
    for query in (catalogue.q19_suffix_space_case_repairs, catalogue.q27_change_preview_log):
        plan = query(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "transform(" not in plan and "*(1) Project" in plan
    chain = [rules.Rule(f"r{k}", "nm", lambda c: text.append_if_endswith(c, "Ltd", ".")) for k in range(30)]
    df = frame(spark, [(1, "A Ltd"), (2, "B Ltd.")], "id long, nm string")
    out = rules.apply_rules(df, chain).where(F.col("nm").endswith("."))
    assert sorted(r.nm for r in out.collect()) == ["A Ltd.", "B Ltd."]


def test_every_injected_defect_is_restored(spark):
    assert catalogue.q17_mojibake_repair_chain(spark, SF001).agg(F.min("restored")).first()[0] == 1


def test_row_counts_need_no_shuffle_of_rows(spark):
    plan = catalogue.q42_row_count_report(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "RoundRobin" not in plan
