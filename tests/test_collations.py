"""Declared collations: joins, checks and merges follow them, spellings stay."""

from pyspark.sql import types as T

from kempt.model import CASE_AND_TRAILING_BLANKS, ForeignKey, TableSpec
from kempt.operators import checks, dimension
from kempt.operators.report import diff_snapshots

NAMES = TableSpec("names", T.StructType([T.StructField("name", T.StringType())]), ("name",), collations=(("name", CASE_AND_TRAILING_BLANKS),))
REFS = TableSpec("refs", T.StructType([T.StructField("id", T.LongType()), T.StructField("ref", T.StringType())]), ("id",),
                 (ForeignKey("ref", "names", "name"),), collations=(("ref", CASE_AND_TRAILING_BLANKS),))


def test_constraints_follow_the_collation(spark):
    tables = {"names": spark.createDataFrame([("Äpfel",), ("äPFEL  ",), ("x",), (" y",)], "name string"),
              "refs": spark.createDataFrame([(1, "ÄPFEL"), (2, "X "), (3, "y"), (4, None), (5, " Y")], "id long, ref string")}
    got = {r.check_name: r.issue_count for r in checks.spec_report(tables, {"names": NAMES, "refs": REFS}).collect()}
    assert got == {"names.name is null": 0, "names duplicate (name)": 1, "refs.id is null": 0, "refs.ref is null": 1,
                   "refs duplicate (id)": 0, "refs.ref -> names.name": 2}
    for bound in (1000, 0):
        refs, names = REFS.collated(tables["refs"]), NAMES.collated(tables["names"])
        assert checks.orphan_count(refs, "ref", names, "name", broadcast_max_rows=bound).first().orphan_rows == 2


def test_merge_follows_the_collation_and_keeps_spellings(spark):
    dim = spark.createDataFrame([(1, "Beta"), (2, "BETA "), (3, "beta,"), (4, "Beta,x"), (5, "gamma"), (6, ","), (7, "DELTA,y"), (8, "delta,Y ")],
                                "id long, ref string")
    merge = dimension.plan_dimension_merge(REFS.collated(dim), "id", "ref", placeholder={"id": 0, "ref": "N/A"})
    assert {r.id: r._target for r in merge.mapping.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 0, 7: 7, 8: 7}
    assert {r.id: r.ref for r in merge.dimension().collect()} == {1: "Beta", 5: "gamma", 7: "DELTA,y", 0: "N/A"}
    assert merge.mapping.schema["ref"].dataType.collation == CASE_AND_TRAILING_BLANKS


def test_diff_sees_equal_spellings_as_the_same(spark):
    before, after = (REFS.collated(spark.createDataFrame(rows, "id long, ref string")) for rows in ([(1, "A"), (2, "b")], [(1, "a "), (2, "c")]))
    assert {r.id: r.change for r in diff_snapshots(before, after, ["id"]).collect()} == {1: "same", 2: "changed"}


def test_no_collation_changes_nothing(spark):
    plain = TableSpec("t", NAMES.schema, ("name",))
    df = spark.createDataFrame([("a",)], "name string")
    assert plain.collated(df) is df
