from pyspark.sql import functions as F

from kempt.operators import dimension

PH = {"id": 0, "name": "N/A", "slug": "n-a"}


def dims(spark):
    rows = [
        (1, "4-Quinolone preparations", "a"),
        (2, ",", "b"),                                         # lone -> placeholder
        (3, ",Something", "c"),                                # leading -> placeholder
        (4, "4-Quinolone preparations,", "d"),                 # trailing -> merged into 1
        (5, "4-Quinolone preparations,Acute sinusitis", "e"),  # composite -> 1
        (6, "Antacids", "f"),
        (7, "Antacids", "g"),                                  # clean duplicate -> 6
        (8, "Antacids,", "h"),                                 # trailing duplicate -> 6 (3-way group)
        (9, "Unknown class,Other text", "i"),                  # composite without a clean match: kept
    ]
    return spark.createDataFrame(rows, "id int, name string, slug string")


def children(spark):
    return spark.createDataFrame([(100 + i, fk) for i, fk in enumerate([1, 2, 3, 4, 5, 5, 7, 8, 9, 42, None])],
                                 "child_id int, class_id int")


def test_survivor_map_routes_every_member(spark):
    m = dimension.plan_dimension_merge(dims(spark), "id", "name", placeholder=PH, materialize=False)
    got = {r["id"]: (r["member_class"], r["target_id"]) for r in m.survivor_map().collect()}
    assert got == {1: ("clean", 1), 2: ("unrecoverable", 0), 3: ("unrecoverable", 0), 4: ("strip", 1),
                   5: ("composite", 1), 6: ("clean", 6), 7: ("clean", 6), 8: ("strip", 6),
                   9: ("composite", 9)}


def test_remap_children_keeps_rows_and_unknown_keys(spark):
    m = dimension.plan_dimension_merge(dims(spark), "id", "name", placeholder=PH, materialize=True)
    out = {r["child_id"]: r["class_id"] for r in m.remap(children(spark), "class_id").collect()}
    assert out == {100: 1, 101: 0, 102: 0, 103: 1, 104: 1, 105: 1, 106: 6, 107: 6, 108: 9, 109: 42, 110: None}


def test_cleaned_dimension_and_placeholder_once(spark):
    m = dimension.plan_dimension_merge(dims(spark), "id", "name", placeholder=PH, materialize=False)
    d = {r["id"]: (r["name"], r["slug"]) for r in m.dimension().collect()}
    assert d == {0: ("N/A", "n-a"), 1: ("4-Quinolone preparations", "a"), 6: ("Antacids", "f"),
                 9: ("Unknown class,Other text", "i")}
    assert [r["id"] for r in m.unmatched_composites().collect()] == [9]


def test_placeholder_not_duplicated_when_present(spark):
    d = spark.createDataFrame([(0, "N/A", "n-a"), (1, "x", "x")], "id int, name string, slug string")
    once = dimension.add_member_once(dimension.add_member_once(d, "id", PH), "id", PH)
    assert once.where(F.col("id") == 0).count() == 1 and once.count() == 2


def test_reassign_by_parent_predicate(spark):
    out = dimension.reassign_by_parent(children(spark), "class_id", dims(spark), "id",
                                       F.col("name").startswith(","), 0)
    got = {r["child_id"]: r["class_id"] for r in out.collect()}
    assert got[101] == 0 and got[102] == 0 and got[100] == 1 and got[110] is None


def test_delete_where_keeps_null_predicate_rows(spark):
    df = spark.createDataFrame([(1, ",x"), (2, None), (3, "ok")], "id int, name string")
    kept = sorted(r["id"] for r in dimension.delete_where(df, F.col("name").startswith(",")).collect())
    assert kept == [2, 3]


def test_delete_listed(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    listed = spark.createDataFrame([(2,), (2,)], "id int")
    assert sorted(r["id"] for r in dimension.delete_listed(df, ["id"], listed).collect()) == [1, 3]


def test_case_insensitive_merge_keeps_survivor_spelling(spark):
    d = spark.createDataFrame([(1, "Antacids"), (2, "ANTACIDS"), (3, "antacids,")], "id int, name string")
    cs = dimension.plan_dimension_merge(d, "id", "name", placeholder=PH | {"slug": None}, materialize=False)
    ci = dimension.plan_dimension_merge(d, "id", "name", placeholder=PH | {"slug": None}, materialize=False,
                                        case_insensitive=True)
    assert {r["id"]: r["target_id"] for r in cs.survivor_map().collect()} == {1: 1, 2: 2, 3: 3}
    assert {r["id"]: r["target_id"] for r in ci.survivor_map().collect()} == {1: 1, 2: 1, 3: 1}
    assert sorted((r["id"], r["name"]) for r in ci.dimension().collect()) == [(0, "N/A"), (1, "Antacids")]
