from pyspark.sql import functions as F

from kempt.functions import text
from kempt.operators import rules


def test_apply_rules_in_order_single_projection(spark):
    df = spark.createDataFrame([(7, "ADM Protexin Ltd"), (43, "Bronson  Laboratories Ltd."),
                                (236, "West-Coast works ltd."), (1, None)], "id int, nm string")
    rs = [
        rules.Rule("spaces", "nm", text.collapse_spaces, lambda c: c.contains("  ")),
        rules.Rule("period", "nm", lambda c: F.concat(c, F.lit(".")), lambda c: c.endswith("Ltd")),
        rules.Rule("case", "nm", lambda c: F.replace(c, F.lit("ltd."), F.lit("Ltd.")), lambda c: c.endswith("ltd.")),
    ]
    out = {r["id"]: r["nm"] for r in rules.apply_rules(df, rs).collect()}
    assert out == {7: "ADM Protexin Ltd.", 43: "Bronson Laboratories Ltd.", 236: "West-Coast works Ltd.", 1: None}


def test_set_value_by_equality(spark):
    df = spark.createDataFrame([(19, "Emulsion for infusion"), (20, "Tablet")], "id int, nm string")
    r = rules.set_value("cap", "nm", "Emulsion for Infusion", F.col("nm") == "Emulsion for infusion")
    assert sorted(x["nm"] for x in rules.apply_rules(df, [r]).collect()) == ["Emulsion for Infusion", "Tablet"]


def test_row_level_predicate_limits_rule_to_keys(spark):
    df = spark.createDataFrame([(239, "Long-acting ß-agonist"), (5, "ß stays")], "id int, nm string")
    a, b = text.SHARP_S_TO_BETA
    r = rules.Rule("beta", "nm", lambda c: F.replace(c, F.lit(a), F.lit(b)), F.col("id").isin(239, 362))
    out = {x["id"]: x["nm"] for x in rules.apply_rules(df, [r]).collect()}
    assert out == {239: "Long-acting β-agonist", 5: "ß stays"}


def test_long_conditional_chain_stays_small(spark):
    df = spark.createDataFrame([(1, "x  y Ltd")], "id int, nm string")
    rs = [rules.Rule(f"r{i}", "nm", lambda c: F.concat(c, F.lit("")), lambda c: c.contains("Ltd"))
          for i in range(30)]
    out = rules.apply_rules(df, rs).where(F.col("nm").contains("y"))
    assert out.count() == 1  # a 3^30 expression would never plan


def test_preview_changes_lists_only_changed_rows(spark):
    df = spark.createDataFrame([(7, "A Ltd"), (8, "B Ltd.")], "id int, nm string")
    r = rules.Rule("period", "nm", lambda c: F.concat(c, F.lit(".")), lambda c: c.endswith("Ltd"))
    rows = rules.preview_changes(df, ["id"], [r]).collect()
    assert [(x["id"], x["column_name"], x["before"], x["after"]) for x in rows] == [(7, "nm", "A Ltd", "A Ltd.")]


def test_keyed_replacements_ordered_per_key(spark):
    df = spark.createDataFrame([(129, "Libra Pharmaceuticls Ltd"), (5, "Pharmaceuticls")], "id long, nm string")
    fixes = spark.createDataFrame([(129, 2, "Ltd", "Ltd."), (129, 1, "Pharmaceuticls", "Pharmaceuticals")],
                                  "id long, seq int, search string, replacement string")
    out = {x["id"]: x["nm"] for x in rules.apply_keyed_replacements(df, "id", "nm", fixes).collect()}
    assert out == {129: "Libra Pharmaceuticals Ltd.", 5: "Pharmaceuticls"}
    # above the broadcast bound the same result comes from a shuffle join
    out2 = {x["id"]: x["nm"] for x in
            rules.apply_keyed_replacements(df, "id", "nm", fixes, broadcast_max_rows=0).collect()}
    assert out2 == out


def test_change_log_between_versions(spark):
    before = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, nm string, s string")
    after = spark.createDataFrame([(1, "a", "x"), (2, "B", "y")], "id int, nm string, s string")
    rows = rules.change_log(before, after, ["id"], ["nm", "s"]).collect()
    assert [(r["id"], r["column_name"], r["before"], r["after"]) for r in rows] == [(2, "nm", "b", "B")]
