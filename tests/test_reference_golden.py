"""Golden values: three delimited source snapshots (Manufacturer, Dosage_Form,
Generic_Indication; UTF-8 with BOM, header row), cleaned with the library, must
reproduce the documented validation rows.  KEMPT_GOLDEN_SNAPSHOTS may name a
folder holding ``<table>.csv``; otherwise snapshots with the documented row
counts and defects (at the documented ids) are generated."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions import text
from kempt.model import TableSpec
from kempt.operators import checks, report, rules
from kempt.sources import delimited



def _generated() -> str:
    folder = tempfile.mkdtemp(prefix="kempt-golden-")
    defects = {65: "Doctorâ€™s Chemical Works Ltd.", 43: "Bronson  Laboratories (BD) Ltd.", 48: "Double  Space Ltd.",
               7: "Seventh Ltd", 68: "Sixty-eighth Ltd", 159: "Hundred fifty-ninth Ltd",
               236: "West-Coast pharmaceutical works ltd.", 129: "Libra Pharmaceuticls Ltd."}
    plain = iter(["Ltd."] * 141 + ["Limited"] * 13 + ["Corporation"] * 78)
    makers = [(i, defects.get(i) or f"Maker {i} {next(plain)}", f"m-{i}") for i in range(1, 241)]
    forms = [(i, "Emulsion for infusion" if i == 19 else f"Form {i}", f"f-{i}") for i in range(1, 114)]
    links = [(i, i, 1 + i % 662) for i in range(1, 1609)]
    for name, header, rows in (("Manufacturer", "Manufacturer_ID,Manufacturer_Name,Slug", makers),
                               ("Dosage_Form", "Dosage_Form_ID,Dosage_Form_Name,Slug", forms),
                               ("Generic_Indication", "Generic_Indication_ID,Generic_ID,Indication_ID", links)):
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8-sig") as f:
            f.write("\n".join([header, *(",".join(map(str, r)) for r in rows)]) + "\n")
    return folder


SRC = os.environ.get("KEMPT_GOLDEN_SNAPSHOTS") or _generated()


def spec(name, cols):
    return TableSpec(name, T.StructType([T.StructField(c, t, c.endswith("_ID")) for c, t in cols]), (cols[0][0],))


MANUFACTURER = spec("Manufacturer", [("Manufacturer_ID", T.IntegerType()), ("Manufacturer_Name", T.StringType()),
                                     ("Slug", T.StringType())])
DOSAGE_FORM = spec("Dosage_Form", [("Dosage_Form_ID", T.IntegerType()), ("Dosage_Form_Name", T.StringType()),
                                   ("Slug", T.StringType())])
GENERIC_INDICATION = spec("Generic_Indication", [("Generic_Indication_ID", T.IntegerType()),
                                                 ("Generic_ID", T.IntegerType()), ("Indication_ID", T.IntegerType())])


def load(spark, s):
    return delimited.read_delimited(spark, f"{SRC}/{s.name}.csv", s.schema)


def dup_count(df, col):
    return checks.duplicate_groups(df, [col]).count()


def test_manufacturer_inspection_matches_documented_issues(spark):
    m = load(spark, MANUFACTURER)
    nm = F.col("Manufacturer_Name")
    ids = lambda pred: sorted(r[0] for r in m.where(pred).select("Manufacturer_ID").collect())
    assert m.count() == 240
    assert ids(text.has_non_ascii(nm)) == [65]
    assert ids(nm.contains("  ")) == [43, 48]
    assert ids(nm.endswith("Ltd")) == [7, 68, 159]
    assert ids(nm.endswith("ltd.")) == [236]
    counts = checks.run_checks(m, {"ltd": checks.count_where(nm.endswith("Ltd.")),
                                   "limited": checks.count_where(nm.endswith("Limited"))}).first()
    assert (counts["ltd"], counts["limited"]) == (145, 13)


def test_manufacturer_cleaning_meets_validation(spark):
    m = load(spark, MANUFACTURER).select("Manufacturer_ID", "Manufacturer_Name")
    c = "Manufacturer_Name"
    fixed = rules.apply_rules(m, [
        rules.Rule("apostrophe", c, text.repair_mojibake, lambda x: x.contains("â€™")),
        rules.Rule("double_space", c, text.collapse_spaces, lambda x: x.contains("  ")),
        rules.Rule("missing_period", c, lambda x: F.concat(x, F.lit(".")), lambda x: x.endswith("Ltd")),
        rules.Rule("suffix_case", c, lambda x: F.replace(x, F.lit("ltd."), F.lit("Ltd.")),
                   lambda x: x.endswith("ltd.")),
    ])
    typo = spark.createDataFrame([(129, 1, "Pharmaceuticls", "Pharmaceuticals")],
                                 "Manufacturer_ID int, seq int, search string, replacement string")
    fixed = rules.apply_keyed_replacements(fixed, "Manufacturer_ID", c, typo)
    nm = F.col(c)
    wide = checks.run_checks(fixed, {
        "total_rows": checks.row_count(), "null_names": checks.null_count(c), "blank_names": checks.blank_count(c),
        "double_spaces": checks.contains_count(c, "  "), "encoding_issues": checks.non_ascii_count(c),
        "ltd_without_period": checks.count_where(nm.endswith("Ltd")),
        "lowercase_ltd": checks.count_where(nm.endswith("ltd."))})
    expected = report.expectations(spark, [
        ("total_rows", 240, None), ("null_names", 0, None), ("blank_names", 0, None), ("double_spaces", 0, None),
        ("encoding_issues", 1, "intentional curly apostrophe in id 65"), ("ltd_without_period", 0, None),
        ("lowercase_ltd", 0, None)])
    result = report.validate(checks.to_long(wide), expected)
    report.assert_valid(result)
    assert dup_count(fixed, c) == 0
    names = {r[0]: r[1] for r in fixed.where(F.col("Manufacturer_ID").isin(65, 129, 236, 43)).collect()}
    assert names == {65: "Doctor’s Chemical Works Ltd.", 129: "Libra Pharmaceuticals Ltd.",
                     236: "West-Coast pharmaceutical works Ltd.", 43: "Bronson Laboratories (BD) Ltd."}


def test_dosage_form_capitalisation_and_validation(spark):
    d = load(spark, DOSAGE_FORM)
    c = "Dosage_Form_Name"
    assert d.where(F.col("Dosage_Form_ID") == 19).first()[c] == "Emulsion for infusion"
    fixed = rules.apply_rules(d, [rules.set_value("capitalise", c, "Emulsion for Infusion",
                                                  F.col(c) == "Emulsion for infusion")])
    r = checks.run_checks(fixed, {"total": checks.row_count(), "nulls": checks.null_count(c),
                                  "blank": checks.blank_count(c), "commas": checks.contains_count(c, ","),
                                  "encoding": checks.non_ascii_count(c)}).first()
    assert tuple(r) + (dup_count(fixed, c),) == (113, 0, 0, 0, 0, 0)
    assert fixed.where(F.col("Dosage_Form_ID") == 19).first()[c] == "Emulsion for Infusion"


def test_generic_indication_validation(spark):
    gi = load(spark, GENERIC_INDICATION)
    cov = checks.run_checks(gi, {"total": checks.row_count(), "null_g": checks.null_count("Generic_ID"),
                                 "null_i": checks.null_count("Indication_ID"),
                                 "dg": F.count_distinct("Generic_ID"), "di": F.count_distinct("Indication_ID")}).first()
    dups = checks.duplicate_groups(gi, ["Generic_ID", "Indication_ID"]).count()
    assert tuple(cov) + (dups,) == (1608, 0, 0, 1608, 662, 0)
