"""The documented outcome of the dimension clean-up, on a fixture built by rule
with the documented defect counts: 1,599 members (421 clean, 1 lone comma,
10 leading commas, 24 trailing-comma copies of clean names, 1,143 composites
whose prefix is a clean name, 2 clean names with a wrong-letter beta) and
children of which 51 point at unrecoverable members and 10 already point at the
placeholder.  Expected after cleaning: 422 members (placeholder included),
1 placeholder, 0 commas, 2 non-ASCII (intentional beta), 0 duplicate names,
61 children on the placeholder, 0 orphans."""

import os

from pyspark.sql import functions as F

from kempt.functions import text
from kempt.operators import checks, rules
from kempt.plans.stage import clean_dimension_stage

PH = {"Drug_Class_ID": 0, "Drug_Class_Name": "N/A", "Slug": "n-a"}
BETA_IDS = (239, 362)


def fixture(spark):
    rows = []
    for i in range(1, 422):                       # 421 clean members, ids 1..421
        name = f"Class {i}" if i not in BETA_IDS else f"Long-acting ß{i}-agonists"
        rows.append((i, name))
    nxt = 422
    rows.append((nxt, ",")); nxt += 1             # lone comma
    for i in range(10):                            # leading commas
        rows.append((nxt, f",Orphan text {i}")); nxt += 1
    for i in range(1, 25):                         # trailing-comma copies of clean names
        rows.append((nxt, f"Class {i},")); nxt += 1
    plain = [i for i in range(1, 422) if i not in BETA_IDS]
    for k in range(1143):                          # composites naming a clean member first
        j = plain[k % len(plain)]
        rows.append((nxt, f"Class {j},Indication {k}")); nxt += 1
    dim = spark.createDataFrame([(i, n, f"slug-{i}") for i, n in rows],
                                "Drug_Class_ID int, Drug_Class_Name string, Slug string")
    bad = [i for i, n in rows if n.startswith(",")]
    kids = [(g, bad[g % len(bad)]) for g in range(51)]                    # 51 on unrecoverable members
    kids += [(51 + g, 0) for g in range(10)]                             # 10 already on the placeholder
    movable = [i for i, n in rows if not n.startswith(",")]
    kids += [(61 + g, movable[(g * 7) % len(movable)]) for g in range(1650)]
    generic = spark.createDataFrame(kids, "Generic_ID int, Drug_Class_ID int")
    return dim, generic


def test_documented_dimension_outcome(spark, scratch):
    dim, generic = fixture(spark)
    assert dim.count() == 1599
    beta = rules.Rule("beta", "Drug_Class_Name", lambda c: F.replace(c, F.lit(text.SHARP_S_TO_BETA[0]),
                                                                        F.lit(text.SHARP_S_TO_BETA[1])),
                      F.col("Drug_Class_ID").isin(*BETA_IDS))
    res = clean_dimension_stage(spark, dimension_name="Drug_Class", dim=dim, id_col="Drug_Class_ID",
                                name_col="Drug_Class_Name", placeholder=PH,
                                children={"Generic": (generic, "Drug_Class_ID")},
                                out_root=os.path.join(scratch, "clean"), name_rules=[beta])
    assert res.row_counts["Drug_Class"] == 422 and res.row_counts["Generic"] == generic.count()
    assert all(r["issue_count"] == 0 for r in res.verification.collect())

    dc = spark.read.parquet(os.path.join(scratch, "clean", "Drug_Class"))
    g = spark.read.parquet(os.path.join(scratch, "clean", "Generic"))
    n = F.col("Drug_Class_Name")
    summary = checks.run_checks(dc, {
        "total": checks.row_count(), "placeholder": checks.count_where(n == "N/A"),
        "commas": checks.contains_count("Drug_Class_Name", ","),
        "non_ascii": checks.non_ascii_count("Drug_Class_Name")}).first()
    assert tuple(summary) == (422, 1, 0, 2)
    assert checks.duplicate_groups(dc, ["Drug_Class_Name"]).count() == 0
    assert g.where(F.col("Drug_Class_ID") == 0).count() == 61
    assert sorted(r[0] for r in dc.where(text.has_non_ascii(n)).select(n).collect()) == \
        ["Long-acting β239-agonists", "Long-acting β362-agonists"]
