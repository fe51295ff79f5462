import os

from pyspark.sql import functions as F

from paths import SF001
from kempt.functions import text
from kempt.operators import rules
from kempt.plans import catalogue as C
from kempt.plans.stage import clean_dimension_stage


def test_clean_dimension_stage_publishes_and_verifies(spark, scratch):
    dim = C._v(spark, SF001, "dirty_part")
    li = C._t(spark, SF001, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    fix = rules.Rule("mojibake", "nm", text.repair_mojibake)
    res = clean_dimension_stage(spark, dimension_name="part", dim=dim, id_col="id", name_col="nm",
                                placeholder=C.PART_PLACEHOLDER, children={"lineitem": (li, "l_partkey")},
                                out_root=os.path.join(scratch, "snap"), name_rules=[fix])
    assert res.row_counts["lineitem"] == li.count()
    checks = {r["check_name"]: r["issue_count"] for r in res.verification.collect()}
    assert checks["lineitem.l_partkey -> part.id: orphans"] == 0
    part = spark.read.parquet(os.path.join(scratch, "snap", "part"))
    assert part.where(F.col("id") == -1).count() == 1
