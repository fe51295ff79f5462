import os

from pyspark.sql import functions as F

from paths import SF001
from kempt.model import STAR_SCHEMA
from kempt.operators import checks
from kempt.plans import validate_job
from kempt.sources import snapshot


def _publish(spark, root, nation_fix=None):
    region = spark.read.parquet(f"{SF001}/region.parquet")
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    if nation_fix is not None:
        nation = nation_fix(nation)
    snapshot.write_snapshot({"region": region, "nation": nation}, root, STAR_SCHEMA)


def test_check_names_match_report(spark, scratch):
    _publish(spark, os.path.join(scratch, "s"))
    tables = snapshot.read_snapshot(spark, os.path.join(scratch, "s"))
    specs = {n: STAR_SCHEMA[n] for n in tables}
    got = sorted(r["check_name"] for r in checks.spec_report(tables, specs).collect())
    assert got == sorted(checks.spec_check_names(tables, specs))


def test_job_exit_status(spark, scratch):
    clean, dirty = os.path.join(scratch, "clean"), os.path.join(scratch, "dirty")
    _publish(spark, clean)
    _publish(spark, dirty, lambda n: n.withColumn(
        "n_regionkey", F.when(F.col("n_nationkey") == 3, F.lit(99)).otherwise(F.col("n_regionkey"))))
    assert validate_job.main([clean]) == 0
    assert validate_job.main([dirty]) == 1
    assert validate_job.main([dirty, "--expect", "nation.n_regionkey -> region.r_regionkey=1:known bad row"]) == 0
