"""The stateless layer (column builders, apply_rules) runs unchanged on a stream."""

import os

from pyspark.sql import functions as F

from paths import SF001
from kempt.functions import text
from kempt.operators import rules


def test_repair_rules_on_a_stream_match_batch(spark, scratch):
    schema = spark.read.parquet(f"{SF001}/documents.parquet").schema
    rs = [rules.Rule("mojibake", "text", text.repair_mojibake),
          rules.Rule("collapse", "text", text.collapse_spaces, lambda c: c.contains("  "))]

    def shape(df):
        dirty = df.select("doc_id", F.concat(F.col("text"), F.lit(" Doctorâ€™s  note")).alias("text"))
        return rules.apply_rules(dirty, rs).select("doc_id", F.xxhash64("text").alias("h"))

    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "documents.parquet")
              .option("maxFilesPerTrigger", 1).parquet(SF001))
    q = (shape(stream).writeStream.format("memory").queryName("repaired_docs").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(tuple(r) for r in spark.table("repaired_docs").collect())
    want = sorted(tuple(r) for r in shape(spark.read.parquet(f"{SF001}/documents.parquet")).collect())
    assert got == want and len(got) > 0
