"""CSV export with a byte-order mark: once, in order, and one file a part whatever is retried."""

import csv
import glob
import io
import os

from pyspark.sql import functions as F

from kempt.sources import marked_csv


def joined(path):
    parts = sorted(glob.glob(f"{path}/part-*.csv"))
    return b"".join(open(p, "rb").read() for p in parts), parts


def test_mark_once_and_rows_in_order(spark, scratch):
    df = spark.range(5000).select((4999 - F.col("id")).alias("id"), F.when(F.col("id") % 3 == 0, 'a "q", b').when(
        F.col("id") % 3 == 1, "").alias("t"), (F.col("id") / 4).alias("v")).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marked_csv.export_marked_csv(df, f"{scratch}/out", ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    data, parts = joined(f"{scratch}/out")
    assert len(parts) > 1 and data.startswith(b"\xef\xbb\xbf") and data.count(b"\xef\xbb\xbf") == 1 and data.count(b"id,t,v") == 1
    rows = list(csv.reader(io.StringIO(data.decode("utf-8-sig"))))
    assert [int(r[0]) for r in rows[1:]] == list(range(5000))
    assert {r[1] for r in rows[1:]} == {'a "q", b', ""} and rows[1][2] == "1249.75"
    assert sorted(os.listdir(f"{scratch}/out"))[0] == "_SUCCESS" and not os.path.exists(f"{scratch}/out/_attempts")


def test_empty_table_has_mark_and_header(spark, scratch):
    marked_csv.export_marked_csv(spark.createDataFrame([], "id long, t string"), f"{scratch}/none", ["id"])
    assert joined(f"{scratch}/none")[0] == b"\xef\xbb\xbfid,t\n"


def test_spark_reads_it_back(spark, scratch):
    df = spark.createDataFrame([(1, "naïve", None), (2, None, 2.5), (3, " edge ", 0.0), (4, "a\rb", 1.0), (5, "", 1e300)], "id long, t string, v double")
    marked_csv.export_marked_csv(df, f"{scratch}/out", ["id"])
    data, _ = joined(f"{scratch}/out")
    with open(f"{scratch}/one.csv", "wb") as f:
        f.write(data)
    back = spark.read.csv(f"{scratch}/one.csv", header=True, schema=df.schema, escape='"', nullValue="", emptyValue="", multiLine=True, lineSep="\n")
    assert [(r.id, r.t, r.v) for r in back.orderBy("id").collect() if r.id < 5] == [(1, "naïve", None), (2, None, 2.5), (3, " edge ", 0.0), (4, "a\rb", 1.0)]


def test_attempts_that_failed_leave_nothing(spark, scratch):
    writer = marked_csv.MarkedCsvWriter(f"{scratch}/out", ["id"])
    from pyarrow import fs

    local = fs.LocalFileSystem()
    local.create_dir(f"{scratch}/out/_attempts", recursive=True)
    for name, text in (("part-00000-lost", b"half"), ("part-00000-kept", writer._head() + b"1\n"), ("part-00001-kept", b"2\n"), ("part-00001-twin", b"2\n")):
        with local.open_output_stream(f"{scratch}/out/_attempts/{name}") as f:
            f.write(text)
    writer.commit([marked_csv.Written(1, "part-00001-kept", 1), None, marked_csv.Written(0, "part-00000-kept", 1)])
    assert joined(f"{scratch}/out")[0] == b"\xef\xbb\xbfid\n1\n2\n" and len(os.listdir(f"{scratch}/out")) == 3


def test_a_failing_job_publishes_nothing(spark, scratch):
    bad = spark.range(100).select("id", F.when(F.col("id") == 60, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).cast("string").alias("t"))
    try:
        marked_csv.export_marked_csv(bad, f"{scratch}/bad", ["id"])
    except Exception:  # noqa: BLE001
        pass
    else:
        raise AssertionError("the job should fail")
    assert not glob.glob(f"{scratch}/bad/part-*") and not os.path.exists(f"{scratch}/bad/_SUCCESS")
