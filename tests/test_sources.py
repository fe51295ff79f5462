import os
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from kempt.model import TableSpec
from kempt.sources import delimited, snapshot

MED = TableSpec("medicine",
                T.StructType([T.StructField("Brand_ID", T.IntegerType(), False),
                              T.StructField("Brand_Name", T.StringType(), True),
                              T.StructField("Generic_ID", T.IntegerType(), True),
                              T.StructField("Unit_Price", T.DecimalType(10, 2), True)]),
                ("Brand_ID",))


def write(path, text):
    with open(path, "w", encoding="utf-8-sig") as f:  # BOM, as the exporter writes
        f.write(text)


def test_staged_lenient_load(spark, scratch):
    p = os.path.join(scratch, "medicine.csv")
    write(p, 'Brand_ID,Brand_Name,Generic_ID,Unit_Price\n1,"Napa, 500",299.0,12.5\n2,Ace,,\n3,Xyz,abc,n/a\n')
    df = delimited.read_staged(spark, p, MED, {"Generic_ID": "int", "Unit_Price": "decimal"})
    got = {r["Brand_ID"]: (r["Brand_Name"], r["Generic_ID"], r["Unit_Price"]) for r in df.collect()}
    assert got == {1: ("Napa, 500", 299, Decimal("12.50")), 2: ("Ace", None, None), 3: ("Xyz", None, None)}
    raw = delimited.read_delimited(spark, p, MED.staging_schema(["Generic_ID", "Unit_Price"]))
    from kempt.functions import casts
    fails = delimited.cast_failures(raw, {"Generic_ID": casts.lenient_int("Generic_ID"),
                                          "Unit_Price": casts.lenient_decimal("Unit_Price")}).first().asDict()
    assert fails == {"failed_Generic_ID": 1, "failed_Unit_Price": 1}


def test_strict_load_fails_fast(spark, scratch):
    p = os.path.join(scratch, "bad.csv")
    write(p, "Brand_ID,Brand_Name,Generic_ID,Unit_Price\nx,Ace,1,1.0\n")
    with pytest.raises(Exception):
        delimited.read_delimited(spark, p, MED.schema).collect()


def test_export_and_snapshot_round_trip(spark, scratch):
    df = spark.createDataFrame([(2, "b", 1.0), (1, "a", None)], "id long, nm string, v double")
    n = snapshot.export_csv(df, os.path.join(scratch, "csv"), ["id"], integer_columns=["id"])
    assert n == 2
    back = delimited.read_delimited(spark, os.path.join(scratch, "csv"),
                                    T.StructType.fromJson(df.schema.jsonValue()))
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a", None), (2, "b", 1.0)]
    counts = snapshot.write_snapshot({"t": df, "u": df.limit(1)}, os.path.join(scratch, "snap"))
    assert counts == {"t": 2, "u": 1}
    assert sorted(snapshot.read_snapshot(spark, os.path.join(scratch, "snap"))) == ["t", "u"]
    # a table folder without a manifest is not a published snapshot
    df.write.parquet(os.path.join(scratch, "partial", "t"))
    with pytest.raises(FileNotFoundError):
        snapshot.read_snapshot(spark, os.path.join(scratch, "partial"), ["t"])
    with pytest.raises(Exception):  # a published snapshot is never overwritten
        snapshot.write_snapshot({"t": df}, os.path.join(scratch, "snap"))
