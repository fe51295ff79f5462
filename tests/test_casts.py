import pytest
from pyspark.sql import functions as F

from kempt.functions import casts


def col_values(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r["r"] for r in df.select(expr(F.col("v")).alias("r")).collect()]


def test_long_keys_are_exact(spark):
    values = ["9007199254740993", "-9223372036854775808", "9007199254740993.9", " 7 ", "99999999999999999999"]
    expected = [9007199254740993, -9223372036854775808, 9007199254740993, 7, None]
    assert col_values(spark, values, lambda c: casts.lenient_int(c, "bigint")) == expected
    assert col_values(spark, values[:4], lambda c: casts.strict_int(c, "bigint")) == expected[:4]
    assert col_values(spark, values, casts.nullable_long) == expected


def test_only_decimal_numbers_are_numbers(spark):
    values = ["12d", "3f", "NaN", "Infinity", "0x10", "1_000", ".", "+", "1e", "--1"]
    assert col_values(spark, values, lambda c: casts.lenient_int(c, "bigint")) == [None] * len(values)
    assert col_values(spark, values, casts.lenient_decimal) == [None] * len(values)
    assert col_values(spark, ["1e3", ".5", "5.", "+4", "-2.9"], casts.lenient_int) == [1000, 0, 5, 4, -2]


def test_lenient_int_through_double(spark):
    got = col_values(spark, ["299.0", "2.7", "", "abc", None, "12"], casts.lenient_int)
    assert got == [299, 2, None, None, None, 12]


def test_lenient_int_overflow_is_null(spark):
    assert col_values(spark, ["1e12"], casts.lenient_int) == [None]
    assert col_values(spark, ["1e12"], lambda c: casts.lenient_int(c, "bigint")) == [1000000000000]


def test_strict_int_raises_on_bad_text(spark):
    with pytest.raises(Exception):
        col_values(spark, ["abc"], casts.strict_int)


def test_lenient_decimal(spark):
    from decimal import Decimal
    got = col_values(spark, ["12.345", "", "n/a", "1e9"], casts.lenient_decimal)
    assert got == [Decimal("12.35"), None, None, None]


def test_cast_failed_counts_only_lost_text(spark):
    df = spark.createDataFrame([(v,) for v in ["1", "", None, "x", "  "]], "v string")
    got = df.select(casts.cast_failed(F.col("v"), casts.lenient_int("v")).alias("f")).collect()
    assert [r["f"] for r in got] == [False, False, False, True, False]
