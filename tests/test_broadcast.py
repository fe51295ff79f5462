from kempt.operators import broadcast


def _is_broadcast(df):
    return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_measure_fixed_and_variable_width(spark):
    fixed = spark.createDataFrame([(1, 2), (3, 4)], "a long, b long")
    assert broadcast.fixed_row_bytes(fixed.schema) == 8 + 8 + broadcast.ROW_OVERHEAD_BYTES
    assert broadcast.measure(fixed) == (2, 2 * (16 + broadcast.ROW_OVERHEAD_BYTES))
    var = spark.createDataFrame([(1, "abc"), (2, None), (3, "é")], "a long, s string")
    rows, nbytes = broadcast.measure(var)
    assert rows == 3 and nbytes == 3 * (8 + broadcast.ROW_OVERHEAD_BYTES + 8) + 3 + 0 + 2


def test_size_checked_broadcast_respects_byte_bound(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "a long, s string")
    small, n = broadcast.size_checked_broadcast(df)
    big, _ = broadcast.size_checked_broadcast(df, max_bytes=1000)
    assert n == 50 and _is_broadcast(small) and not _is_broadcast(big)
    assert _is_broadcast(broadcast.bounded_by_rows(spark.range(10), 10))
    assert not _is_broadcast(broadcast.bounded_by_rows(spark.range(10), 10, max_rows=5))
