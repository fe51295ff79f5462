from kempt.session import ensure_parallelism, scratch_path, shared_dir


def test_ensure_parallelism_is_a_no_op_for_partitioned_inputs(spark):
    want = spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, numPartitions=want * 2)
    assert ensure_parallelism(wide) is wide                     # enough splits: untouched, no shuffle
    narrow = spark.range(0, 1000, numPartitions=1)
    spread = ensure_parallelism(narrow)
    assert spread.rdd.getNumPartitions() == want and spread.count() == 1000


def test_scratch_paths_live_under_the_shared_folder(spark):
    root = shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b
