"""Narrow tables of ids are written in few files, however many partitions a shuffle has."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kempt.llm import common
from kempt.llm.components import connected_components


@pytest.fixture()
def many_partitions(spark):
    settings = {"spark.sql.shuffle.partitions": "90", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield 2 * spark.sparkContext.defaultParallelism
    for k, v in before.items():
        spark.conf.set(k, v)


def test_components_write_few_files(spark, many_partitions, monkeypatch):
    written = []
    paths = common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda *args: written.append(paths(*args)) or written[-1])
    edges = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 10).alias("b"))
    roots = connected_components(edges)
    assert [tuple(r) for r in roots.orderBy("node").collect()] == [(k, k - k % 10) for k in range(3000)]
    files = [sum(f.endswith(".parquet") for f in os.listdir(path.removeprefix("file:"))) for path in written]
    assert len(files) > 1 and 0 < max(files) <= many_partitions < 90


def test_few_files_hold_every_row(spark, many_partitions):
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))
    few, all_files = common.materialise(rows, "few", few=True), common.materialise(rows, "all")
    assert len(few.inputFiles()) <= many_partitions < len(all_files.inputFiles())
    assert sorted(few.collect()) == sorted(all_files.collect()) and few.count() == 700


def test_tasks_leave_no_tables():
    def run(batches):
        yield from (common.span_hashes(b, np.array([0]), np.array([len(b)])) for b in batches)

    data = np.arange(200, dtype=np.uint8)
    first, second = (list(common.task(run)(iter([data, data]))) for _ in range(2))
    assert first[0] == first[1] == second[0] and sum(p.nbytes for p in common._powers) < 100
