"""Training over all rows: shards learn side by side from one start, and their changes are averaged.

A start model comes from a bounded sample, in one task.  Then every row is
learned from once: each partition of the rows trains a copy of the start on
its own rows, and Spark adds up the changes in two levels, so that neither the
driver nor a task holds more than a few models.  A shard sends the parameter
rows that it has learnt, and no others.  Calibrations are fitted on
counts of all rows held back, grouped to a fixed number of cells.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm import common

#: One row in so many is held back from training, by the hash of its key.
HELD_BACK = 4
_SLICE = 4096
_CHANGES = "name string, at int, shard long, rows binary, change binary, weight binary"
_NAMES = [c.split()[0] for c in _CHANGES.split(", ")]


def held_back(key: str):
    """Whether a row is kept out of training, for the calibration."""
    return F.pmod(F.xxhash64(F.lit("held back"), F.col(key).cast("string")), F.lit(HELD_BACK)) == 0


def _added(table: pa.Table) -> pa.Table:
    """The sum of changes and weights, added in the order of the shards."""
    order = np.argsort(table["shard"].to_numpy(), kind="stable").tolist()
    own = [np.frombuffer(r.as_py(), np.int32) for r in table["rows"]]
    rows = np.unique(np.concatenate(own))
    weight = np.zeros(len(rows))
    change = np.zeros((len(rows), len(table["change"][0].as_py()) // 8 // len(own[0])))
    for i in order:
        at = np.searchsorted(rows, own[i])
        weight[at] += np.frombuffer(table["weight"][i].as_py())
        change[at] += np.frombuffer(table["change"][i].as_py()).reshape(len(at), -1)
    return pa.table({"name": table["name"][:1], "at": table["at"][:1], "shard": table["shard"].take(pa.array(order[:1])),
                     **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (("rows", rows), ("change", change), ("weight", weight))}})


def _changes(rows: DataFrame, start: dict[str, np.ndarray],
             learn: Callable[[dict[str, np.ndarray], pa.Table], dict[str, np.ndarray]]) -> DataFrame:
    """What every partition of ``rows`` has changed, times its weight: the weighed rows of the parameters, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        params = {k: v.copy() for k, v in start.items()}
        weights = learn(params, pa.Table.from_batches(own))
        shard = TaskContext.get().partitionId()
        for name, value in params.items():
            weight = np.asarray(weights[name], np.float64)
            for at in range(0, len(value), _SLICE):
                there = np.flatnonzero(weight[at:at + _SLICE])
                if not len(there):
                    continue
                change = (value[at + there] - start[name][at + there]).astype(np.float64).reshape(len(there), -1) * weight[at + there][:, None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([at], pa.int32()), pa.array([shard], pa.int64()),
                     *[pa.array([v.tobytes()], pa.binary()) for v in (there.astype(np.int32), change, weight[at + there])]], names=_NAMES)

    return rows.mapInArrow(common.task(run), _CHANGES)


def over_shards(rows: DataFrame, shards: int, start: dict[str, np.ndarray],
                learn: Callable[[dict[str, np.ndarray], pa.Table], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """``start`` moved by the weighted mean of what every partition of ``rows`` has changed.

    ``learn`` trains the given copy on the rows of one partition, in place, and
    returns weights by parameter name: one for each of its rows.  A row of a
    parameter moves by the mean over the shards that weigh it.
    """
    # a shuffle may deal the rows to more partitions than were asked for
    most = max(shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fan = max(math.isqrt(most), 1)
    changes = _changes(rows, start, learn).groupBy("name", "at", F.pmod("shard", F.lit(fan)).alias("part")).applyInArrow(_added, _CHANGES)
    out = {k: v.copy() for k, v in start.items()}
    for r in changes.groupBy("name", "at").applyInArrow(_added, _CHANGES).collect():  # one model, whatever the rows
        weight = np.frombuffer(bytes(r.weight))
        change = np.frombuffer(bytes(r.change)).reshape(len(weight), -1) / np.maximum(weight, 1e-300)[:, None]
        target = out[r["name"]].reshape(len(out[r["name"]]), -1)
        target[r["at"] + np.frombuffer(bytes(r["rows"]), np.int32)] += np.where(weight[:, None] > 0, change, 0).astype(target.dtype)
    return out


def cells(stats: DataFrame, columns: list[str], label: str, per_unit: int, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean of the columns, label, rows) of every cell of ``1 / per_unit`` between -limit and limit: all rows, in a bounded number of cells.

    Sums are of integers, so they do not depend on the order of the rows.
    """
    clipped = stats.select(F.col(label).cast("int").alias("_y"), *[
        F.greatest(F.least(F.col(c), F.lit(limit)), F.lit(-limit)).alias(f"_{i}") for i, c in enumerate(columns)])
    found = (clipped.groupBy("_y", *[F.floor(F.col(f"_{i}") * per_unit).alias(f"_c{i}") for i in range(len(columns))])
             .agg(F.count("*").alias("_n"), *[F.sum(F.round(F.col(f"_{i}") * (1 << 20)).cast("long")).alias(f"_s{i}") for i in range(len(columns))])
             .collect())
    found = sorted(tuple(r) for r in found)
    n = len(columns)
    count = np.array([r[n + 1] for r in found], np.float64)
    means = np.array([r[n + 2:] for r in found], np.float64).reshape(len(found), n) / (1 << 20) / np.maximum(count, 1)[:, None]
    return means, np.array([r[0] for r in found], np.int64), count
