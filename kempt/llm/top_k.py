"""Exact top-k by inner product: vectors by descending length, rotated partial sums, Cauchy-Schwarz residual bounds.

Components become integers, floor(scale * x), and scores are integer inner
products.  The rotation comes from the singular vectors of the whole table
(from its d x d sums of products), so that the first coordinates hold most of
every vector's length.  For a query q and a vector x, cut after h coordinates,

    q.x  <=  (sum of the first h products)  +  |rest of q| * |rest of x|

and with h = 0 this is |q| |x|.  Each task reads its rows longest first, in
batches.  Queries whose k-th score the longest row of a batch cannot reach skip
the batch; of the others, pairs go on from cut to cut while their bound reaches
the query's k-th score, and those left are scored exactly in integers.  The
first k-th scores come from the longest rows of the table.  Bounds carry a
margin far above the rounding error, so no pair is lost.

Queries are taken in blocks of a fixed number of bytes, each broadcast to one
pass over all rows; a task returns at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm.common import materialise
from kempt.session import scratch_path

_NO_ID = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min
_EXACT = float(1 << 53)


def _prepare(scale: int):
    """(rid, id, query, vector) to integer vectors with their lengths; vectors that take no part are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values, lengths = [], [], []
            for i, v in enumerate(batch.column(3)):
                if not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(np.clip(scale * x, -2.0 ** 62, 2.0 ** 62)).astype(np.int64)
                kept.append(i)
                values.append(x.tobytes())
                lengths.append(float(np.sqrt((x.astype(np.float64) ** 2).sum())))
            taken = batch.select([0, 1, 2]).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(lengths, pa.float64()), pa.array(values, pa.binary())],
                                             names=["rid", "id", "query", "length", "vector"])

    return run


def _matrix(column, d: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    raw = [np.frombuffer(v, np.int64) for v in column.to_pylist()]
    out = np.zeros((len(raw), d), np.int64)
    for i, v in enumerate(raw):
        out[i, :len(v)] = v
    return out


def _products(d: int):
    """Each task's sums of products, one row a coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d).astype(np.float64)
            total += x.T @ x
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "s"])

    return run


def rotation(table: DataFrame, d: int) -> np.ndarray:
    """Right singular vectors of the table, strongest first, from sums over all rows."""
    sums = (table.select("vector").mapInArrow(_products(d), "i int, j int, s double").groupBy("i", "j")
            .agg(F.sum("s").alias("s")).toArrow())  # d * (d + 1) / 2 rows
    g = np.zeros((d, d))
    i, j = sums["i"].to_numpy(), sums["j"].to_numpy()
    g[i, j] = g[j, i] = sums["s"].to_numpy()
    if not np.isfinite(g).all() or not g.any():
        return np.eye(d)
    return np.linalg.eigh(g / np.abs(g).max())[1][:, ::-1].copy()


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of q with all rows of x."""
    if len(q) and len(x) and float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < _EXACT:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)  # every partial sum is exact
    return q @ x.T


def _first_bounds(seeds, d: int, k: int):
    """Queries with the k-th score that they reach among the longest rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, vectors = seeds.value
        for batch in batches:
            own = batch.column(0).to_numpy()
            scores = exact_scores(_matrix(batch.column(2), d), vectors)
            scores[own[:, None] == rid[None, :]] = _LEAST
            least = np.partition(scores, len(rid) - k, axis=1)[:, len(rid) - k] if len(rid) >= k else np.full(len(own), _LEAST)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=["rid", "id", "vector", "least"])

    return run


class Search:
    """The best k of the rows seen so far for a block of queries."""

    def __init__(self, rid: np.ndarray, vectors: np.ndarray, least: np.ndarray, axes: np.ndarray, k: int):
        n, d = vectors.shape
        self.rid, self.vectors, self.axes, self.k = rid, vectors, axes, k
        self.least = least
        self.bound = least.astype(np.float64)  # scores below are out
        self.bound[least == _LEAST] = -np.inf
        self.rotated = vectors.astype(np.float64) @ axes
        self.cuts = sorted({max(1, d // 8), max(1, d // 2)})
        self.rests = self._rests(self.rotated)
        self.lengths = np.sqrt((self.rotated ** 2).sum(1))
        self.score = np.full((n, k), _LEAST)
        self.id = np.full((n, k), _NO_ID)
        self.filled = np.zeros((n, k), bool)

    def _rests(self, rotated: np.ndarray) -> list[np.ndarray]:
        return [np.sqrt((rotated[:, h:] ** 2).sum(1)) for h in self.cuts]

    def add(self, rid: np.ndarray, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, block: int = 1024) -> int:
        """One batch of rows; returns the pairs that were scored exactly."""
        longest = float(lengths.max(initial=0.0))
        margin = 1e-9 * self.lengths * longest + 1e-6
        active = np.flatnonzero(self.lengths * longest + margin >= self.bound)
        if not len(active) or not len(rid):
            return 0
        rotated = vectors.astype(np.float64) @ self.axes
        rests = self._rests(rotated)
        scored = 0
        for start in range(0, len(active), block):
            at = active[start:start + block]
            sums = np.zeros((len(at), len(rid)))
            low = 0
            alive = np.ones(sums.shape, bool)
            for h, rest_q, rest_x in zip(self.cuts, self.rests, rests):
                sums += self.rotated[at, low:h] @ rotated[:, low:h].T
                low = h
                alive = sums + rest_q[at, None] * rest_x[None, :] + margin[at, None] >= self.bound[at, None]
                if not alive.any():
                    break
            qi, xi = np.nonzero(alive)
            scored += len(qi)
            if not len(qi):
                continue
            if len(qi) * 16 > alive.size:
                scores = exact_scores(self.vectors[at], vectors)[qi, xi]
            else:
                scores = np.concatenate([(self.vectors[at[qi[i:i + 16384]]] * vectors[xi[i:i + 16384]]).sum(1)
                                         for i in range(0, len(qi), 16384)])
            own = at[qi]
            worst, worst_id = self.score[own, -1], self.id[own, -1]
            good = (self.rid[own] != rid[xi]) & (scores >= self.least[own]) & (
                ~self.filled[own, -1] | (scores > worst) | ((scores == worst) & (ids[xi] < worst_id)))
            if good.any():
                self._merge(own[good], scores[good], ids[xi[good]])
        return scored

    def _merge(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(q)
        row, col = np.nonzero(self.filled[touched])
        old = touched[row]
        q = np.concatenate([q, old])
        scores = np.concatenate([scores, self.score[old, col]])
        ids = np.concatenate([ids, self.id[old, col]])
        order = np.lexsort((ids, ~scores, q))  # ~score: descending without overflow
        q, scores, ids = q[order], scores[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        q, place = q[keep], place[keep]
        self.score[q, place], self.id[q, place], self.filled[q, place] = scores[keep], ids[keep], True
        full = touched[self.filled[touched, -1]]
        self.bound[full] = np.maximum(self.bound[full], self.score[full, -1].astype(np.float64) * (1 - 1e-12) - 1e-6)


def _search(block, axes: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, vectors, least = block.value
        search = Search(rid, vectors, least, axes, k)
        for batch in batches:
            ids = batch.column(1).fill_null(_NO_ID).to_numpy()
            search.add(batch.column(0).to_numpy(), ids, _matrix(batch.column(3), vectors.shape[1]), batch.column(2).to_numpy())
        q, place = np.nonzero(search.filled)
        yield pa.RecordBatch.from_arrays([pa.array(rid[q]), pa.array(search.score[q, place]), pa.array(search.id[q, place])],
                                         names=["rid", "score", "id"])

    return run


_RESULT = "query_id long, rank int, vec_id long, score long"


def top_k(rows: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024,
          seeds: int = 2048, block_bytes: int = 1 << 25) -> DataFrame:
    """Each query row's k best other rows: (query_id, rank from 1, vec_id, score), ties to the smaller id.

    ``is_query`` picks the queries among the rows.  Vectors that are NULL or
    hold NULL, NaN or infinite components take no part; shorter vectors end in
    zeros, an empty one scores 0.  Repeated rows are rows of their own, also
    where ids repeat: a query skips its own row only.  A NULL id comes last
    among ties and names no query's row but NULL.  Scores are exact below 2^63
    and wrap beyond.  With no query or one row there are no results; further
    columns are not read.  ``block_bytes`` bounds the queries of one broadcast
    and ``seeds`` the rows of the first bounds.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = rows.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"),
                        F.coalesce(is_query, F.lit(False)).alias("query"), F.col(vector_col).alias("vector"))
    prepared = plain.mapInArrow(_prepare(scale), "rid long, id long, query boolean, length double, vector binary")
    # dealt evenly, so that every task has long rows to start with
    table = materialise(prepared.repartition(n, "rid").sortWithinPartitions(F.desc("length"), "rid"), "vectors")
    d, n_queries = table.agg(F.max(F.length("vector") / 8).cast("int"), F.count_if("query")).first()
    path = scratch_path(spark, "top-k")
    if n_queries:
        d = max(d, 1)
        axes = rotation(table, d)
        longest = table.orderBy(F.desc("length"), "rid").limit(seeds).select("rid", "vector").toArrow()
        first = spark.sparkContext.broadcast((longest["rid"].to_numpy(), _matrix(longest["vector"], d)))
        queries = table.where("query").select("rid", "id", "vector")
        bounded = materialise(queries.mapInArrow(_first_bounds(first, d, k), "rid long, id long, vector binary, least long"), "queries")
        blocks = -(-n_queries * 8 * d // block_bytes)
        best = Window.partitionBy("rid").orderBy(F.desc("score"), "id")
        for b in range(blocks):
            own = bounded.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == b).toArrow()  # about block_bytes
            sent = spark.sparkContext.broadcast((own["rid"].to_numpy(), _matrix(own["vector"], d), own["least"].to_numpy()))
            found = (table.select("rid", "id", "length", "vector").mapInArrow(_search(sent, axes, k), "rid long, score long, id long")
                     .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
            named = found.join(bounded.select("rid", F.col("id").alias("query_id")), "rid")
            (named.select("query_id", "rank", F.expr(f"nullif(id, {_NO_ID})").alias("vec_id"), "score").write.mode("append").parquet(path))
            sent.destroy()
    else:
        spark.createDataFrame([], _RESULT).write.parquet(path)
    return spark.read.schema(_RESULT).parquet(path)
