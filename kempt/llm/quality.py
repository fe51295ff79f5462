"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Every whole text is reduced to fixed statistics (shares of character kinds,
word shapes, repetition of words, phrases and lines, lengths), each
transformed to be roughly symmetric.  Class means and covariances are sums
over all labelled rows, added up by Spark; each covariance is shrunk towards
the pooled one and towards a multiple of the identity.  The score is the logistic of the difference of the log densities,
whose Mahalanobis distances come from the classes' Cholesky factors, computed
once.

NULL texts are empty and have the statistics of an empty text.  If a label has
fewer than two rows, every score is the share of label 1 (0.5 without labels).
Repeated rows are scored alike.  Statistics cover texts of any length; a score
of exactly 0.5 predicts 1; an empty table gives no rows; further columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm import common

_KINDS = {"upper": range(65, 91), "digit": range(48, 58), "space": (32, 9), "line": (10,), "pause": (44, 46, 58, 59),
          "shout": (33, 63), "symbol": (*range(35, 39), 42, 43, 60, 61, 62, 64, 94, 126), "bar": (124,),
          "mark": (34, 39, 40, 41, 45, 47, 91, 92, 93, 95, 96, 123, 125), "wide": range(128, 256)}
_KIND = np.full(256, len(_KINDS), np.uint8)
for _i, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes)] = _i

NAMES = [*_KINDS, "log_bytes", "word_length", "distinct_words", "distinct_phrases", "distinct_lines", "upper_words",
         "marked_words", "top_word", "short_words"]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log of a share, with half a case added to either side."""
    return np.log((part + 0.5) / (whole + 1.0))


def _distinct(row: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of every row and the count of its most frequent one; ``row`` ascends."""
    if not len(key):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((key, row))
    r, k = row[order], key[order]
    cut = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])]))
    most = np.zeros(n)
    np.maximum.at(most, r[cut], np.diff(np.append(cut, len(r))))
    return np.bincount(r[cut], minlength=n).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, NAMES) transformed statistics of every text."""
    n, sizes = len(offsets) - 1, np.diff(offsets).astype(float)
    kind = _KIND[data]
    out = []
    for i in range(len(_KINDS)):
        total = np.concatenate([[0], np.cumsum(kind == i, dtype=np.int64)])
        out.append(_share(total[offsets[1:]] - total[offsets[:-1]], sizes))
    lower = common.LOWER[data]
    starts, ends, first = common.words(lower, offsets)
    n_words = np.diff(first).astype(float)
    row = np.repeat(np.arange(n), np.diff(first))
    h = common.span_hashes(lower, starts, ends)
    distinct, most = _distinct(row, h, n)
    phrase = common.mix64(h[:-2] * np.uint64(3) + common.mix64(h[1:-1] * np.uint64(5) + common.mix64(h[2:]))) if len(h) > 2 else h[:0]
    inside = row[2:] == row[:-2] if len(h) > 2 else np.zeros(0, bool)
    phrases, _ = _distinct(row[2:][inside] if len(h) > 2 else row[:0], phrase[inside], n)
    line_starts, line_ends = common.runs(data != 10, offsets)
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    lines, _ = _distinct(line_row, common.span_hashes(data, line_starts, line_ends), n)
    n_lines = np.bincount(line_row, minlength=n).astype(float)
    upper = np.concatenate([[0], np.cumsum(kind == 0, dtype=np.int64)])
    shouted = (upper[ends] - upper[starts] >= 2)
    marked = np.isin(kind[ends - 1], [list(_KINDS).index(k) for k in ("symbol", "bar", "shout")]) if len(ends) else np.zeros(0, bool)
    by_row = lambda flag: np.bincount(row, weights=flag, minlength=n)
    out += [np.log1p(sizes), np.log1p(by_row(ends - starts) / np.maximum(n_words, 1)),
            _share(distinct, n_words), _share(phrases, np.maximum(n_words - 2, 0)), _share(lines, n_lines), _share(by_row(shouted), n_words),
            _share(by_row(marked), n_words), _share(most, n_words), _share(by_row(ends - starts <= 3), n_words)]
    return np.column_stack(out)


def statistics_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one column for each of NAMES) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch):
                x = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), *[pa.array(c) for c in x.T]],
                                                 names=["id", *NAMES])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, " + ", ".join(f"{n} double" for n in NAMES)).withColumnRenamed("id", id_col)


def fit(labelled: DataFrame, label_col: str = "quality", *, shrink: float = 0.3, ridge: float = 0.05) -> dict:
    """The discriminant of a statistics table with 0/1 labels; sums over all its rows."""
    pairs = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]
    sums = (labelled.where(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).alias("label"))
            .agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(NAMES)],
                 *[F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect())
    by_label = {r["label"]: r for r in sums}
    counts = {k: by_label[k]["n"] if k in by_label else 0 for k in (0, 1)}
    total = sum(counts.values())
    if min(counts.values()) < 2:
        return {"share": counts[1] / total if total else 0.5}
    means, covariances = {}, {}
    for k, r in by_label.items():
        mean = np.array([r[f"s{i}"] for i in range(len(NAMES))]) / r["n"]
        second = np.zeros((len(NAMES), len(NAMES)))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r["n"]
        means[k], covariances[k] = mean, second - np.outer(mean, mean)
    pooled = sum(covariances[k] * counts[k] for k in (0, 1)) / total
    spread = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    model = {"share": counts[1] / total, "spread": spread}
    for k in (0, 1):
        own = ((1 - shrink) * covariances[k] + shrink * pooled) / np.outer(spread, spread)
        own += ridge * max(np.trace(own) / len(NAMES), 1e-3) * np.eye(len(NAMES))
        factor = np.linalg.cholesky(own)
        model[k] = {"mean": means[k] / spread, "whiten": np.linalg.inv(factor),
                    "constant": np.log(counts[k] / total) - np.log(np.diag(factor)).sum()}
    return model


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 of every row of statistics."""
    if "spread" not in model:
        return np.full(len(x), model["share"])
    log_density = [model[k]["constant"] - 0.5 * (((x / model["spread"] - model[k]["mean"]) @ model[k]["whiten"].T) ** 2).sum(axis=1)
                   for k in (0, 1)]
    return 1 / (1 + np.exp(-np.clip(log_density[1] - log_density[0], -30, 30)))


def predict(table: DataFrame, model: dict, *, id_col: str = "doc_id") -> DataFrame:
    """One row per row of a statistics table: id, score, predicted (1 if score >= 0.5)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = score(model, np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(NAMES))])
                          if len(batch) else np.zeros((0, len(NAMES))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                                             names=["id", "score", "predicted"])

    rows = table.select(F.col(id_col).alias("id"), *NAMES)
    return rows.mapInArrow(run, "id long, score double, predicted int").withColumnRenamed("id", id_col)
