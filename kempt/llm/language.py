"""Language ID: a bidirectional gated recurrent network over bytes labels every position; documents pool them.

Whole texts are cut into segments of 64 bytes.  The network reads each segment
in both directions and gives every byte a distribution over the languages; a
document's probabilities are the mean over all its bytes.  It is trained by
backpropagation through time on segments of a bounded, hash-chosen sample of
the labelled rows of each language.

A NULL text or one without a letter is ``und`` with score 0; so is every text
where there is nothing to learn from.  Ties go to the language that sorts
first; repeated rows are scored alike.  Texts of any length are read whole; an
empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm import common, gru

SEGMENT = 64
_PAD = 256
_LETTER = regex.compile(r"\p{L}")  # letters alone: no digits, fractions or number signs


def segments(data: np.ndarray, offsets: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(symbols (segments, segment), row of each segment); every byte is in exactly one segment."""
    sizes = np.diff(offsets)
    counts = -(-sizes // segment)
    row = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (offsets[:-1][row] + within * segment)[:, None] + np.arange(segment)
    inside = at < offsets[1:][row][:, None]
    symbols = np.full(at.shape, _PAD, np.int16)
    symbols[inside] = data[at[inside]]
    return symbols, row


def _logits(p: dict[str, np.ndarray], symbols: np.ndarray, keep: bool = False):
    """Logits of every position, time-major; with ``keep`` what training needs."""
    steps = np.ascontiguousarray(symbols.T)
    f = gru.forward(p["xf"][steps], p["uf"], None, False, keep)
    b = gru.forward(p["xb"][steps], p["ub"], None, True, keep)
    hf, hb = (f[0], b[0]) if keep else (f, b)
    h = p["uf"].shape[0]
    out = hf.reshape(-1, h) @ p["out"][:h] + hb.reshape(-1, h) @ p["out"][h:] + p["bias"]
    return (out, steps, f, b) if keep else out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], *, hidden: int = 8, per_text: int = 4, epochs: int = 6,
          min_steps: int = 150, batch: int = 512, rate: float = 0.01, seed: int = 5) -> dict:
    """A model from labelled texts: parameters and the sorted language names."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    number = {name: i for i, name in enumerate(names)}
    chosen, target = [], []
    for text, label in zip(texts, labels):
        data = np.frombuffer(text, np.uint8)
        symbols, _ = segments(data, np.array([0, len(data)]))
        pick = rng.permutation(len(symbols))[:per_text]
        chosen.append(symbols[pick])
        target.append(np.full(len(pick), number[label]))
    x, y = np.concatenate(chosen), np.concatenate(target)
    k = len(names)
    p = {"xf": (0.3 * rng.standard_normal((257, 3 * hidden))).astype(np.float32), "uf": gru.init(rng, hidden),
         "xb": (0.3 * rng.standard_normal((257, 3 * hidden))).astype(np.float32), "ub": gru.init(rng, hidden),
         "out": (0.3 * rng.standard_normal((2 * hidden, k))).astype(np.float32), "bias": np.zeros(k, np.float32)}
    weight = (len(y) / (k * np.maximum(np.bincount(y, minlength=k), 1))).astype(np.float32)  # balanced languages
    adam = gru.Adam(p, rate)
    epochs = max(epochs, -(-min_steps * batch // max(len(x), 1)))
    for epoch in range(epochs):
        adam.rate = rate * (1 - 0.9 * epoch / epochs)
        order = rng.permutation(len(x))
        for i in range(0, len(order), batch):
            own = order[i:i + batch]
            logits, steps, (hf, kf), (hb, kb) = _logits(p, x[own], keep=True)
            d = _softmax(logits)
            label = np.tile(y[own], SEGMENT)
            d[np.arange(len(d)), label] -= 1
            d *= (weight[label] * (steps.reshape(-1) != _PAD))[:, None] / len(d)
            d = d.astype(np.float32)
            dh = d @ p["out"].T
            shape = (*steps.shape, hidden)
            gf, guf = gru.backward(dh[:, :hidden].reshape(shape), kf, p["uf"], None, False)
            gb, gub = gru.backward(dh[:, hidden:].reshape(shape), kb, p["ub"], None, True)
            one_hot = steps.reshape(-1)
            by_symbol = np.argsort(one_hot, kind="stable")
            cut = np.flatnonzero(np.diff(one_hot[by_symbol], prepend=-1))
            grads = {"uf": guf, "ub": gub, "bias": d.sum(axis=0),
                     "out": np.concatenate([hf.reshape(-1, hidden).T @ d, hb.reshape(-1, hidden).T @ d])}
            for name, g in (("xf", gf), ("xb", gb)):
                grads[name] = np.zeros_like(p[name])
                grads[name][one_hot[by_symbol][cut]] = np.add.reduceat(g.reshape(-1, 3 * hidden)[by_symbol], cut)
            adam.step(grads)
    return {"names": names, "params": p}


def pooled(model: dict, data: np.ndarray, offsets: np.ndarray, batch: int = 2048) -> np.ndarray:
    """Mean probabilities over all positions of every row, (rows, languages); zero for empty rows."""
    total = np.zeros((len(offsets) - 1, len(model["names"])))
    symbols, row = segments(data, offsets)
    for i in range(0, len(symbols), batch):
        own = symbols[i:i + batch]
        probability = _softmax(_logits(model["params"], own))
        probability[own.T.reshape(-1) == _PAD] = 0
        np.add.at(total, row[i:i + batch], probability.reshape(SEGMENT, len(own), -1).sum(axis=0))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def _sampled_segments(text: str, per_text: int) -> bytes:
    """At most ``per_text`` segments of a text, chosen by a hash of it, in their order."""
    data = text.encode()
    count = -(-len(data) // SEGMENT)
    if count <= per_text:
        return data
    pick = np.sort(np.random.default_rng(zlib.crc32(data)).permutation(count)[:per_text])
    return b"".join(data[i * SEGMENT:(i + 1) * SEGMENT] for i in pick.tolist())


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_rows: int = 3000, per_text: int = 4, **options) -> dict | None:
    """Train on at most ``max_rows`` rows of each language, chosen by a hash of the id.

    Spark counts the rows of every language first, so that each gets its own
    sample: a language is in the model however rare it is.  Only rows with a
    letter are sampled, and only ``per_text`` segments of each reach the task
    that trains.
    """
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["id", "lang"]).filter(pa.array([bool(t and _LETTER.search(t)) for t in batch["text"].to_pylist()], pa.bool_()))

    id_type = rows.schema["id"].dataType.simpleString()
    known = common.materialise(rows.mapInArrow(lettered, f"id {id_type}, lang string").distinct(), "languages")
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    spread = F.pmod(F.xxhash64(F.lit("language"), F.col("id").cast("string")), F.lit(1 << 30))
    # rows far beyond a language's bound are dropped by their hash before any sort
    near = known.join(F.broadcast(counts), "lang").withColumn("h", spread).where(
        F.col("h") < (F.least(F.lit(1.0), F.lit(2.0 * max_rows) / F.col("n")) * (1 << 30)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    chosen = near.withColumn("rank", rank).where(F.col("rank") <= max_rows).select("id", "lang")
    sample = rows.join(F.broadcast(chosen), ["id", "lang"], "left_semi").dropDuplicates(["id", "lang"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(_sampled_segments(t, per_text), y) for t, y in zip(batch["text"].to_pylist(), batch["lang"].to_pylist())
                    if t and _LETTER.search(t)]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in kept], pa.binary()), pa.array([y for _, y in kept], pa.string())],
                                             names=["text", "lang"])

    def learn(table: pa.Table) -> dict | None:
        kept = sorted(zip(*(c.to_pylist() for c in table.columns)))
        return train([t for t, _ in kept], [y for _, y in kept], per_text=per_text, **options) if kept else None

    return common.fit_in_task(sample.select("text", "lang").mapInArrow(cut, "text binary, lang string"), learn)


def predict(docs: DataFrame, model: dict | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (its pooled probability)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch):
                ids, texts = batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first).to_pylist()
                p = pooled(model, data, offsets) if model else np.zeros((end - first, 1))
                best = p.argmax(axis=1)
                known = np.array([bool(model and t and _LETTER.search(t)) for t in texts])
                names = [model["names"][k] if ok else "und" for k, ok in zip(best.tolist(), known.tolist())]
                score = np.clip(np.where(known, p[np.arange(len(p)), best], 0.0), 0, 1)
                yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(score)],
                                                 names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)
