"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs.

A word enters as an embedding of its hash next to the mean embedding of its
character trigrams, so unseen forms of a word are still read.  Every text is
cut into overlapping windows of 32 words, 16 apart, and all of them are scored:
the network reads a window in both directions, attention pools its states and
a linear layer gives the window's logit.  A document's score is a logistic
calibration of its largest and mean window logits, fitted on labelled rows
that the network was not trained on.

The network is trained by backpropagation through time on every window of every
labelled row: up to ``max_rows`` rows of each label in one task; of more, a
hash-chosen sample is the start, and then shards of all rows learn from it side
by side (see ``training``).  Rows held back by their hash, all of them, fit the
calibration.  A NULL or empty text has no window and gets the calibrated score of
an all-negative one; without labels of both kinds every score is 0; repeated
rows are scored alike.  For training an id counts once: with the text of the
least hash, and as toxic if any of its labels says so.  Texts of any length are
scored whole; an empty table gives no rows; further columns, whatever their
names, are not read by ``predict`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm import common, gru, training

WINDOW, STEP = 32, 16
WORD_ROWS, GRAM_ROWS = 1 << 15, 1 << 14

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def read_words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased words of every row, each distinct word read once.

    Returns (word number of every word in order, bucket of each distinct word,
    trigram buckets of the distinct words, first trigram of each, first word
    of each row).  A word is a run of letters, digits and non-ASCII
    characters; its trigrams include its borders.
    """
    lower = common.LOWER[data]
    starts, ends = common.runs(_LETTER[lower], offsets)
    first = np.searchsorted(starts, offsets)
    hashes, sample, number = np.unique(common.span_hashes(lower, starts, ends), return_index=True, return_inverse=True)
    starts, ends = starts[sample], ends[sample]
    bucket = (hashes >> np.uint64(49)).astype(np.int32)
    # one trigram around every byte of a word: borders are 0
    sizes = ends - starts
    begin = np.cumsum(sizes) - sizes
    own = lower[np.repeat(starts - begin, sizes) + np.arange(int(sizes.sum()))].astype(np.uint32)
    left, right = np.zeros_like(own), np.zeros_like(own)
    left[1:], right[:-1] = own[:-1], own[1:]
    if len(begin):
        left[begin] = 0
        right[begin + sizes - 1] = 0
    gram = ((left * np.uint32(0x9E3779B1)) ^ (own * np.uint32(0x85EBCA6B)) ^ (right * np.uint32(0xC2B2AE35)))
    gram = ((gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(18)
    return number, bucket, gram.astype(np.int32), begin, first


def window_index(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word index (windows, WINDOW) or -1, row of each window): overlapping windows over all words of every row."""
    n = np.diff(first)
    counts = np.where(n > 0, 1 + np.maximum(-(-(n - WINDOW) // STEP), 0), 0)
    row = np.repeat(np.arange(len(n)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (first[:-1][row] + within * STEP)[:, None] + np.arange(WINDOW)
    return np.where(at < first[1:][row][:, None], at, -1), row


def word_inputs(p: dict, bucket: np.ndarray, gram: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Input vector of every word: its embedding beside the mean of its trigrams'."""
    if not len(bucket):
        return np.zeros((0, p["word"].shape[1] + p["gram"].shape[1]), np.float32)
    sizes = np.diff(np.append(begin, len(gram)))
    grams = np.add.reduceat(p["gram"][gram], begin) / sizes[:, None]
    return np.concatenate([p["word"][bucket], grams], axis=1).astype(np.float32)


def _gates(p: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gate pre-activations of every distinct word in both directions; the last row is padding."""
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    return x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]


def _pooled_logit(p: dict, gates: tuple[np.ndarray, np.ndarray], index: np.ndarray, keep: bool = False):
    """Logit of every window from its words' gates; with ``keep`` what training needs."""
    steps = np.ascontiguousarray(index.T)
    mask = (steps >= 0).astype(np.float32)
    need = None if mask.all() else mask
    f = gru.forward(np.take(gates[0], steps, axis=0), p["uf"], need, False, keep)
    b = gru.forward(np.take(gates[1], steps, axis=0), p["ub"], need, True, keep)
    hf, hb = (f[0], b[0]) if keep else (f, b)
    hidden = hf.shape[2]
    a = hf @ p["attend"][:hidden] + hb @ p["attend"][hidden:]
    a = np.where(mask > 0, a, np.float32(-1e9))
    a = np.exp(a - a.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.concatenate([np.einsum("tn,tnh->nh", a, hf), np.einsum("tn,tnh->nh", a, hb)], axis=1)
    logit = pooled @ p["out"] + p["bias"]
    return (logit, (steps, mask, f, b, np.concatenate([hf, hb], axis=2), a, pooled)) if keep else logit


def _gradients(p: dict, x: np.ndarray, kept, d: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters and of the word inputs, for logit gradients ``d``."""
    steps, mask, f, b, h, a, pooled = kept
    hidden = p["uf"].shape[0]
    d_pooled = d[:, None] * p["out"]
    d_a = (h * d_pooled).sum(axis=2)
    d_score = a * (d_a - (a * d_a).sum(axis=0))
    dh = (a[:, :, None] * d_pooled + d_score[:, :, None] * p["attend"]).astype(np.float32)
    gf, guf = gru.backward(np.ascontiguousarray(dh[:, :, :hidden]), f[1], p["uf"], mask, False)
    gb, gub = gru.backward(np.ascontiguousarray(dh[:, :, hidden:]), b[1], p["ub"], mask, True)
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])  # -1: padding
    flat = steps.reshape(-1)
    gf, gb, own = gf.reshape(-1, 3 * hidden), gb.reshape(-1, 3 * hidden), x[flat]
    grads = {"uf": guf, "ub": gub, "wf": own.T @ gf, "wb": own.T @ gb, "bf": gf.sum(axis=0), "bb": gb.sum(axis=0),
             "attend": np.tensordot(d_score, h, ([0, 1], [0, 1])), "out": pooled.T @ d, "bias": d.sum(keepdims=True)}
    dx = np.zeros_like(x)
    _add_rows(dx, flat, gf @ p["wf"].T + gb @ p["wb"].T)
    return grads, dx[:-1]


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    if len(at):
        # -1, the last row, comes first; numbers of 16 bits are sorted by radix
        order = np.argsort((at + 1).astype(np.uint16) if at.max() < 65535 else at, kind="stable")
        at = at[order]
        cut = np.flatnonzero(np.diff(at, prepend=at[0] - 1))
        table[at[cut]] += np.add.reduceat(rows[order], cut)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weighted, ridge-regularised logistic regression by Newton's method; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.append(np.ones(x.shape[1] - 1), 1e-3)
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (q - y)) + penalty * w
        hessian = (x * (weight * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _training_windows(texts: list[bytes], chosen: np.ndarray, per_text: int | None, rng: np.random.Generator):
    """All windows of each chosen text, or at most ``per_text`` random ones, read slice by slice.

    Returns (windows as word numbers, row of each), and the words' buckets,
    trigrams and first trigrams.
    """
    windows, rows, buckets, grams, begins = [], [], [], [], []
    n_words = n_grams = 0
    for low, high in _slices(texts):
        number, bucket, gram, begin, first = _read(texts[low:high])
        index, row = window_index(first)
        order = np.lexsort((rng.random(len(row)), row))
        rank = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        use = np.sort(order[(rank < (per_text or len(row))) & chosen[low:high][row[order]]])
        own = index[use]
        windows.append(np.where(own >= 0, number[own] + n_words, -1).astype(np.int32))
        rows.append(row[use] + low)
        buckets.append(bucket)
        grams.append(gram)
        begins.append(begin + n_grams)
        n_words, n_grams = n_words + len(bucket), n_grams + len(gram)
    return tuple(np.concatenate(x) for x in (windows, rows, buckets, grams, begins))


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > common.SLICE_BYTES:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _read(texts: list[bytes]):
    return read_words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts]))


def _learn(p: dict, texts: list[bytes], y: np.ndarray, chosen: np.ndarray, rng: np.random.Generator, *, per_text: int | None, epochs: int,
           min_steps: int, batch: int, rate: float, balance: tuple[float, float] | None = None) -> tuple[int, np.ndarray, np.ndarray]:
    """Train ``p`` in place on the chosen texts; returns how many windows there were and which word and trigram rows they touched.

    ``balance`` weighs the labels; without it, they weigh the same in all.
    """
    index, row, bucket, gram, begin = _training_windows(texts, chosen, per_text, rng)
    ends = np.append(begin, len(gram))
    use = np.arange(len(row))
    touched = np.zeros(len(p["word"]), bool), np.zeros(len(p["gram"]), bool)
    place = np.zeros(len(begin) + 1, np.int64)  # of the words of a batch; the last: padding

    def batch_inputs(own: np.ndarray):
        """The distinct words of some windows: their numbers, the windows over them, trigrams and inputs."""
        there = np.zeros(len(begin) + 1, bool)
        there[own] = True
        words = np.flatnonzero(there[:-1])
        place[words] = np.arange(len(words))
        place[-1] = -1
        local = place[own]
        sizes = ends[words + 1] - begin[words]
        local_begin = np.cumsum(sizes) - sizes
        grams = gram[np.repeat(begin[words] - local_begin, sizes) + np.arange(int(sizes.sum()))]
        return words, local, sizes, grams, word_inputs(p, bucket[words], grams, local_begin)

    adam = gru.Adam(p, rate)
    epochs = max(epochs, -(-min_steps * batch // max(len(use), 1)))
    for epoch in range(epochs):
        adam.rate = rate * (1 - 0.9 * epoch / epochs)
        share = balance or (0.5 / max((y[row[use]] == 0).sum(), 1) * len(use), 0.5 / max((y[row[use]] == 1).sum(), 1) * len(use))
        weight = np.where(y == 1, share[1], share[0])
        rng.shuffle(use)
        for i in range(0, len(use), batch):
            words, local, sizes, grams, x = batch_inputs(index[use[i:i + batch]])
            touched[0][bucket[words]] = touched[1][grams] = True
            logit, kept = _pooled_logit(p, _gates(p, x), local, keep=True)
            target = y[row[use[i:i + batch]]]
            d = ((gru.sigmoid(logit) - target) * weight[row[use[i:i + batch]]] / len(target)).astype(np.float32)
            grads, dx = _gradients(p, x, kept, d)
            grads["word"], grads["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
            _add_rows(grads["word"], bucket[words], dx[:, :dx.shape[1] // 2])
            _add_rows(grads["gram"], grams, np.repeat(dx[:, dx.shape[1] // 2:] / sizes[:, None], sizes, axis=0))
            adam.step(grads)
    return len(use), *touched


def train(texts: list[bytes], toxic: list[int], negatives_per_row: float = 1.0, *, hidden: int = 12, dims: int = 12,
          per_text: int | None = None, epochs: int = 5, min_steps: int = 300, batch: int = 256, rate: float = 0.01, seed: int = 7) -> dict:
    """A model from labelled texts; each negative row stands for ``negatives_per_row`` of them in the calibration."""
    rng = np.random.default_rng(seed)
    p = {"word": 0.1 * rng.standard_normal((WORD_ROWS, dims)), "gram": 0.3 * rng.standard_normal((GRAM_ROWS, dims)),
         "wf": rng.standard_normal((2 * dims, 3 * hidden)) / np.sqrt(2 * dims), "bf": np.zeros(3 * hidden),
         "wb": rng.standard_normal((2 * dims, 3 * hidden)) / np.sqrt(2 * dims), "bb": np.zeros(3 * hidden),
         "attend": 0.1 * rng.standard_normal(2 * hidden), "out": 0.3 * rng.standard_normal(2 * hidden), "bias": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()} | {"uf": gru.init(rng, hidden), "ub": gru.init(rng, hidden)}
    y = np.array(toxic)
    train_rows = rng.random(len(texts)) < 0.75
    _learn(p, texts, y, train_rows, rng, per_text=per_text, epochs=epochs, min_steps=min_steps, batch=batch, rate=rate)
    model = {"params": p, "calibration": None}
    rest = np.flatnonzero(~train_rows)
    if len(set(y[rest].tolist())) < 2:
        rest = np.arange(len(y))
    held = [texts[i] for i in rest]
    stats = np.concatenate([_row_stats(model, *_read(held[low:high])) for low, high in _slices(held)])
    model["calibration"] = _logistic(stats, y[rest], np.where(y[rest] == 1, 1.0, negatives_per_row))
    return model


def _row_stats(model: dict, number, bucket, gram, begin, first, batch: int = 2048) -> np.ndarray:
    """Largest and mean window logit of every row; rows without words get the lowest there is."""
    p = model["params"]
    gates = _gates(p, word_inputs(p, bucket, gram, begin))
    index, row = window_index(first)
    index = np.where(index >= 0, number[index], -1)
    logits = np.zeros(len(row), np.float64)
    for i in range(0, len(index), batch):
        logits[i:i + batch] = _pooled_logit(p, gates, index[i:i + batch])
    out = np.full((len(first) - 1, 2), -30.0)
    if len(row):
        cut = np.flatnonzero(np.diff(row, prepend=-1))
        counts = np.diff(np.append(cut, len(row)))
        out[row[cut], 0] = np.clip(np.maximum.reduceat(logits, cut), -30, 30)
        out[row[cut], 1] = np.clip(np.add.reduceat(logits, cut) / counts, -30, 30)
    return out


def score(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Calibrated score of every row, 0 to 1."""
    stats = _row_stats(model, *read_words(data, offsets))
    w = model["calibration"]
    return 1 / (1 + np.exp(-np.clip(stats @ w[:-1] + w[-1], -30, 30)))


#: A shard has about so many labelled rows, and about so many bytes of text, at most.
_SHARD_ROWS, _SHARD_BYTES = 4000, 1 << 24


def _labelled(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, shards: int | None = None) -> DataFrame:
    """(id, _text, _label) of the labelled ids, each once; with ``shards``, dealt over so many partitions by the id."""
    rows = docs.select(id_col, F.col(text_col).alias("_text")).where("_text is not null")
    rows = rows.repartition(shards, id_col) if shards else rows
    return (rows.join(known, id_col).groupBy(id_col)
            .agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"), F.max("_label").alias("_label")))


def _sorted_rows(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    rows = sorted((t.encode(), y) for t, y in zip(table["_text"].to_pylist(), table["_label"].to_pylist()))
    return [t for t, _ in rows], np.array([y for _, y in rows])


def _stats(rows: DataFrame, model: dict) -> DataFrame:
    """(_label, most, mean): the window logits of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch, "_text"):
                own = _row_stats(model, *read_words(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, end - first).cast(pa.int64()), pa.array(own[:, 0].copy()),
                                                  pa.array(own[:, 1].copy())], names=["_label", "most", "mean"])

    return rows.select("_text", "_label").mapInArrow(common.task(run), "_label long, most double, mean double")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_rows: int = 1500, start_rows: int = 1000, shard_rate: float = 0.005, **options) -> dict | None:
    """Train on every window of every labelled document.

    With more than ``max_rows`` rows of a label, ``start_rows`` of each, chosen
    by a hash of the id, only give the start; all rows but those held back are
    then learned from in shards, and all held-back rows fit the calibration.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col)
             .agg(F.max(label_col).alias("_label")))
    counts = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}
    if len(counts) < 2:
        return None
    whole = max(counts.values()) <= max_rows
    ours = known if whole else known.where(~training.held_back(id_col))
    chosen = [common.bounded_sample(ours.where(F.col("_label") == k), id_col, max_rows if whole else start_rows, "toxicity") for k in (0, 1)]
    sample = _labelled(docs, F.broadcast(chosen[0].unionByName(chosen[1])), id_col, text_col)

    def learn(table: pa.Table) -> dict | None:
        texts, y = _sorted_rows(table)
        n = [(y == k).sum() for k in (0, 1)]
        if not min(n):
            return None
        return train(texts, y.tolist(), (counts[0] / n[0]) / (counts[1] / n[1]), **options)

    model = common.fit_in_task(sample.select("_text", "_label"), learn)
    if whole or model is None:
        return model
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(-(-sum(counts.values()) // _SHARD_ROWS), -(-size // _SHARD_BYTES))
    balance = tuple(0.5 * sum(counts.values()) / counts[k] for k in (0, 1))

    def learn_shard(p: dict, table: pa.Table) -> dict:
        texts, y = _sorted_rows(table)
        n, words, grams = _learn(p, texts, y, np.ones(len(y), bool), np.random.default_rng(options.get("seed", 7)), per_text=options.get("per_text"),
                                 epochs=1, min_steps=0, batch=512, rate=shard_rate, balance=balance)
        return {k: np.full(len(v), float(n)) for k, v in p.items()} | {"word": n * words, "gram": n * grams}

    rows = _labelled(docs, ours, id_col, text_col, shards).select("_text", "_label")
    model = {"params": training.over_shards(rows, shards, model["params"], learn_shard), "calibration": None}
    rest = _labelled(docs, known.where(training.held_back(id_col)), id_col, text_col)
    x, y, count = training.cells(_stats(rest, model), ["most", "mean"], "_label", 8, 30.0)
    if len(set(y.tolist())) < 2:
        x, y, count = training.cells(_stats(_labelled(docs, known, id_col, text_col), model), ["most", "mean"], "_label", 8, 30.0)
    if len(set(y.tolist())) < 2:
        return None
    model["calibration"] = _logistic(x, y, count)
    return model


def predict(docs: DataFrame, model: dict | None, *, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = 0.7, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, score, predicted (1 if score >= threshold); ``keep`` names further columns to carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch, "_text"):
                own = batch.slice(first, end - first)
                value = score(model, data, offsets) if model else np.zeros(len(own))
                columns = [own.column(i) for i in range(own.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                    names=[*own.schema.names[:-1], "score", "predicted"])

    rows = docs.select(F.col(id_col), *keep, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    return rows.mapInArrow(common.task(run), f"{schema}, score double, predicted int")


def keep_clean(docs: DataFrame, model: dict | None, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under the threshold (every row where there is no model)."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch, text_col):
                yield batch.slice(first, end - first).filter(pa.array(score(model, data, offsets) < threshold))

    return docs.mapInArrow(common.task(run), docs.schema)
