"""Secret scans: fixed patterns plus a character convolutional network over every candidate and its context.

Base findings come from three patterns (assigned values, access keys, long hex
runs).  Candidates are all runs of 12 or more key characters; each is read whole, in pieces of 64 bytes with 16 bytes of context on either
side.  The network (byte embeddings, one convolution, max and mean pooling,
written in numpy) is trained on the findings and the other candidates of all
documents, see ``fit`` and ``train``.  Its threshold keeps the asked recall on
findings held back from training, after a logistic calibration.  Candidates over it become further
spans of kind ``model``; base findings are never removed.

NULL texts are empty and have no spans.  Without findings and other
candidates to learn from, only base findings are returned.  Repeated rows get
the same spans.  Offsets are code points, ends exclusive.  Texts and candidates
of any length are read whole; an empty table gives no rows; ``scan`` does not
read further columns, ``redact`` keeps them, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm import common, gru, training
from kempt.llm.toxicity import _logistic

KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api")

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*range(48, 58), *range(97, 103)]] = True
_KEY_BYTE = np.zeros(256, bool)
_KEY_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.=-"]] = True

PIECE, STRIDE, CONTEXT = 64, 48, 16
_LENGTH = PIECE + 2 * CONTEXT
_EMPTY = 256


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, leftmost and non-overlapping per kind, failing matches dropped."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _rows_at(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.unique(np.searchsorted(offsets, at, "right") - 1)


def suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may have a base finding: a cheap superset from byte searches over the whole slice."""
    lower = common.LOWER[data].tobytes()
    at = []
    for word, where in [(w, lower) for w in _KEYWORDS] + [(b"akia", lower)]:
        i = where.find(word)
        while i >= 0:
            at.append(i)
            i = where.find(word, i + 1)
    starts, ends = common.runs(_HEX_BYTE[data], offsets)
    return _rows_at(offsets, np.concatenate([np.array(at, np.int64), starts[ends - starts >= 16]]))


def candidates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of every run of 12 or more key characters."""
    starts, ends = common.runs(_KEY_BYTE[data], offsets)
    keep = ends - starts >= 12
    return starts[keep], ends[keep]


def pieces(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols (pieces, _LENGTH), whether each is inside its candidate, candidate of each piece)."""
    counts = 1 + np.maximum(-(-(ends - starts - PIECE) // STRIDE), 0)
    which = np.repeat(np.arange(len(starts)), counts)
    within = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (starts[which] + within * STRIDE - CONTEXT)[:, None] + np.arange(_LENGTH)
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = (at >= starts[which][:, None]) & (at < ends[which][:, None])
    valid = (at >= offsets[row][which][:, None]) & (at < offsets[row + 1][which][:, None])
    symbols = np.full(at.shape, _EMPTY, np.int16)
    symbols[valid] = data[at[valid]]
    return symbols, inside, which


def _network(p: dict, symbols: np.ndarray, inside: np.ndarray, keep: bool = False):
    x = np.concatenate([p["embed"][symbols], inside[:, :, None].astype(np.float32)], axis=2)
    n, width = len(x), p["conv"].shape[0] // x.shape[2]
    steps = _LENGTH - width + 1
    view = np.concatenate([x[:, k:k + steps] for k in range(width)], axis=2)
    raw = (view.reshape(n * steps, -1) @ p["conv"]).reshape(n, steps, -1) + p["conv_bias"]
    active = np.maximum(raw, 0)
    top = active.argmax(axis=1)
    pooled = np.concatenate([np.take_along_axis(active, top[:, None], 1)[:, 0], active.mean(axis=1)], axis=1)
    logit = pooled @ p["out"] + p["bias"]
    return (logit, (view, raw, top, pooled, width)) if keep else logit


_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8).astype(np.int16)
_IS_LETTER = np.isin(np.arange(257), _LETTERS)
_IS_DIGIT = np.isin(np.arange(257), np.frombuffer(b"0123456789", np.uint8))


def disguised(symbols: np.ndarray, inside: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Pieces without what the patterns go by: surroundings hidden, letters and a random share of the digits replaced by any letters."""
    out = np.where(inside, symbols, _EMPTY).astype(np.int16)
    share = rng.uniform(0, 0.9, (len(out), 1))
    letters = inside & (_IS_LETTER[out] | (_IS_DIGIT[out] & (rng.random(out.shape) < share)))
    out[letters] = rng.choice(_LETTERS, int(letters.sum()))
    return out


def _learn(p: dict, symbols: np.ndarray, inside: np.ndarray, y: np.ndarray, use: np.ndarray, rng: np.random.Generator, *, epochs: int,
           batch: int, rate: float, balance: tuple[float, float]) -> None:
    """Train ``p`` in place on the pieces numbered ``use``; ``balance`` weighs the labels."""
    filters, dims = p["conv"].shape[1], p["embed"].shape[1]
    weight = np.where(y == 1, balance[1], balance[0])
    adam = gru.Adam(p, rate)
    for _ in range(epochs):
        rng.shuffle(use)
        for i in range(0, len(use), batch):
            own = use[i:i + batch]
            seen = np.where(inside[own] | (rng.random(len(own)) < 0.5)[:, None], symbols[own], _EMPTY)
            hidden = np.flatnonzero((y[own] == 1) & (rng.random(len(own)) < 0.5))
            seen[hidden] = disguised(symbols[own[hidden]], inside[own[hidden]], rng)
            logit, (view, raw, top, pooled, width) = _network(p, seen, inside[own], keep=True)
            d = ((gru.sigmoid(logit) - y[own]) * weight[own] / len(own)).astype(np.float32)
            d_pooled = d[:, None] * p["out"]
            d_active = np.repeat(d_pooled[:, None, filters:] / raw.shape[1], raw.shape[1], axis=1)
            rows, columns = np.arange(len(own))[:, None], np.arange(filters)
            d_active[rows, top, columns] += d_pooled[:, :filters]
            d_raw = (d_active * (raw > 0)).reshape(-1, filters)
            d_view = (d_raw @ p["conv"].T).reshape(view.shape)
            d_x = np.zeros((len(own), _LENGTH, dims + 1), np.float32)
            for k in range(width):
                d_x[:, k:k + raw.shape[1]] += d_view[:, :, k * (dims + 1):(k + 1) * (dims + 1)]
            d_embed = np.zeros_like(p["embed"])
            np.add.at(d_embed, seen.reshape(-1), d_x[:, :, :dims].reshape(-1, dims))
            adam.step({"embed": d_embed, "conv": view.reshape(-1, view.shape[2]).T @ d_raw, "conv_bias": d_raw.sum(axis=0),
                       "out": pooled.T @ d, "bias": d.sum(keepdims=True)})


def train(symbols: np.ndarray, inside: np.ndarray, y: np.ndarray, *, recall: float = 0.99, false_share: float = 0.002, dims: int = 6, filters: int = 16,
          width: int = 5, epochs: int = 8, min_steps: int = 150, batch: int = 128, rate: float = 0.01, seed: int = 3) -> dict:
    """A model from labelled pieces: a quarter of each label is held back for the calibration and the threshold.

    The patterns' findings are all the labels there are, so a network that
    learnt them as they stand would only repeat the patterns.  Half of the
    findings are therefore met disguised, and of the others half with their
    surroundings hidden.  The threshold lets no more than ``false_share`` of
    the held-back others pass and is 0.5 at least, but in any case keeps
    ``recall`` of the held-back findings.
    """
    rng = np.random.default_rng(seed)
    p = {"embed": 0.5 * rng.standard_normal((257, dims)),
         "conv": rng.standard_normal((width * (dims + 1), filters)) / np.sqrt(width * (dims + 1)),
         "conv_bias": np.zeros(filters), "out": 0.3 * rng.standard_normal(2 * filters), "bias": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        own = rng.permutation(np.flatnonzero(y == label))
        held[own[:len(own) // 4]] = True  # with one piece of a label it is in both parts
    held_back = np.flatnonzero(held) if 0 < y[held].sum() < held.sum() else np.arange(len(y))
    use = np.flatnonzero(~held)
    balance = (0.5 / max((y[use] == 0).sum(), 1) * len(use), 0.5 / max((y[use] == 1).sum(), 1) * len(use))
    _learn(p, symbols, inside, y, use, rng, epochs=max(epochs, -(-min_steps * batch // max(len(use), 1))), batch=batch, rate=rate, balance=balance)
    logit = _network(p, symbols[held_back], inside[held_back])
    calibration = _logistic(logit[:, None], y[held_back], np.ones(len(held_back)))
    probability = 1 / (1 + np.exp(-np.clip(logit * calibration[0] + calibration[1], -30, 30)))
    found, others = np.sort(probability[y[held_back] == 1]), np.sort(probability[y[held_back] == 0])
    allowed = max(np.nextafter(others[-1 - int(false_share * len(others))], 1), 0.5)
    threshold = min(allowed, found[int((1 - recall) * len(found))])  # at least the asked share lies at or over it
    return {"params": p, "calibration": calibration, "threshold": float(threshold)}


def score(model: dict, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, batch: int = 512) -> np.ndarray:
    """Calibrated probability of every candidate: the largest of its pieces."""
    symbols, inside, which = pieces(data, offsets, starts, ends)
    out = np.zeros(len(starts))
    slope, shift = model["calibration"]
    for i in range(0, len(symbols), batch):
        logit = _network(model["params"], symbols[i:i + batch], inside[i:i + batch])
        np.maximum.at(out, which[i:i + batch], 1 / (1 + np.exp(-np.clip(logit * slope + shift, -30, 30))))
    return out


def scan_slice(data: np.ndarray, offsets: np.ndarray, model: dict | None) -> dict[int, list[tuple[int, int, str]]]:
    """Spans of every row that has any, by row."""
    found: dict[int, list] = {}
    for r in suspects(data, offsets).tolist():
        spans = base_spans(data[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8", "surrogatepass"))
        if spans:
            found[r] = spans
    if model:
        starts, ends = candidates(data, offsets)
        if len(starts):
            chosen = score(model, data, offsets, starts, ends) >= model["threshold"]
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist()):
                r = int(np.searchsorted(offsets, a, "right")) - 1
                first, last = int(points[a] - points[offsets[r]]), int(points[b] - points[offsets[r]])
                if not any(s < last and first < e for s, e, _ in found.get(r, ())):
                    found.setdefault(r, []).append((first, last, "model"))
    return {r: sorted(s, key=lambda x: (x[0], KINDS.index(x[2]))) for r, s in found.items()}


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.let_go()
    for batch in batches:
        for _, _, data, offsets in common.text_slices(batch):
            starts, ends = candidates(data, offsets)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            base = scan_slice(data, offsets, None)
            symbols, inside, which = pieces(data, offsets, starts, ends)
            row = np.searchsorted(offsets, starts, "right") - 1
            covered = [any(s < points[b] - points[offsets[r]] and points[a] - points[offsets[r]] < e for s, e, _ in base.get(r, ()))
                       for a, b, r in zip(starts.tolist(), ends.tolist(), row.tolist())]
            yield pa.RecordBatch.from_pydict({
                "symbols": pa.array([s.tobytes() for s in symbols], pa.binary()),
                "inside": pa.array([i.tobytes() for i in inside], pa.binary()),
                "found": pa.array(np.array(covered, bool)[which] if len(which) else [], pa.bool_())})


def labelled_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(symbols, inside, found): the pieces of every candidate, labelled by whether a base finding covers them."""

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(common.task(_labelled), "symbols binary, inside binary, found boolean")


#: Logits are counted in cells of 1 / _CELLS, up to _MOST on either side.
_CELLS, _MOST = 256, 64.0
#: Stands for _EMPTY where pieces are stored as bytes: no UTF-8 text holds it.
_STORED_EMPTY = 255


def _stored(docs: DataFrame) -> DataFrame:
    """The distinct labelled pieces of (id, text): their hash, symbols as bytes, inside as bits, found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _labelled(batches):
            symbols, inside = _arrays(batch, np.int16, False)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s.tobytes() for s in np.where(symbols == _EMPTY, _STORED_EMPTY, symbols).astype(np.uint8)], pa.binary()),
                 pa.array([i.tobytes() for i in np.packbits(inside, axis=1)], pa.binary()), batch.column(2)], names=["symbols", "inside", "found"])

    stored = docs.select("id", "text").mapInArrow(common.task(run), "symbols binary, inside binary, found boolean")
    # texts that say otherwise of the same piece leave it under both labels
    return stored.withColumn("key", F.xxhash64("symbols", "inside", "found")).dropDuplicates(["key"])


def _arrays(rows: pa.RecordBatch | pa.Table, kind, packed: bool) -> tuple[np.ndarray, np.ndarray]:
    symbols = np.frombuffer(b"".join(rows.column(0).to_pylist()), kind).reshape(-1, _LENGTH)
    inside = np.frombuffer(b"".join(rows.column(1).to_pylist()), np.uint8 if packed else bool)
    if packed:
        symbols = np.where(symbols == _STORED_EMPTY, _EMPTY, symbols).astype(np.int16)
        inside = np.unpackbits(inside.reshape(len(symbols), -1), axis=1, count=_LENGTH).astype(bool)
    return symbols, inside.reshape(-1, _LENGTH)


def _sorted_pieces(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = rows.select(["symbols", "inside", "found"]).sort_by([("symbols", "ascending"), ("inside", "ascending"), ("found", "ascending")])
    return *_arrays(rows, np.uint8, True), rows["found"].to_numpy(zero_copy_only=False).astype(np.float64)


def _logits(rows: DataFrame, params: dict) -> DataFrame:
    """(found, logit) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in batches:
            symbols, inside = _arrays(batch, np.uint8, True)
            logit = [_network(params, symbols[i:i + 512], inside[i:i + 512]) for i in range(0, len(symbols), 512)]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(np.concatenate([*logit, np.zeros(0)]).astype(np.float64))], names=["found", "logit"])

    return rows.select("symbols", "inside", "found").mapInArrow(common.task(run), "found boolean, logit double")


def calibrated(params: dict, logits: np.ndarray, y: np.ndarray, count: np.ndarray, recall: float, false_share: float = 0.002) -> dict:
    """The model with its calibration and threshold from counts of logits, one row a cell and label.

    As in ``train``; a finding counts with the low end of its cell and another
    candidate with the high end, so both shares hold for the logits themselves.
    """
    calibration = _logistic(logits[:, None], y, count)
    edge = np.floor(logits * _CELLS)
    ends = [1 / (1 + np.exp(-np.clip(e / _CELLS * calibration[0] + calibration[1], -30, 30))) for e in (edge, edge + 1)]

    def at(value: np.ndarray, n: np.ndarray, place: int) -> float:
        order = np.argsort(value, kind="stable")
        return value[order][np.searchsorted(np.cumsum(n[order]), place, "right")]

    found, others = y == 1, y == 0
    n_found, n_others = int(count[found].sum()), int(count[others].sum())
    allowed = max(np.nextafter(at(np.maximum(*ends)[others], count[others], n_others - 1 - int(false_share * n_others)), 1), 0.5)
    threshold = min(allowed, at(np.minimum(*ends)[found], count[found], int((1 - recall) * n_found)))
    return {"params": params, "calibration": calibration, "threshold": float(threshold)}


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_pieces: int = 4_000, shard_pieces: int = 20_000,
        shard_rate: float = 0.003, recall: float = 0.99) -> dict | None:
    """Train on the findings and on the other candidates of all documents.

    Up to ``max_pieces`` distinct pieces of each label are learnt in one task.
    Of more, so many of each label, chosen by their hash, only give the start:
    all pieces but those held back are then learnt in shards, and all held-back
    pieces fit the calibration and the threshold.  Half of the training pieces
    are met with their surroundings hidden, so that the network learns the
    secret's own characters too and not the key word alone.  None only where no
    document has a finding, or where no candidate is without one: then there is
    nothing to tell apart and only the base patterns are used.  Repeated rows
    and texts count once; NULL ids and clashing column names do not matter.
    """
    texts = docs.select(F.lit(0).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    pieces_of = common.materialise(_stored(texts), "pieces")
    counts = {r["found"]: r["count"] for r in pieces_of.groupBy("found").count().collect()}
    if len(counts) < 2:
        return None
    whole = max(counts.values()) <= max_pieces
    ours = pieces_of if whole else pieces_of.where(~training.held_back("key"))
    start = [common.bounded_sample(ours.where(F.col("found") == found), "key", max_pieces, "pieces") for found in (False, True)]

    def learn(rows: pa.Table) -> dict | None:
        symbols, inside, y = _sorted_pieces(rows)
        return train(symbols, inside, y, recall=recall) if 0 < y.sum() < len(y) else None

    model = common.fit_in_task(start[0].unionByName(start[1]).select("symbols", "inside", "found"), learn)
    if whole or model is None:
        return model
    total = sum(counts.values())
    balance = (0.5 * total / counts[False], 0.5 * total / counts[True])

    def learn_shard(p: dict, rows: pa.Table) -> dict:
        symbols, inside, y = _sorted_pieces(rows)
        _learn(p, symbols, inside, y, np.arange(len(y)), np.random.default_rng(3), epochs=1, batch=512, rate=shard_rate, balance=balance)
        return {k: np.full(len(v), float(len(y))) for k, v in p.items()}

    shards = -(-total // shard_pieces)
    params = training.over_shards(ours.select("symbols", "inside", "found", "key").repartition(shards, "key"), shards, model["params"], learn_shard)
    for rest in (pieces_of.where(training.held_back("key")), pieces_of):
        x, y, count = training.cells(_logits(rest, params), ["logit"], "found", _CELLS, _MOST)
        if len(set(y.tolist())) == 2:
            break
    return calibrated(params, x[:, 0], y, count, recall)


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


_SPANS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, model: dict | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per base kind, the digest of the base spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch):
                found = scan_slice(data, offsets, model)
                spans = [found.get(r, []) for r in range(end - first)]
                base = [[s for s in own if s[2] != "model"] for own in spans]
                counts = [pa.array([sum(s[2] == kind for s in own) for own in spans], pa.int64()) for kind in KINDS[:3]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), *counts,
                     pa.array([hashlib.sha256(_joined(own).encode()).hexdigest() for own in base]),
                     pa.array([_joined(own) for own in spans])], names=["id", *[c.split()[0] for c in _SPANS.split(", ")]])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(common.task(run), f"id long, {_SPANS}").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, model: dict | None, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping spans by one); all columns stay."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch, text_col):
                part = batch.slice(first, end - first)
                texts = part.column(at).to_pylist()
                for r, spans in scan_slice(data, offsets, model).items():
                    out, done = [], 0
                    for a, b, _ in spans:
                        if a >= done:
                            out += [texts[r][done:a], mark]
                        done = max(done, b)
                    texts[r] = "".join(out) + texts[r][done:]
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(common.task(run), docs.schema)
