"""Document fingerprints by randomised edit embedding.

A walk copies a text's characters one by one: at step j it emits the
character it stands on and a random bit, shared by all texts and drawn for
(j, character), says whether it moves on.  Two texts that differ by few edits
fall back into step after each of them, so their emitted sequences have a
small Hamming distance.

A fingerprint samples 128 positions of the emitted sequence.  Each slot
samples min-wise: among all positions of a sequence it takes the one with the
least random rank, so two sequences of different lengths sample a common
position with the probability of their length ratio.  The share of equal
slots thus estimates the likeness of the sequences, whatever their lengths.
Slots are drawn from whole texts, however long.

Near duplicates: bands of sampled slots name buckets, and so do segments of
the text, sampled min-wise by their hash: edits all over a long text soon drive
whole walks apart, yet always leave some segments whole.  The members of a
bucket are compared with its least member and, if they stay apart from it, with
the whole bucket; an edit-distance computation decides on each candidate.

NULL texts are empty; the fingerprint of an empty text is all zeros, like
itself and unlike any other.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm import common
from kempt.llm.components import connected_components

SLOTS = 128
SEGMENT_SLOTS = 96
#: Characters of a segment, and from which length of text on.
_SEGMENTS = ((4, 0), (6, 50), (12, 400))
_SEGMENT_BASE = np.uint64(0x9E3779B97F4A7C15)
_NO_SEGMENT = np.uint64((1 << 64) - 1)
_END = 255  # stands after each text; slot value 0 is "no character"
_PERIOD = 1 << 12
_FEW = 24  # so few texts are walked one by one

_rng = np.random.default_rng(20160619)
#: _MOVES[j % period, character code]: the shared random bits.
_MOVES = _rng.integers(0, 2, (_PERIOD, 256)).astype(np.uint8)
_MOVES[:, _END] = 0


def _watched() -> dict[int, np.ndarray]:
    """Slots whose sample is replaced at each position: the record times of independent random ranks.

    The next record after position p comes at floor((p + 1) / u) for a uniform u.
    """
    at: dict[int, list[int]] = {}
    rng = np.random.default_rng(20160620)
    for slot in range(SLOTS):
        p = 0
        while p < 1 << 40:
            at.setdefault(p, []).append(slot)
            p = max(p + 1, int((p + 1) / max(rng.random(), 1e-12)))
    return {p: np.array(slots) for p, slots in at.items()}


_WATCHED = _watched()
_WATCHED_AT = np.array(sorted(_WATCHED))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes 1 to 254 of all texts, each ended by _END, and each text's start."""
    points = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = (1 + ((points * np.uint32(2654435761)) >> np.uint32(12)) % np.uint32(254)).astype(np.uint8)
    codes = np.append(codes, np.uint8(_END))
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    codes[starts[1:] - 1] = _END
    return codes, starts[:-1]


def fingerprints(texts: list[str]) -> np.ndarray:
    """(texts, SLOTS) sampled character codes of the walks over whole texts."""
    out = np.zeros((len(texts), SLOTS), np.uint8)
    if not texts:
        return out
    codes, starts = _codes(texts)
    who = np.flatnonzero(codes[starts] != _END)
    pos = starts[who]
    step = 0
    while len(who) >= _FEW:
        for step in range(step, step + 256):
            c = codes.take(pos)
            slots = _WATCHED.get(step)
            if slots is not None:
                live = c != _END
                out[np.ix_(who[live], slots)] = c[live][:, None]
            pos += _MOVES[step % _PERIOD].take(c)
        step += 1
        live = codes.take(pos) != _END
        who, pos = who[live], pos[live]
    for k, i in zip(who.tolist(), pos.tolist()):
        _walk_alone(codes, i, step, out[k])
    return out


def _walk_alone(codes: np.ndarray, i: int, step: int, slots: np.ndarray) -> None:
    """The rest of one walk, from position ``i`` at ``step``."""
    end = i + int(np.argmax(codes[i:] == _END))
    own, base = codes[i:end].tobytes(), 0
    moves = [row.tobytes() for row in _MOVES]
    n = len(own)
    while base < n:
        if (watch := _WATCHED.get(step)) is not None:
            slots[watch] = own[base]
            base += moves[step % _PERIOD][own[base]]
            step += 1
            continue
        k = int(np.searchsorted(_WATCHED_AT, step))
        until = int(_WATCHED_AT[k]) if k < len(_WATCHED_AT) else 1 << 62
        first = step % _PERIOD
        for row in moves[first:first + min(until - step, _PERIOD - first)]:
            step += 1
            base += row[own[base]]
            if base >= n:
                return


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, row by row."""
    return (a == b).mean(axis=1)


def _replace_end(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def with_successors(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    chars: int = 6_000_000) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is replaced by the next document's start.

    The next document is the one with the next lower id; after the least id
    (and after NULL ids, which sort last) comes the greatest.  Rows of equal
    ids are ordered by a hash of their text.  Rows are dealt to ranges that
    begin with ids of the table, and each range also gets the first row of
    the range after it, so no row needs a global window.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / n for k in range(1, n)] + [1.0]
    found = rows.select(F.percentile_approx("doc_id", shares, 100 * n)).first()[0] or []
    heads = np.array(sorted(set(found)), np.int64)  # ascending; each is the first id of its range

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            null = np.array(batch.column(0).is_null())
            values = np.where(null, 0, ids).astype(np.int64)
            k = len(heads) - 1 - np.searchsorted(heads, values) if len(heads) else np.zeros(len(values), np.int64)
            k = np.where(null, max(len(heads) - 1, 0), k)
            head = np.isin(values, heads) & ~null if len(heads) else np.arange(len(values)) >= 0
            before = (k - 1) % max(len(heads), 1)
            own = pa.record_batch([pa.array(k.astype(np.int32)), pa.array(np.zeros(len(k), np.int32)), *batch.columns],
                                  names=["part", "extra", "doc_id", "text"])
            yield own
            if head.any():
                at = np.flatnonzero(head)
                yield pa.record_batch([pa.array(before[at].astype(np.int32)), pa.array(np.ones(len(at), np.int32)),
                                       *batch.take(pa.array(at)).columns], names=["part", "extra", "doc_id", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # (extra, id, text) in order
        size = 0

        def done(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, size
            n_own = next((i for i, w in enumerate(waiting) if w[0]), len(waiting)) if last else len(waiting) - 1
            if last and n_own == len(waiting):  # only when every id is NULL
                waiting.append(waiting[0])
            if n_own > 0:
                texts = [w[2] for w in waiting[:n_own + 1]]
                edited = [_replace_end(a, b) for a, b in zip(texts, texts[1:])]
                prints = fingerprints(texts + edited)
                own, following, changed = prints[:n_own], prints[1:n_own + 1], prints[n_own + 1:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[1] for w in waiting[:n_own]], pa.int64()), pa.array([len(t) for t in texts[:n_own]], pa.int64()),
                     pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(_hex(own)),
                     pa.array(_hex(changed)), pa.array(likeness(own, changed)), pa.array(likeness(own, following))],
                    names=[c.split()[0] for c in _SCHEMA.split(", ")])
            waiting, size = waiting[n_own:], 0

        for batch in batches:
            for extra, doc, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                waiting.append((extra, doc, text or ""))
                size += len(text or "")
                if size > chars and not extra:
                    yield from done(False)
        if waiting:
            yield from done(True)

    dealt = rows.mapInArrow(deal, "part int, extra int, doc_id long, text string")
    return (dealt.repartitionById(max(len(heads), 1), F.col("part"))
            .sortWithinPartitions("extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
            .mapInArrow(compare, _SCHEMA).withColumnRenamed("doc_id", id_col))


def fingerprint_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, fingerprint) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in common.text_slices(batch, "text", 1 << 23):
                part = batch.slice(first, end - first)
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(_hex(fingerprints(texts)))],
                                                 names=["id", "text", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, text string, fingerprint string")


def segment_keys(text: str, most_edits: float = 0.2) -> np.ndarray:
    """Hashes of sampled segments: of the segments in each of ``SEGMENT_SLOTS`` hash classes, the least hash.

    Shorter texts have shorter segments.  A text that can be within
    ``most_edits`` of one in the next class of lengths is sampled for both.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    for k, (width, least) in enumerate(_SEGMENTS):
        until = _SEGMENTS[k + 1][1] if k + 1 < len(_SEGMENTS) else len(codes) + 1
        n = len(codes) - width + 1
        if n > 0 and least * (1 - most_edits) <= len(codes) < until:
            h = np.full(n, k + 1, np.uint64)
            for j in range(width):
                h = h * _SEGMENT_BASE + codes[j:j + n]
            h = common.mix64(h)
            slots = np.full(SEGMENT_SLOTS, _NO_SEGMENT)
            np.minimum.at(slots, (h % np.uint64(SEGMENT_SLOTS)).astype(np.int64), h)
            found.append(slots[slots != _NO_SEGMENT])
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance of two texts, or ``most + 1`` if it is more.

    Furthest-reaching diagonals, O(length + distance^2), as long as that is
    less work than bit-parallel columns, O(length^2 / word).
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    x, y = _points(a), _points(b)
    n = max(len(x), len(y))
    few = min(most, max(32, int((n * (0.5 + 0.00013 * n)) ** 0.5)))
    d = _by_diagonals(x, y, few)
    if d <= few:
        return d
    return _by_columns(x, y, most) if few < most else most + 1


def _by_diagonals(x: np.ndarray, y: np.ndarray, most: int) -> int:
    def slide(i: int, j: int) -> int:
        n, width = min(len(x) - i, len(y) - j), 64
        done = 0
        while done < n:
            w = min(width, n - done)
            unlike = np.flatnonzero(x[i + done:i + done + w] != y[j + done:j + done + w])
            if len(unlike):
                return done + int(unlike[0])
            done, width = done + w, 2 * width
        return n

    goal = len(y) - len(x)
    reach = {0: slide(0, 0)}  # diagonal (j - i) -> furthest i
    for d in range(most + 1):
        if reach.get(goal, -1) >= len(x):
            return d
        nearer = {}
        for k in range(-d - 1, d + 2):
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            i = min(i, len(x), len(y) - k)
            if i >= 0 and i + k >= 0:
                nearer[k] = i + slide(i, i + k)
        reach = nearer
    return most + 1


def _by_columns(x: np.ndarray, y: np.ndarray, most: int) -> int:
    """Whole columns of the distance table as bits of one integer; ends once the rest of ``y`` cannot bring it to ``most``."""
    m, n = len(x), len(y)
    at = {int(c): int.from_bytes(np.packbits(x == c, bitorder="little").tobytes(), "little") for c in np.unique(x)}
    every, last = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = every, 0, m
    for j, c in enumerate(y.tolist(), 1):
        same = at.get(c, 0)
        across = (((same & up) + up) ^ up) | same
        more, less = down | (every & ~(across | up)), up & across
        distance += 1 if more & last else -1 if less & last else 0
        if distance - (n - j) > most:
            return most + 1
        more, less, vertical = (more << 1 | 1) & every, (less << 1) & every, same | down
        up, down = less | (every & ~(vertical | more)), more & vertical
    return distance


def _unlike(a: str, b: str) -> int:
    """A lower bound of the edit distance: one edit takes at most one character away and adds at most one."""
    more = np.bincount(_points(a) & 1023, minlength=1024) - np.bincount(_points(b) & 1023, minlength=1024)
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", band_slots: int = 8,
                    most_edits: float = 0.2) -> DataFrame:
    """One row per document: id and component_id, the least id reachable over links.

    Two texts link when they share a band of ``band_slots`` slots or a sampled
    segment, and their edit distance is at most ``most_edits`` of the longer
    text.  Bands and segments are samples, so a pair that meets the distance is
    found with a probability (README: by edits and length), which does not fall
    with the length; no candidate is dropped for the size of its bucket or for
    its likeness.  Equal texts are one class and are compared once.  Empty texts are linked with nothing; a NULL id never
    names a component.
    """
    spark = docs.sparkSession

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [segment_keys(t, most_edits) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(k) for k in keys])),
                                              pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))], names=["node", "value"])

    table = common.materialise(
        fingerprint_table(docs, id_col=id_col, text_col=text_col)
        .withColumn("node", F.when(F.col("text") != "", F.xxhash64("text"))), "fingerprints")
    classes = table.where("node is not null").select("node", "text", "fingerprint").dropDuplicates(["node"])
    width = 2 * band_slots
    bands = [F.struct(F.lit(k).alias("band"), F.xxhash64(F.substring("fingerprint", 1 + k * width, width)).alias("value"))
             for k in range(SLOTS // band_slots)]
    buckets = classes.select("node", F.explode(F.array(*bands)).alias("b")).select("node", "b.band", "b.value")
    segments = classes.select("node", "text").mapInArrow(sampled, "node long, value long")
    buckets = buckets.unionByName(segments.select("node", F.lit(-1).alias("band"), "value"))
    least = buckets.groupBy("band", "value").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last")
    buckets = common.materialise(buckets.join(least.drop("last"), ["band", "value"]), "buckets")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, y, s, t in zip(*(c.to_pylist() for c in batch.columns[:4])):
                most = int(most_edits * max(len(s), len(t)))
                if abs(len(s) - len(t)) <= most and _unlike(s, t) <= most and edit_distance(s, t, most) <= most:
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def verified(pairs: DataFrame) -> DataFrame:
        own = classes.select(F.col("node").alias("x"), F.col("text").alias("xt"))
        other = classes.select(F.col("node").alias("y"), F.col("text").alias("yt"))
        met = pairs.distinct().join(own, "x").join(other, "y")
        return common.materialise(met.select("x", "y", "xt", "yt").repartition(n).mapInArrow(verify, "a long, b long"), "links")

    links = verified(buckets.where("node <> pivot").select(F.col("pivot").alias("x"), F.col("node").alias("y")))
    roots = connected_components(links)
    listed = (buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
              .join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root")), "pivot", "left")
              .withColumn("apart", F.col("root") != F.coalesce("pivot_root", "pivot")))
    listed = common.materialise(listed.select("band", "value", "node", "root", "apart", "pivot"), "listed")
    apart = listed.where("apart").select("band", "value", F.col("node").alias("x"), F.col("root").alias("x_root"))
    later = (listed.join(apart, ["band", "value"])
             .where((F.col("root") != F.col("x_root")) & (F.col("node") != F.col("pivot")) & (~F.col("apart") | (F.col("x") < F.col("node"))))
             .select("x", F.col("node").alias("y")))
    roots = connected_components(links.unionByName(verified(later)))
    members = table.select("id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = members.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    return members.join(least, "root", "left").select(
        F.col("id").alias(id_col), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))
