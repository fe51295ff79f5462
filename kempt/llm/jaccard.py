"""N-gram Jaccard join by T-occurrence search (DivideSkip) over word shingles.

Two sets are similar when ``den * |intersection| >= num * |union|``; then they
share at least ``T = ceil(num / (num + den) * (sizes))`` shingles.  DivideSkip
sets a query's longest inverted lists aside, merges the short ones with a
heap, keeps sets that occur in at least T minus the number of long lists, and
probes the long lists by binary search for those alone.

On the cluster this runs in three steps, all on classes of equal sets:

1. Lists are ordered short to long by a fixed-size count sketch of the whole
   corpus.  A set posts its ``|set| - T + 1`` shingles of the shortest lists;
   similar sets share at least one posted shingle.  The order only steers the
   work, any order gives the same result.
2. Every posted list is cut, in order of size, where a set is too large to be
   similar to the one before it.  Each set is paired with the least set of its
   run (lists that the sketch calls long are split over salts, and the salts'
   least sets are paired in turn), so the pairs grow with the lists and not
   with their squares.  DivideSkip searches each such pivot against its
   partners, block by block, over their whole texts.
3. Sets whose component differs from that of their list's pivot become
   queries against all other sets of the list.  Every pair of sets that share a
   posted shingle is thus searched or known to be connected.

NULL and empty texts have no shingles and are linked with nothing; repeated
rows are one set; a NULL id is kept as it is and never names a component.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.llm import common
from kempt.llm.components import connected_components, each
from kempt.llm.tokens import ragged

_STEP = common._random_table(23, 64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text: ``width`` lower-cased words, or all words where there are fewer."""
    lower = common.LOWER[data]
    starts, ends, first = common.words(lower, offsets)
    h = common.span_hashes(lower, starts, ends)
    total = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for j in range(width):
        total += h[j:j + len(total)] * _STEP[j]
    total = common.mix64(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = b - a
        if n >= width:
            out.append(np.unique(total[a:b - width + 1]))
        elif n:
            out.append(common.mix64((h[a:b] * _STEP[:n]).sum(keepdims=True) + _STEP[width + n]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def least_overlap(size: int, num: int, den: int) -> int:
    """Shingles a set of ``size`` shares at least with any similar set."""
    return -(-num * size // den)


class InvertedLists:
    """Inverted lists over a block of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[order], owner[order]

    def search(self, query: np.ndarray, num: int, den: int, long_weight: float = 0.01) -> list[int]:
        """Positions of the sets that are similar to the query, by DivideSkip."""
        need = -(-num * (len(query) + self.sizes) // (num + den))
        possible = (den * self.sizes >= num * len(query)) & (den * len(query) >= num * self.sizes) & (self.sizes > 0)
        if not len(query) or not possible.any():
            return []
        low, high = np.searchsorted(self.tokens, query, "left"), np.searchsorted(self.tokens, query, "right")
        length = high - low
        order = np.argsort(length, kind="stable")
        fewest = int(need[possible].min())
        n_long = min(fewest - 1, int(fewest / (long_weight * np.log2(max(int(length.max()), 2)) + 1)))
        short, long = order[:len(order) - n_long], order[len(order) - n_long:]
        lists = [self.owner[low[i]:high[i]].tolist() for i in short.tolist() if high[i] > low[i]]
        seen, counts = [], []
        for owner, group in groupby(heapq.merge(*lists)):
            count = sum(1 for _ in group)
            if possible[owner] and count >= need[owner] - n_long:
                seen.append(owner)
                counts.append(count)
        found = np.array(seen, np.int64)
        overlap = np.array(counts, np.int64)
        for i in long.tolist():
            if not len(found):
                break
            part = self.owner[low[i]:high[i]]
            at = np.searchsorted(part, found)
            overlap += (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == found) if len(part) else 0
        return found[overlap >= need[found]].tolist() if len(found) else []


def _set_id(s: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


_SKETCH_SLICES = 64
_BROADCAST_IDS = 1_000_000
_HOT_SETS = 10_000
#: Parity bitmap of a set: bit b is the parity of its shingles with b as last bits.  Two sets differ in at least as
#: many shingles as their bitmaps differ in bits, so unlike sets are told apart without their texts.
_BITMAP = [f"b{i}" for i in range(16)]
#: Sets of more shingles also have a bitmap of at least as many bits as shingles.
_WIDE_FROM = 1024
_MEMBERS = ("kind int, id long, n long, set_id long, " + ", ".join(f"{b} long" for b in _BITMAP)
            + ", wide binary, slice int, counts binary")
_NAMES = [c.split()[0] for c in _MEMBERS.split(", ")]


def _wide_bitmap(s: np.ndarray) -> bytes | None:
    if len(s) <= _WIDE_FROM:
        return None
    bits = 1 << (len(s) - 1).bit_length()
    parity = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").tobytes()


def _unlike(a: bytes, b: bytes) -> int:
    """Bits that two wide bitmaps differ in; the longer one is folded onto the shorter."""
    a, b = (np.frombuffer(x, np.uint64) for x in (a, b))
    n = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, n), axis=0) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _wide_filter(num: int, den: int):
    """Of pairs (query, node, size, qwide, wide), those whose wide bitmaps allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [q is None or w is None or _unlike(q, w) * (den + num) <= size * (den - num)
                    for size, q, w in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    bits = 64 * len(_BITMAP)
    parity = [np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1 for s in sets]
    return np.packbits(np.array(parity, np.uint8).reshape(len(sets), bits), axis=1).view(np.int64)


def _members_and_sketch(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        counts = np.zeros(1 << bits, np.uint16)
        waiting, n_waiting = [], 0

        def flush():
            nonlocal n_waiting
            if waiting:
                at, c = np.unique(np.concatenate(waiting), return_counts=True)
                counts[at] = np.minimum(counts[at].astype(np.int64) + c, 65535).astype(np.uint16)
                waiting.clear()
                n_waiting = 0

        any_rows = False
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch):
                sets = shingle_sets(data, offsets, width)
                n = end - first
                bitmaps = _bitmaps(sets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), batch.column(0).slice(first, n), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()),
                     *[pa.array(np.ascontiguousarray(bitmaps[:, i])) for i in range(len(_BITMAP))],
                     pa.array([_wide_bitmap(s) for s in sets], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=_NAMES)
                waiting.append((np.concatenate([*sets, np.zeros(0, np.uint64)]) >> np.uint64(64 - bits)).astype(np.uint32))
                n_waiting += len(waiting[-1])
                any_rows = True
                if n_waiting > 1_000_000:
                    flush()
        flush()
        if any_rows:
            step = len(counts) // _SKETCH_SLICES
            for k in range(_SKETCH_SLICES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([1], pa.int32()), *[pa.nulls(1, pa.int64())] * (3 + len(_BITMAP)), pa.nulls(1, pa.binary()),
                     pa.array([k], pa.int32()),
                     pa.array([zlib.compress(counts[k * step:(k + 1) * step].tobytes(), 1)], pa.binary())], names=_NAMES)

    return run


def _list_classes(rows: pd.DataFrame) -> pd.DataFrame:
    """0 for lists that the sketch calls short, else how many doublings they are over the bound."""
    total = sum(np.frombuffer(zlib.decompress(c), np.uint16).astype(np.float64) for c in rows["counts"])
    bound = total.mean() + 4 * np.sqrt(total.mean()) + 2  # beyond what chance puts into a counter
    over = np.where(total > bound, 1 + np.log2(np.maximum(total, bound) / bound), 0).astype(np.uint8)
    return pd.DataFrame({"slice": [int(rows["slice"].iloc[0])], "classes": [zlib.compress(over.tobytes(), 1)]})


def _postings(width: int, num: int, den: int, classes, bits: int, max_salt_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        own = np.concatenate([np.frombuffer(zlib.decompress(c), np.uint8) for c in classes.value])
        seen: set[int] = set()  # sets this task has posted; only spares repeated rows
        for batch in batches:
            for _, _, data, offsets in common.text_slices(batch):
                keys, ids, counts, salts, salted = [], [], [], [], []
                for s in shingle_sets(data, offsets, width):
                    if not len(s) or (set_id := _set_id(s)) in seen:
                        continue
                    seen.add(set_id)
                    n = len(s) - least_overlap(len(s), num, den) + 1
                    level = own[s >> np.uint64(64 - bits)]
                    chosen = np.argsort(level, kind="stable")[:n]
                    keys.append(s[chosen])
                    ids.append(set_id)
                    counts.append((n, len(s), int((level == 0).sum())))
                    salts.append((set_id & 0xFFFF) & ((1 << np.minimum(level[chosen], max_salt_bits).astype(np.int64)) - 1))
                    salted.append(level[chosen] > 0)
                if len(seen) > 500_000:
                    seen.clear()
                if ids:
                    posted = np.array(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(ids), posted[:, 0])),
                         pa.array(np.repeat(posted[:, 1], posted[:, 0]).astype(np.int32)),
                         pa.array(np.repeat(posted[:, 2], posted[:, 0]).astype(np.int32)),
                         pa.array(np.concatenate(salts).astype(np.int32)), pa.array(np.concatenate(salted))],
                        names=["key", "set_id", "n", "rare", "salt", "salted"])

    return run


def _verify(width: int, num: int, den: int):
    """Rows sorted by (query, block), the query's own text first: DivideSkip of the query over the block's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, query = None, np.zeros(0, np.uint64)
        for batch in batches:
            q = batch.column(0).to_numpy()
            block = batch.column(1).to_numpy()
            role = batch.column(2).to_numpy()
            node = batch.column(3).to_numpy()
            for first, end, data, offsets in common.text_slices(batch):
                sets = shingle_sets(data, offsets, width)
                change = np.flatnonzero((np.diff(q[first:end]) != 0) | (np.diff(block[first:end]) != 0)) + 1
                a, b = [], []
                for lo, hi in zip([0, *change.tolist()], [*change.tolist(), end - first]):
                    if role[first + lo] == 0:
                        current, query = (q[first + lo], block[first + lo]), sets[lo]
                        lo += 1
                    if current != (q[first + hi - 1], block[first + hi - 1]):
                        continue  # the query's text is gone: nothing to compare with
                    for i in InvertedLists(sets[lo:hi]).search(query, num, den):
                        a.append(q[first + lo])
                        b.append(node[first + lo + i])
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _search(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int, block_rows: int) -> DataFrame:
    """The pairs (query, node) that are similar, as edges (a, b); blocks of a query share its text."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = pairs.groupBy("query").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"))
    members = (pairs.join(blocks, "query")
               .select("query", F.expr("pmod(xxhash64(node), blocks)").cast("int").alias("block"), F.lit(1).alias("role"), "node"))
    heads = blocks.select("query", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(0).alias("role"),
                          F.col("query").alias("node"))
    roles = _known_size(common.materialise(members.unionByName(heads), "roles"))
    rows = texts.withColumnRenamed("set_id", "node").join(roles, "node")
    return (rows.select("query", "block", "role", "node", "text").repartition(n, "query", "block")
            .sortWithinPartitions("query", "block", "role").mapInArrow(common.task(_verify(width, num, den)), "a long, b long"))


def _with_set_id(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch):
                ids = [_set_id(s) if len(s) else None for s in shingle_sets(data, offsets, width)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), batch.column(1).slice(first, end - first)],
                                                 names=["set_id", "text"])

    return run


def _alike(num: int, den: int):
    """Whether sizes and bitmaps of a query (qn, q...) and a node (sn, ...) allow the similarity."""
    differ = sum((F.bit_count(F.col(f"q{b}").bitwiseXOR(F.col(b))) for b in _BITMAP), F.lit(0))
    return ((F.col("sn") * den >= F.col("qn") * num) & (F.col("qn") * den >= F.col("sn") * num)
            & (differ * (den + num) <= (F.col("sn") + F.col("qn")) * (den - num)))


def _as_query(sets: DataFrame) -> DataFrame:
    return sets.select(F.col("set_id").alias("query"), F.col("sn").alias("qn"), *[F.col(b).alias(f"q{b}") for b in _BITMAP],
                       F.col("wide").alias("qwide"))


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (query, node) whose sizes and bitmaps allow the similarity."""
    met = pairs.join(_as_query(sets), "query").join(sets.withColumnRenamed("set_id", "node"), "node").where(_alike(num, den))
    return (met.select("query", "node", (F.col("sn") + F.col("qn")).alias("size"), "qwide", "wide")
            .mapInArrow(common.task(_wide_filter(num, den)), "query long, node long"))


def _texts(rows: DataFrame, members: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Texts (set_id, text) of the sets in the pairs, one document each; their ids are broadcast only up to a checked number."""
    wanted = pairs.select(F.explode(F.array("node", "query")).alias("set_id")).distinct()
    wanted = common.materialise(wanted, "wanted", few=True)
    ids = members.join(wanted, "set_id").groupBy("set_id").agg(F.min("id").alias("id")).select("id")
    ids = _known_size(common.materialise(ids, "wanted-ids", few=True))
    with_set = common.task(_with_set_id(width))
    schema = "set_id long, text string"
    unnamed = rows.where("id is null").mapInArrow(with_set, schema).join(wanted, "set_id", "left_semi").dropDuplicates(["set_id"])
    return common.materialise(rows.join(ids, "id", "left_semi").mapInArrow(with_set, schema).unionByName(unnamed), "texts")


def _size_runs(lists: DataFrame, by: list[str], num: int, den: int) -> DataFrame:
    """``lists`` with ``pivot``, the first set of each row's run of sizes, and whether another row follows in the run."""
    order = Window.partitionBy(*by).orderBy("n", "set_id")
    begins = F.coalesce(F.lag("n").over(order) * den < F.col("n") * num, F.lit(True))
    marked = lists.withColumn("_first", F.when(begins, F.col("set_id")))
    return (marked.withColumn("pivot", F.last("_first", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("followed", F.coalesce(F.lead("n").over(order) * num <= F.col("n") * den, F.lit(False))).drop("_first"))


def similar_sets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80,
                 den: int = 100, sketch_bits: int = 24, max_salt_bits: int = 10,
                 block_rows: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(members, roots): every document's set (id, n, set_id), and (node, root) of all sets that have a link.

    ``set_id`` is a 64-bit digest of the shingle set, NULL where it is empty.
    ``sketch_bits`` fixes the size of the count sketch (and of what is
    broadcast, one byte a counter); raise it with the corpus.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    base = common.materialise(rows.mapInArrow(common.task(_members_and_sketch(width, sketch_bits)), _MEMBERS), "sets")
    members = base.where("kind = 0").select("id", "n", "set_id")
    sketch = (base.where("kind = 1").select("slice", "counts").groupBy("slice")
              .applyInPandas(_list_classes, "slice int, classes binary").orderBy("slice").collect())  # a fixed size
    if not sketch:
        return members, members.select(F.col("set_id").alias("node"), F.col("set_id").alias("root"))
    classes = spark.sparkContext.broadcast([bytes(r.classes) for r in sketch])

    postings = rows.mapInArrow(common.task(_postings(width, num, den, classes, sketch_bits, max_salt_bits)),
                               "key long, set_id long, n int, rare int, salt int, salted boolean")
    lists = common.materialise(
        _size_runs(postings, ["key", "salt"], num, den).where("set_id <> pivot or followed or salted")
        .select("key", "set_id", "n", "rare", "salt", "salted", "pivot"), "lists")
    # In long lists the pivot is the set with the fewest rare shingles, which is the least edited of a family of
    # copies; each salt has its own, and the least of them all is the list's.
    fewest = F.min(F.struct("rare", "set_id"))
    hot = lists.where("salted").withColumn("_p", fewest.over(Window.partitionBy("key", "salt", "pivot")))
    hot = hot.select("key", "set_id", "n", "salted", F.col("_p.set_id").alias("pivot"), F.col("_p.rare").alias("pivot_rare"))
    lists = common.materialise(lists.where("not salted").select("key", "set_id", "n", "salted", "pivot", F.lit(0).alias("pivot_rare"))
                               .unionByName(hot), "pivoted-lists")
    heads = lists.where("salted").select("key", "pivot", F.col("pivot_rare").alias("rare")).distinct()
    tops = (heads.withColumn("_t", F.min(F.struct("rare", "pivot")).over(Window.partitionBy("key")))
            .select("key", "pivot", F.col("_t.pivot").alias("top")))
    sets = common.materialise(base.where("kind = 0 and n > 0").select("set_id", F.col("n").alias("sn"), *_BITMAP, "wide")
                              .dropDuplicates(["set_id"]), "distinct-sets")
    pairs = (lists.where("set_id <> pivot").select(F.col("pivot").alias("query"), F.col("set_id").alias("node"))
             .unionByName(tops.where("pivot <> top").select(F.col("top").alias("query"), F.col("pivot").alias("node"))))
    pairs = common.materialise(_possible(pairs.distinct(), sets, num, den), "pairs")
    edges = common.materialise(_search(pairs, _texts(rows, members, pairs, width), width, num, den, block_rows), "links")
    roots = connected_components(edges)

    # whoever is not yet connected with its run's pivot is searched against the whole list
    of_set = roots.select(F.col("node").alias("set_id"), F.col("root").alias("set_root"))
    of_pivot = roots.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    unit = math.log(den / num) * 1.001  # similar sets are in the same size class or in neighbouring ones

    def listed(rows: DataFrame, by: str) -> DataFrame:
        rows = rows.join(of_set, "set_id", "left").join(of_pivot, "pivot", "left").select(
            F.col(by).alias("by"), "set_id", "n", F.coalesce("set_root", "set_id").alias("root"),
            F.coalesce("pivot_root", "pivot").alias("pivot_root"))
        return common.materialise(rows.select("by", "set_id", "n", "root", (F.col("root") != F.col("pivot_root")).alias("apart"),
                                              F.floor(F.log("n") / unit).alias("class")), "listed")

    def against_all(listed: DataFrame, more) -> DataFrame:
        apart = listed.where("apart").select("by", F.col("set_id").alias("query"), F.col("n").alias("qn"),
                                             F.col("root").alias("query_root"),
                                             F.explode(F.expr("array(class - 1, class, class + 1)")).alias("class"))
        fits = (F.col("n") * den >= F.col("qn") * num) & (F.col("qn") * den >= F.col("n") * num)
        other = (F.col("root") != F.col("query_root")) & (~F.col("apart") | (F.col("query") < F.col("set_id")))
        return more(listed, apart, fits & other).select("query", F.col("set_id").alias("node")).distinct()

    short = listed(lists.where("not salted").select("key", "set_id", "n", "pivot").distinct(), "key")
    # the long lists of one pivot are one group: its sets meet once and not once per list
    long = listed(lists.where("salted").join(tops, ["key", "pivot"]).select("set_id", "n", F.col("top").alias("pivot")).distinct(), "pivot")
    bits = sets.drop("wide")
    later = (against_all(short, lambda a, b, on: a.join(b, ["by", "class"]).where(on))
             .unionByName(against_all(long, lambda a, b, on: a.join(bits, "set_id").join(
                 b.join(_as_query(bits.withColumn("wide", F.lit(None))).drop("qn"), "query"), ["by", "class"]).where(on & _alike(num, den)))))
    known = each(pairs, ("query", "node"), ("node", "query")).toDF("query", "node")
    later = common.materialise(_possible(later.distinct().join(known, ["query", "node"], "left_anti"), sets, num, den), "later")
    if not later.isEmpty():
        more = _search(later, _texts(rows, members, later, width), width, num, den, block_rows)
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = connected_components(links.unionByName(more))
    return members, roots


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the least id reachable over links, itself included)."""
    members, roots = similar_sets(docs, id_col=id_col, **options)
    # components are worked out over distinct sets: a family of copies is one row of it
    sets = members.where("set_id is not null").groupBy("set_id").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    sets = sets.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    sets = common.materialise(sets, "set-roots")
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.materialise(sets.join(least, "root").select("set_id", "copies", "component_id"), "set-components")
    # the copies of one text may be a third of all rows: sets of many copies, _HOT_SETS at most, go to their members by broadcast
    many = F.col("copies") > max(1000, members.count() // _HOT_SETS)
    hot = F.broadcast(named.where(many).drop("copies"))
    cold = named.where(~many).drop("copies")
    found = (members.join(hot, "set_id").unionByName(
        members.join(hot, "set_id", "left_anti").join(cold, "set_id", "left")))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.when(F.col("set_id").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _named_sets(width: int, at: int):
    """Rows with the digest of their shingle set as a further last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in common.text_slices(batch, batch.schema.names[at]):
                own = batch.slice(first, end - first)
                ids = [_set_id(s) if len(s) else None for s in shingle_sets(data, offsets, width)]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(ids, pa.int64())], names=[*own.schema.names, "_set_id"])

    return run


def keep_representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, **options) -> DataFrame:
    """One row of each component of similar rows, all columns: the one with the least id, of equal ids that with the least set digest.

    Where an id repeats, its rows are told apart by their shingle sets: unlike
    texts under one id are documents of their own, and of equal ones one stays.
    Rows without shingles, and rows without an id, are kept.
    """
    members, roots = similar_sets(docs, id_col=id_col, text_col=text_col, width=width, **options)
    roots = roots.withColumnRenamed("node", "set_id")
    # a family of copies is one set: rows are counted per set before any key of many rows is joined
    sets = (members.where("set_id is not null and id is not null").groupBy("set_id").agg(F.min("id").alias("least"))
            .join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")))
    best = F.min(F.struct("least", "set_id"))
    heads = sets.groupBy("root").agg(best.alias("_b")).select(F.col("_b.least").alias("id"), F.col("_b.set_id").alias("set_id"))
    heads = common.materialise(heads, "representatives", few=True)
    ids = members.where("id is not null").groupBy("id").agg(
        F.count("*").alias("rows"), F.max(F.col("set_id").isNull()).alias("bare"))
    ids = common.materialise(ids.join(heads.select("id", F.lit(True).alias("head")).distinct(), "id", "left"), "stays", few=True)
    gone = _known_size(ids.where("rows = 1 and head is null and not bare").select(F.col("id").alias("_id")))
    repeated = _known_size(ids.where("rows > 1").select(F.col("id").alias("_id")))
    own = F.col(id_col).cast("long")
    once = docs.join(gone, own == F.col("_id"), "left_anti").join(repeated, own == F.col("_id"), "left_anti")
    many = docs.join(repeated, own == F.col("_id"), "left_semi")
    schema = T.StructType([*many.schema.fields, T.StructField("_set_id", T.LongType())])
    many = many.mapInArrow(common.task(_named_sets(width, docs.columns.index(text_col))), schema)
    chosen = heads.select(F.col("id").alias("_id"), F.col("set_id").alias("_head"))
    named = many.join(chosen, (own == F.col("_id")) & (F.col("_set_id") == F.col("_head")), "left_semi").dropDuplicates([id_col, "_set_id"])
    return once.unionByName(named.drop("_set_id")).unionByName(many.where("_set_id is null").drop("_set_id")).select(docs.columns)


def _known_size(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= _BROADCAST_IDS else ids
