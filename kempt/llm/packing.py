"""Harmonic packing: fixed counts per bin in reciprocal-capacity classes.

A document's ids are cut into pieces whose lengths are exactly
``floor(capacity / k)``: first full sequences, then repeatedly the longest such
length that fits the rest.  A piece of class k lies in a bin of exactly k
pieces, so workers fill bins without seeing each other: a piece's bin and
slot follow from its rank in its class, which is its rank within its input
partition plus the prefix sum of the partitions' counts.  Per class only the
last bin can be short; those few pieces (fewer than capacity tokens a class,
whatever the input) are packed first-fit decreasing.

Slack of a full bin is ``capacity - k * floor(capacity / k)`` tokens, under
1.2 % at 2048.  NULL texts are empty: one piece with the end id.  NULL ids are
kept as NULL and repeated rows are packed once each.  A very long text gives as
many pieces as it needs; pieces of equal length are placed in the order of
their ranks; an empty table gives no rows; further columns, whatever their
names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm import common, tokens

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "k long, part long, local_rank long")


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: full sequences, then reciprocal lengths."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // (rest + 1) + 1  # the fewest per bin whose share fits the rest
        lengths.append(capacity // k)
        rest -= lengths[-1]
    return lengths


def token_pieces(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece with its class and its rank in the class within the input partition."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokens.encoder(tokenizer), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            for first, end, _, _ in common.text_slices(batch, "text", tokens.SLICE_BYTES):
                rows = batch.slice(first, end - first)
                flat, at = encode.encode(rows.column(1).to_pylist())
                out: dict[str, list] = {name.split()[0]: [] for name in PIECES.split(", ")}
                if with_ids:
                    out["ids"] = []
                for i, doc in enumerate(rows.column(0).to_pylist()):
                    ids = np.append(flat[at[i]:at[i + 1]], end_id).astype("<u4")
                    start = 0
                    for length in cut_lengths(len(ids), capacity):
                        own = ids[start:start + length]
                        k = capacity // length
                        rank = seen.get(k, 0)
                        seen[k] = rank + 1
                        for name, value in zip(out, (doc, start, length, zlib.crc32(own.tobytes()), len(ids), k,
                                                     part, rank)):
                            out[name].append(value)
                        if with_ids:
                            out["ids"].append(own.astype(np.int64))
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.list_(pa.int64()) if n == "ids" else pa.int64()) for n, v in out.items()],
                    names=list(out))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(common.task(pieces), PIECES + (", ids array<long>" if with_ids else ""))


def _first_fit(capacity: int):
    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "part", "k", "local_rank"], ascending=[False, True, True, True])
        free: list[int] = []
        bins, offsets = [], []
        lowest = 0  # bins before it are full
        for length in pieces["length"]:
            while lowest < len(free) and free[lowest] == 0:
                lowest += 1
            at = next((i for i in range(lowest, len(free)) if free[i] >= length), len(free))
            if at == len(free):
                free.append(capacity)
            bins.append(at)
            offsets.append(capacity - free[at])
            free[at] -= length
        return pieces.assign(sequence_id=bins, offset=offsets).astype({"sequence_id": "int64", "offset": "int64"})

    return pack


def pack(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Place every id of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Sequences are numbered class by class, full bins first; those of the
    short last bins come after all others.
    """
    pieces = common.materialise(
        token_pieces(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity, id_col=id_col, text_col=text_col,
                     with_ids=with_ids), "pieces")
    counts = pieces.groupBy("k", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("k", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # one row per class (at most 2 * sqrt(capacity) of them)
    totals = counts.groupBy("k").agg(F.sum("n").alias("total")).withColumn("bins", F.expr("total div k"))
    earlier = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    classes = totals.select("k", "bins", F.coalesce(F.sum("bins").over(earlier), F.lit(0)).alias("first_bin"),
                            F.sum("bins").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding,
                                                                               Window.unboundedFollowing)).alias("full_bins"))

    ranked = (pieces.join(bases, ["k", "part"]).join(F.broadcast(classes), "k")
              .withColumn("rank", F.col("base") + F.col("local_rank"))
              .withColumn("bin", F.expr("rank div k")))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    placed = (ranked.where("bin < bins").withColumn("sequence_id", F.col("first_bin") + F.col("bin"))
              .withColumn("offset", (F.col("rank") % F.col("k")) * F.col("length")).select(out))
    rest = ranked.where("bin >= bins").select(*pieces.columns, "full_bins")
    # less than one sequence of tokens per class, however large the input
    schema = ", ".join(f"{n} {t}" for n, t in [*rest.dtypes, ("sequence_id", "long"), ("offset", "long")])
    short = (rest.groupBy().applyInPandas(_first_fit(capacity), schema)
             .withColumn("sequence_id", F.col("sequence_id") + F.col("full_bins")).select(out))
    return placed.unionByName(short)
