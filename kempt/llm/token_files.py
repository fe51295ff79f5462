"""Token-ID / binary output: flat unsigned integer files plus 64-bit document offsets, memory-mapped.

Documents are range-partitioned by id and each partition writes one shard
into the folder: ``<shard>.bin`` (little-endian unsigned ids, the smallest
width that holds the vocabulary), ``<shard>.idx`` (uint64 offsets of its
documents, one more than documents) and ``<shard>.docs`` (Arrow file of the
document ids).  A manifest table lists the shards of the successful task
attempts, and each shard's base is the prefix sum of the token counts before
it, so no file is rewritten to make positions global.

Files of failed attempts are never listed, hence never read.  A NULL text is
the empty text (its end id alone); NULL ids sort last; rows with equal ids
follow each other by a hash of the text; empty tables give no shard.  A text of
any length is one run of ids; further columns, whatever their names, are not
read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kempt.llm import common, tokens

MANIFEST = "shard long, base_name string, n_docs long, n_tokens long, width int"


def _filesystem(folder: str):
    if folder.startswith("/"):
        folder = f"file://{folder}"
    return pafs.FileSystem.from_uri(folder)


def _read(fs, path: str, dtype) -> np.ndarray:
    """A memory map where the store is a local or mounted one, the file's bytes elsewhere."""
    if isinstance(fs, pafs.LocalFileSystem):
        import os

        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.readall(), dtype)


def write_token_files(docs: DataFrame, folder: str, *, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encode every whole text, append ``end_id``, and write shards in ascending id order.

    Returns the manifest (one row per shard, with ``base``: all ids before it),
    which is also kept as ``<folder>/manifest``.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        encode = tokens.encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        ids, offsets, out, done = [], [np.zeros(1, np.uint64)], None, 0
        for batch in batches:
            for first, end, _, _ in common.text_slices(batch, "text", tokens.SLICE_BYTES):
                part = batch.slice(first, end - first)
                flat, at = encode.encode(part.column(1).to_pylist())
                ends = at[1:] + np.arange(1, len(at))  # each with its end id
                whole = np.full(len(flat) + len(part), end_id, encode.dtype)
                mask = np.ones(len(whole), bool)
                mask[ends - 1] = False
                whole[mask] = flat
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}.bin")
                out.write(whole.astype(whole.dtype.newbyteorder("<")).tobytes())
                offsets.append((ends + done).astype(np.uint64))
                ids.append(part.column(0).cast(pa.int64()))
                done += len(whole)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{root}/{name}.idx") as f:
            f.write(np.concatenate(offsets).astype("<u8").tobytes())
        column = pa.concat_arrays(ids)
        with fs.open_output_stream(f"{root}/{name}.docs") as f, pa.ipc.new_file(f, pa.schema([("id", pa.int64())])) as w:
            w.write_batch(pa.record_batch([column], names=["id"]))
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "base_name": [name], "n_docs": [len(column)], "n_tokens": [done],
             "width": pa.array([np.dtype(encode.dtype).itemsize], pa.int32())})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_last()]
    manifest = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order, F.xxhash64("text"))
                .mapInArrow(common.task(write), MANIFEST))
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Shards with their bases; one row per shard, so one task sums them."""
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, *, with_ids: bool = False) -> DataFrame:
    """One row per document read back from the files: id, start, n_tokens, ids_crc32 (and its ids)."""
    schema = "id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                stem = f"{root}/{row['base_name']}"
                flat, at = _read(fs, f"{stem}.bin", f"<u{row['width']}"), _read(fs, f"{stem}.idx", "<u8").astype(np.int64)
                with fs.open_input_file(f"{stem}.docs") as f:
                    ids = pa.ipc.open_file(f).read_all().column("id").combine_chunks()
                for i in range(0, len(ids), 4096):
                    k = range(i, min(i + 4096, len(ids)))
                    texts = [flat[at[j]:at[j + 1]] for j in k]
                    out = {"id": ids.slice(i, len(k)), "start": at[i:k.stop] + row["base"],
                           "n_tokens": np.diff(at[i:k.stop + 1]),
                           "ids_crc32": [zlib.crc32(t.astype("<u4").tobytes()) for t in texts]}
                    if with_ids:
                        out["ids"] = [t.astype(np.int64) for t in texts]
                    yield pa.RecordBatch.from_pydict(out)

    manifest = read_manifest(spark, folder)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "shard").mapInArrow(read, schema)
