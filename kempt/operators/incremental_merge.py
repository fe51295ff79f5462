"""A dimension clean-up that is kept and updated from changes.

``plan_dimension_merge`` works out every member's survivor from all members.
A member's target depends only on the members that share its match name: the
survivor of the name, or, for a composite whose prefix names no clean member,
the least id of its own full name, which has the same prefix.  So when some
members are added, changed or removed, only the names they have or had are
worked out again.

The kept map is stored in buckets of the match name, each version of a bucket
in a folder of its own, with a manifest that says which version of which bucket
counts.  An update reads the buckets of the touched names, writes new versions
of these and then the next manifest; other buckets are neither read nor
written.  A run that dies before its manifest changes nothing, and readers of
the older manifest are not disturbed.

Ids of changed members lead to their old names through an index of the same
kind, bucketed by id.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.operators.dimension import plan_dimension_merge
from kempt.session import cut_lineage

_BUCKET, _MATCH = "_bucket", "_match"
_MANIFEST = "version long, kind string, bucket int, folder string"


def _bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class KeptMerge:
    """A stored survivor map under ``root`` (shared storage)."""

    spark: SparkSession
    root: str
    id_col: str
    name_col: str
    placeholder: tuple
    schema: T.StructType  # of the dimension
    delim: str = ","
    buckets: int = 64

    # -- storage ------------------------------------------------------------
    def _manifest(self) -> list:
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifests").collect()  # at most 2 * buckets a version
        last = max(r["version"] for r in rows)
        return [r for r in rows if r["version"] == last]

    def _map_schema(self) -> T.StructType:
        extra = [T.StructField("_cls", T.StringType()), T.StructField("_key", T.StringType()), T.StructField("_st", T.StringType()),
                 T.StructField("_target", self.schema[self.id_col].dataType), T.StructField(_MATCH, T.StringType())]
        return T.StructType([*self.schema.fields, *extra])

    def _read(self, manifest: list, kind: str, schema: T.StructType, only: Sequence[int] | None = None) -> DataFrame:
        folders = [f"{self.root}/{r['folder']}/{_BUCKET}={r['bucket']}" for r in manifest
                   if r["kind"] == kind and (only is None or r["bucket"] in set(only))]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _write(self, df: DataFrame, kind: str, key: str) -> dict[int, str]:
        """Write buckets into a fresh folder; a bucket without rows has no entry."""
        folder = f"{kind}-{uuid.uuid4().hex}"
        bucketed = df.withColumn(_BUCKET, _bucket(F.col(key), self.buckets))
        bucketed.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
        written = self.spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{self.root}/{folder}")
        return {r[0]: folder for r in written.select(_BUCKET).distinct().collect()}  # at most ``buckets``

    def _publish(self, entries: list[tuple]) -> None:
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifests")

    # -- use ----------------------------------------------------------------
    def _plan(self, members: DataFrame) -> DataFrame:
        merge = plan_dimension_merge(members.select(self.schema.fieldNames()), self.id_col, self.name_col, placeholder=dict(self.placeholder),
                                     delim=self.delim, materialize=False)
        return merge.mapping.withColumn(_MATCH, F.coalesce("_key", F.lit(""))).select(self._map_schema().fieldNames())

    def create(self, dim: DataFrame) -> None:
        """Work out and store the first version from all members."""
        mapping = cut_lineage(self._plan(dim))
        kept = self._write(mapping, "map", _MATCH)
        index = self._write(mapping.select(self.id_col, _MATCH), "ids", self.id_col)
        self._publish([(0, "map", b, f) for b, f in kept.items()] + [(0, "ids", b, f) for b, f in index.items()] + [(0, "none", -1, "")])

    def mapping(self) -> DataFrame:
        """Every member with its class, clean name and target, as ``plan_dimension_merge`` gives it."""
        return self._read(self._manifest(), "map", self._map_schema()).drop(_MATCH)

    def moved(self) -> DataFrame:
        """``(source_id, target_id)`` of the members that disappear."""
        return self.mapping().where(F.col("_target") != F.col(self.id_col)).select(F.col(self.id_col).alias("source_id"), F.col("_target").alias("target_id"))

    def update(self, upserts: DataFrame, deleted_ids: DataFrame | None = None) -> int:
        """Bring the map up to date with added or changed members and removed ids; returns the buckets that were rewritten.

        One row per id in ``upserts``; an id that is also removed is removed.
        Unknown removed ids are ignored.
        """
        manifest = self._manifest()
        version = manifest[0]["version"] + 1
        ids_schema = T.StructType([self.schema[self.id_col], T.StructField(_MATCH, T.StringType())])
        gone = (deleted_ids.select(self.id_col) if deleted_ids is not None else upserts.select(self.id_col).limit(0)).distinct()
        fresh = cut_lineage(self._plan(upserts.join(gone, self.id_col, "left_anti").select(self.schema.fieldNames())))
        changed = cut_lineage(fresh.select(self.id_col).unionByName(gone).distinct())
        id_buckets = [r[0] for r in changed.select(_bucket(F.col(self.id_col), self.buckets)).distinct().collect()]
        index = self._read(manifest, "ids", ids_schema, id_buckets)
        old_names = index.join(changed, self.id_col, "left_semi").select(_MATCH)
        names = cut_lineage(old_names.unionByName(fresh.select(_MATCH)).distinct())
        name_buckets = [r[0] for r in names.select(_bucket(F.col(_MATCH), self.buckets)).distinct().collect()]

        stored = self._read(manifest, "map", self._map_schema(), name_buckets).join(changed, self.id_col, "left_anti")
        touched = stored.join(names, _MATCH, "left_semi")
        mapping = self._plan(touched.select(self.schema.fieldNames()).unionByName(fresh.select(self.schema.fieldNames())))
        kept = self._write(mapping.unionByName(stored.join(names, _MATCH, "left_anti").select(mapping.columns)), "map", _MATCH)
        index = self._write(index.join(changed, self.id_col, "left_anti").unionByName(fresh.select(self.id_col, _MATCH)), "ids", self.id_col)

        entries = [(version, r["kind"], r["bucket"], r["folder"]) for r in manifest
                   if not (r["kind"] == "map" and r["bucket"] in name_buckets) and not (r["kind"] == "ids" and r["bucket"] in id_buckets)]
        entries += [(version, "map", b, f) for b, f in kept.items()] + [(version, "ids", b, f) for b, f in index.items()]
        self._publish(entries)
        return len(name_buckets)


def kept_merge(spark: SparkSession, root: str, dim: DataFrame, id_col: str, name_col: str, *, placeholder: dict, delim: str = ",",
               buckets: int = 64) -> KeptMerge:
    """Create a kept merge of ``dim`` under the fresh folder ``root``."""
    out = KeptMerge(spark, root, id_col, name_col, tuple(placeholder.items()), T.StructType(
        [T.StructField(f.name, f.dataType) for f in dim.schema.fields]), delim, buckets)
    out.create(dim)
    return out
