"""Chained remaps: maps applied one after the other, and maps whose targets are themselves moved.

A clean-up that runs in several stages moves a member more than once: ``a -> b``
in one stage, ``b -> c`` in a later one.  Remapping the children after every
stage reads them once a stage.  Here the maps are composed first and the
children are remapped once.

* ``compose_in_sequence`` composes stage maps pairwise, in a tree: the depth of
  the plan is the logarithm of the number of stages.
* ``resolve_chains`` follows one map to the end by pointer doubling: after r
  joins every pointer stands 2^r steps further, so the joins grow with the
  logarithm of the longest chain.  Pointers that never end lead into a cycle;
  these are recognised by a round that ends none of the open pointers, and
  reported with the cycle's smallest id.

Every round is written to the shared checkpoint folder, so a lost executor
repeats one round at most, and only open pointers are joined again: a final
target that a third of the members share is looked up once and is then out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.operators.broadcast import DEFAULT_MAX_ROWS, bounded_by_rows
from kempt.operators.dimension import remap_foreign_key
from kempt.session import cut_lineage


def as_function(mapping: DataFrame, source: str = "source_id", target: str = "target_id") -> DataFrame:
    """``(source_id, target_id)``, one row a source; raises where a source has two targets.

    Repeated rows collapse, rows without a source are dropped, and so are
    members that map to themselves (they do not move).
    """
    per = (mapping.where(F.col(source).isNotNull()).groupBy(F.col(source).alias("source_id"))
           .agg(F.min(target).alias("target_id"), F.max(target).alias("_other"),
                (F.count(F.lit(1)) - F.count(target)).alias("_nulls"), F.count(target).alias("_set")))
    per = cut_lineage(per)
    conflicts = per.where((F.col("target_id") != F.col("_other")) | ((F.col("_nulls") > 0) & (F.col("_set") > 0)))
    n = conflicts.count()
    if n:
        raise ValueError(f"{n} sources have more than one target, e.g. {conflicts.agg(F.min('source_id')).first()[0]}")
    return (per.where(~F.col("target_id").eqNullSafe(F.col("source_id"))).select("source_id", "target_id"))


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """The map that applies ``first``, then ``second`` (each unique per source)."""
    b = second.select(F.col("source_id").alias("_s"), F.col("target_id").alias("_t"))
    moved = first.join(b, F.col("target_id") == F.col("_s"), "left").select(
        "source_id", F.when(F.col("_s").isNotNull(), F.col("_t")).otherwise(F.col("target_id")).alias("target_id"))
    return moved.unionByName(second.join(first.select("source_id"), "source_id", "left_anti").select("source_id", "target_id"))


def compose_in_sequence(maps: Sequence[DataFrame], source: str = "source_id", target: str = "target_id") -> DataFrame:
    """One map for a list of stage maps, in order; members that come back to themselves are left out."""
    level = [as_function(m, source, target) for m in maps]
    if not level:
        raise ValueError("no maps")
    while len(level) > 1:
        pairs = [compose(a, b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(level) - len(level) % 2:]
    return level[0].where(~F.col("target_id").eqNullSafe(F.col("source_id")))


@dataclass(frozen=True)
class ChainResolution:
    """A map followed to its ends."""

    resolved: DataFrame   # source_id, target_id, n_hops: every source whose chain ends
    cyclic: DataFrame     # source_id, cycle_id (smallest id of the cycle), on_cycle
    rounds: int           # joins spent on following the chains
    n_sources: int
    n_cyclic: int

    def report(self) -> DataFrame:
        """All sources: target and hops, or the cycle that they lead into."""
        none = F.lit(None).cast("bigint")
        ends = self.resolved.select("source_id", "target_id", "n_hops", F.lit(None).cast(self.cyclic.schema["cycle_id"].dataType).alias("cycle_id"),
                                    F.lit(False).alias("on_cycle"))
        loops = self.cyclic.select("source_id", F.lit(None).cast(self.resolved.schema["target_id"].dataType).alias("target_id"),
                                   none.alias("n_hops"), "cycle_id", "on_cycle")
        return ends.unionByName(loops)

    def remap(self, child: DataFrame, fk: str, broadcast_max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
        """Child rows moved straight to the end of their chain; keys that lead into a cycle stay."""
        return remap_foreign_key(child, fk, bounded_by_rows(self.resolved.select("source_id", "target_id"), self.n_sources, broadcast_max_rows))


def resolve_chains(mapping: DataFrame, source: str = "source_id", target: str = "target_id") -> ChainResolution:
    """Follow ``mapping`` until the target is no source; an empty map has no rows, a NULL target is an end."""
    edges = cut_lineage(as_function(mapping, source, target))
    n_sources = edges.count()
    pointers = edges.select("source_id", F.col("target_id").alias("at"), F.lit(1).cast("bigint").alias("hops"), F.lit(False).alias("done"))
    open_rows, rounds = n_sources, 0
    while open_rows:
        ahead = pointers.select(F.col("source_id").alias("_id"), F.col("at").alias("_at"), F.col("hops").alias("_hops"), F.col("done").alias("_done"))
        stepped = (pointers.where("not done").join(ahead, F.col("at") == F.col("_id"), "left")
                   .select("source_id", F.when(F.col("_id").isNull(), F.col("at")).otherwise(F.col("_at")).alias("at"),
                           (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"), F.coalesce("_done", F.lit(True)).alias("done")))
        pointers = cut_lineage(pointers.where("done").unionByName(stepped))
        left = pointers.where("not done").count()
        rounds += 1
        if left == open_rows:  # chains that end do so from their end: a round without an end leaves cycles only
            break
        open_rows = left
    resolved = pointers.where("done").select("source_id", F.col("at").alias("target_id"), F.col("hops").alias("n_hops"))
    loose = edges.join(pointers.where("not done").select("source_id"), "source_id", "left_semi")
    return ChainResolution(resolved, _cycles(loose, open_rows), rounds, n_sources, open_rows)


def _cycles(edges: DataFrame, n: int) -> DataFrame:
    """Sources whose steps never end, with the smallest id of their cycle: pointers doubled until each has gone n steps."""
    ahead = edges.select("source_id", F.col("target_id").alias("at"), F.col("source_id").alias("low"))
    for _ in range(max(n - 1, 0).bit_length() if n else 0):
        other = ahead.select(F.col("source_id").alias("_id"), F.col("at").alias("_at"), F.col("low").alias("_low"))
        ahead = cut_lineage(ahead.join(other, F.col("at") == F.col("_id")).select(
            "source_id", F.col("_at").alias("at"), F.least("low", "_low").alias("low")))
    on_cycle = ahead.select(F.col("at").alias("_id")).distinct()
    low = ahead.join(on_cycle, F.col("source_id") == F.col("_id"), "left_semi").select(F.col("source_id").alias("_id"), F.col("low").alias("cycle_id"))
    named = ahead.join(low, F.col("at") == F.col("_id")).select("source_id", "cycle_id")
    return named.join(on_cycle, F.col("source_id") == F.col("_id"), "left").select("source_id", "cycle_id", F.col("_id").isNotNull().alias("on_cycle"))
