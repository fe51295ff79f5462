"""A cleaning stage: transform -> publish a new snapshot -> verify it.

This is the reference's "inspect, fix, verify" loop for one dimension, re-cut
as one Spark stage.  The survivor map is materialised once in the shared
checkpoint folder and then feeds every consumer (cleaned dimension, each
remapped child table, the removal log); the outputs are written together as a
new snapshot directory, with row counts observed during the write; and the
verification checks (new duplicates, orphans) run against what was written,
not against the lineage that produced it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.operators import checks, dimension, rules
from kempt.sources import snapshot


@dataclass
class StageResult:
    """Where the snapshot was published, its row counts and its verification report."""

    root: str
    row_counts: dict[str, int]
    verification: DataFrame   # (check_name, issue_count); all zero when the stage is clean


def clean_dimension_stage(spark: SparkSession, *, dimension_name: str, dim: DataFrame, id_col: str,
                          name_col: str, placeholder: dict, children: Mapping[str, tuple[DataFrame, str]],
                          out_root: str, name_rules: Sequence[rules.Rule] = (),
                          delim: str = ",") -> StageResult:
    """Merge a dimension, remap its children, repair names, publish and verify.

    ``children`` maps child table name -> (DataFrame, foreign-key column).
    ``out_root`` must be a fresh folder on storage every executor can reach.
    """
    merge = dimension.plan_dimension_merge(dim, id_col, name_col, placeholder=placeholder, delim=delim,
                                           materialize=True)
    clean = merge.dimension()
    if name_rules:
        clean = rules.apply_rules(clean, list(name_rules))
    tables = {dimension_name: clean, f"{dimension_name}__removed": merge.removed()}
    for name, (child, fk) in children.items():
        tables[name] = merge.remap(child, fk)
    counts = snapshot.write_snapshot(tables, out_root)

    written = snapshot.read_snapshot(spark, out_root, list(tables))
    dup = checks.duplicate_summary(checks.duplicate_groups(written[dimension_name], [name_col])).select(
        F.lit(f"{dimension_name}: duplicate names").alias("check_name"),
        F.col("duplicate_groups").alias("issue_count"))
    parts = [dup]
    for name, (_child, fk) in children.items():
        parts.append(checks.orphan_count(written[name], fk, written[dimension_name], id_col).select(
            F.lit(f"{name}.{fk} -> {dimension_name}.{id_col}: orphans").alias("check_name"),
            F.col("orphan_rows").alias("issue_count")))
    verification = parts[0]
    for p in parts[1:]:
        verification = verification.unionByName(p)
    return StageResult(out_root, counts, verification)
