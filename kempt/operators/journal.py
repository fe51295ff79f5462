"""A reversible change journal: what every rule changed, in order, and its undoing.

``change_journal`` runs an ordered rule list and logs every change as ``(key,
column_name, seq, rule, before, after)``; ``seq`` is the place of the rule in
the list.  A cell's entries form a chain from the original to the final value.
``apply_journal`` brings a table forward by those chains, ``roll_back`` takes
all of them back, or those of some rules.

Undoing is safe: a cell changes only if it still holds the value that the
journal left there, and if the undone entries are the cell's last ones.
Everything else is a conflict; it is reported and the cell stays as it is.

Cells are matched by key with one join.  A cell's chain has at most as many
entries as there are rules, so nothing unbounded is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.operators.rules import Rule
from kempt.sources.snapshot import read_snapshot, write_snapshot

#: A table's journal is published under its name with this ending.
JOURNAL = "__journal"


def change_journal(df: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Every change that the rules make, one row each; rows are read once.

    The value after each rule is kept in a column of its own, so a later rule
    reads it and no expression is repeated.  Values are logged as text.
    """
    staged, at = df, {}
    for i, rule in enumerate(rules):
        if rule.column not in df.columns:
            raise ValueError(f"rule {rule.name!r}: no column {rule.column!r}")
        last = at.get(rule.column, rule.column)
        staged = staged.withColumn(f"_v{i}", rule.apply(F.col(last)))
        at[rule.column] = f"_v{i}"
    entries, last = [], {}
    for i, rule in enumerate(rules):
        before = last.get(rule.column, rule.column)
        entries.append(F.struct(F.lit(rule.column).alias("column_name"), F.lit(i).alias("seq"), F.lit(rule.name).alias("rule"),
                                F.col(before).cast("string").alias("before"), F.col(f"_v{i}").cast("string").alias("after")))
        last[rule.column] = f"_v{i}"
    return (staged.select(*key, F.explode(F.array(*entries)).alias("e")).where(~F.col("e.before").eqNullSafe(F.col("e.after")))
            .select(*key, "e.column_name", "e.seq", "e.rule", "e.before", "e.after"))


def write_with_journal(df: DataFrame, journal: DataFrame, root: str, name: str) -> dict[str, int]:
    """Publish a cleaned table together with its journal as one snapshot: readers see both or neither."""
    return write_snapshot({name: df, f"{name}{JOURNAL}": journal}, root)


def read_with_journal(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A published table and its journal."""
    tables = read_snapshot(spark, root, [name, f"{name}{JOURNAL}"])
    return tables[name], tables[f"{name}{JOURNAL}"]


@dataclass(frozen=True)
class RollBack:
    """The table after undoing, and what could not be undone."""

    rows: DataFrame
    conflicts: DataFrame  # key, column_name, reason, current, expected


def _chains(journal: DataFrame, key: Sequence[str], chosen: Column) -> DataFrame:
    """Per key: a map from column to (first undone value, value left by the last undone entry, whether these are the cell's last)."""
    per_cell = journal.withColumn("_undo", F.coalesce(chosen, F.lit(False))).groupBy(*key, "column_name").agg(
        F.min_by(F.struct("before"), F.when(F.col("_undo"), F.col("seq"))).getField("before").alias("before"),
        F.max_by(F.struct("after"), F.when(F.col("_undo"), F.col("seq"))).getField("after").alias("after"),
        F.min(F.when(F.col("_undo"), F.col("seq"))).alias("first"), F.max(F.when(~F.col("_undo"), F.col("seq"))).alias("kept"))
    ended = F.coalesce(F.col("kept") < F.col("first"), F.lit(True))
    cells = per_cell.where("first is not null").select(*key, "column_name", F.struct("before", "after", ended.alias("ended")).alias("cell"))
    return cells.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("column_name", "cell"))).alias("_cells"))  # one entry a column


def _joined(df: DataFrame, chains: DataFrame, key: Sequence[str]) -> DataFrame:
    renamed = chains.select(*[F.col(k).alias(f"_k_{k}") for k in key], "_cells")
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    return df.join(renamed, on, "left").drop(*[f"_k_{k}" for k in key])


def apply_journal(df: DataFrame, journal: DataFrame, key: Sequence[str]) -> RollBack:
    """``df`` with every logged cell set to the last value of its chain, where it holds the chain's first one."""
    forward = journal.select(*key, "column_name", (-F.col("seq")).alias("seq"), "rule", F.col("after").alias("before"), F.col("before").alias("after"))
    return roll_back(df, forward, key)


def roll_back(df: DataFrame, journal: DataFrame, key: Sequence[str], rules: Sequence[str] | None = None) -> RollBack:
    """``df`` with the journal undone, or only the entries of the named rules.

    An entry under a later one that stays cannot be undone by itself: that
    cell is a conflict (``later change``), as is one whose value is not what
    the journal left (``other value``).  Repeated keys get the same treatment
    row by row; entries without a row are ignored.
    """
    chosen = F.lit(True) if rules is None else F.col("rule").isin(list(rules))
    joined = _joined(df, _chains(journal, key, chosen), key)
    columns, problems = [], []
    for c in df.columns:
        if c in key:
            columns.append(F.col(c))
            continue
        cell = F.element_at("_cells", F.lit(c))
        there = cell.isNotNull()
        same = F.col(c).cast("string").eqNullSafe(cell.getField("after"))
        columns.append(F.when(there & same & cell.getField("ended"), cell.getField("before").cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        reason = F.when(there & ~cell.getField("ended"), F.lit("later change")).when(there & ~same, F.lit("other value"))
        problems.append(F.struct(F.lit(c).alias("column_name"), reason.alias("reason"), F.col(c).cast("string").alias("current"),
                                 cell.getField("after").alias("expected")))
    conflicts = (joined.where("_cells is not null").select(*key, F.explode(F.array(*problems)).alias("p")).where("p.reason is not null")
                 .select(*key, "p.*")) if problems else joined.select(*key).limit(0)
    return RollBack(joined.select(*columns), conflicts)
