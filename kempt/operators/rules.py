"""Ordered column repair rules, previews and change logs.

A ``Rule`` is ``UPDATE t SET col = fix(col) WHERE when(col)`` re-expressed as a
column expression.  ``apply_rules`` folds the rules of each column into one
expression, in order, and rewrites the table with a single ``select``; rows
are never dropped or reordered.  ``preview_changes`` shows what a rule list
would change before it is applied (one scan, one narrow projection).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.operators.broadcast import size_checked_broadcast

Predicate = Callable[[Column], Column] | Column | None


@dataclass(frozen=True)
class Rule:
    """One repair step on one column.

    ``fix`` maps the current value to the new one.  ``when`` is either a function
    of the current value, a row-level ``Column`` (e.g. a key filter), or None for
    an unconditional rule.  A NULL predicate leaves the value unchanged.
    """

    name: str
    column: str
    fix: Callable[[Column], Column]
    when: Predicate = None
    constant: bool = False  # the fix does not read the current value

    def apply(self, current: Column, inline: bool = False) -> Column:
        """The new value of the column given its current value; ``inline`` allows a constant rule to read it twice."""
        if self.when is None:
            return self.fix(current)
        if self.constant and inline:
            return self._conditional(current)
        # A conditional rule reads its input three times (predicate, fix,
        # otherwise).  Binding the input once to a lambda variable keeps a
        # chain of k rules linear in size; inlined, it would grow 3^k when a
        # filter on the result is pushed through the projection.
        return F.transform(F.array(current), self._conditional).getItem(0)

    def _conditional(self, x: Column) -> Column:
        pred = self.when(x) if callable(self.when) else self.when
        return F.when(F.coalesce(pred, F.lit(False)), self.fix(x)).otherwise(x)


def set_value(name: str, column: str, value, when: Predicate) -> Rule:
    """Conditional set to a literal."""
    return Rule(name, column, lambda _c: F.lit(value), when, constant=True)


def replace_rule(name: str, column: str, search: str, replacement: str, when: Predicate = None) -> Rule:
    """``REPLACE(column, search, replacement)``: literal, single pass, non-overlapping."""
    return Rule(name, column, lambda c: F.replace(c, F.lit(search), F.lit(replacement)), when)


#: Constant rules whose predicate reads the current value, per column, that are written out; each doubles the expression.
_INLINE = 3


def fold(rules: Sequence[Rule], start: Column) -> Column:
    """Compose the rules left to right on ``start``.

    Constant rules become plain CASE expressions, which generated code covers;
    a longer chain of them binds its input once a rule instead.
    """
    out, doubled = start, 0
    for r in rules:
        reads = r.constant and callable(r.when)
        out = r.apply(out, inline=not reads or doubled < _INLINE)
        doubled += reads
    return out


def _by_column(df: DataFrame, rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    out: dict[str, list[Rule]] = {}
    for r in rules:
        if r.column not in df.columns:
            raise ValueError(f"rule {r.name!r}: no column {r.column!r}")
        out.setdefault(r.column, []).append(r)
    return out


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply ordered rules in one projection; other columns and row order are untouched."""
    grouped = _by_column(df, rules)
    return df.select(*[fold(grouped[c], F.col(c)).alias(c) if c in grouped else F.col(c)
                       for c in df.columns])


def preview_changes(df: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Rows a rule list would change: key, column_name, before, after (long format).

    One scan: every touched column's before/after pair is packed into an array
    of structs, exploded, and only the changed entries are kept.
    """
    grouped = _by_column(df, rules)
    entries = [F.struct(F.lit(col).alias("column_name"),
                        F.col(col).cast("string").alias("before"),
                        fold(rs, F.col(col)).cast("string").alias("after"))
               for col, rs in grouped.items()]
    return (df.select(*key, F.explode(F.array(*entries)).alias("e"))
              .where(~F.col("e.before").eqNullSafe(F.col("e.after")))
              .select(*key, "e.column_name", "e.before", "e.after"))


def apply_keyed_replacements(df: DataFrame, key: str, column: str, rule_table: DataFrame,
                             *, broadcast_max_rows: int = 100_000) -> DataFrame:
    """Targeted corrections by key: ``rule_table(key, seq, search, replacement)``.

    Rules are grouped per key into an ordered array and folded over the value
    with the ``aggregate`` higher-order function, so a key can carry several
    ordered corrections.  The rule table is authored by hand, so one key's
    array holds the few corrections someone wrote for it.  The per-key rule table is broadcast when its checked
    row count is under the bound (the data side is then never shuffled);
    otherwise it is a shuffle join, where AQE splits a hot key.
    """
    per_key = (rule_table.groupBy(F.col(key).alias("_rk"))
               .agg(F.array_sort(F.collect_list(F.struct("seq", "search", "replacement"))).alias("_rules")))
    side, _ = size_checked_broadcast(per_key, broadcast_max_rows)
    joined = df.join(side, df[key] == F.col("_rk"), "left")
    empty = F.array().cast("array<struct<seq:int,search:string,replacement:string>>")
    fixed = F.aggregate(F.coalesce(F.col("_rules"), empty), F.col(column),
                        lambda acc, r: F.replace(acc, r["search"], r["replacement"]))
    return joined.select(*[fixed.alias(c) if c == column else F.col(c) for c in df.columns])


def change_log(before: DataFrame, after: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Old/new values of the given columns for rows whose value changed.

    Intended for two versions of the same table that share the key; the join is
    on the key (shuffle on both sides at scale, co-partitioned when the inputs
    are bucketed by key).
    """
    b = before.select(*key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    a = after.select(*key, *[F.col(c).alias(f"_a_{c}") for c in columns])
    j = b.join(a, list(key), "inner")
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_b_{c}").cast("string").alias("before"),
                        F.col(f"_a_{c}").cast("string").alias("after")) for c in columns]
    return (j.select(*key, F.explode(F.array(*entries)).alias("e"))
             .where(~F.col("e.before").eqNullSafe(F.col("e.after")))
             .select(*key, "e.column_name", "e.before", "e.after"))
