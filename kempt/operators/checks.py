"""Quality checks.

Scalar checks of one table are *fused*: every metric becomes one aggregate
expression and all of them run in a single ``agg`` (one scan, one partial +
final ``HashAggregate``), instead of one query per metric.  Grouped checks
(duplicates, cardinality) and integrity checks (orphans) are shuffles on the
checked key; each pre-aggregates on the map side so a hot key collapses to one
row per partition before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions import text
from kempt.model import load_order
from kempt.operators.broadcast import DEFAULT_MAX_ROWS, fits, fixed_row_bytes, measure, size_checked_broadcast
from kempt.session import cut_lineage

# ---------------------------------------------------------------------------
# scalar metrics (aggregate expressions)
# ---------------------------------------------------------------------------


def row_count() -> Column:
    """``COUNT(*)``."""
    return F.count(F.lit(1))


def count_where(pred: Column) -> Column:
    """Rows where the predicate is true; 0 (not NULL) over an empty input."""
    return F.count_if(F.coalesce(pred, F.lit(False)))


def null_count(c: str) -> Column:
    """Rows where ``c`` is NULL."""
    return count_where(F.col(c).isNull())


def blank_count(c: str) -> Column:
    """Rows where ``c`` is empty or spaces only."""
    return count_where(text.is_blank(c))


def whitespace_count(c: str) -> Column:
    """Rows where ``c`` has leading or trailing spaces."""
    return count_where(text.has_edge_whitespace(c))


def extra_space_count(c: str) -> Column:
    """Rows where ``c`` has a double space or an edge space."""
    return count_where(text.has_extra_spaces(c))


def non_ascii_count(c: str) -> Column:
    """Rows where ``c`` holds a character outside printable ASCII."""
    return count_where(text.has_non_ascii(c))


def contains_count(c: str, needle: str) -> Column:
    """Rows where ``c`` contains ``needle``."""
    return count_where(F.col(c).contains(needle))


def run_checks(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """All metrics in one aggregate: a single wide row, one column per metric."""
    return df.agg(*[expr.alias(name) for name, expr in metrics.items()])


def to_long(wide: DataFrame, name_col: str = "check_name", value_col: str = "actual") -> DataFrame:
    """Unpivot a one-row metric table into ``(check_name, actual)`` rows."""
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in wide.columns]  # names may hold dots
    return wide.unpivot([], cols, name_col, value_col) if cols else wide


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and NULL count of every column, in one pass."""
    metrics = {"total_rows": row_count()}
    metrics.update({f"null_{c}": null_count(c) for c in columns})
    return run_checks(df, metrics)


def text_hygiene(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: NULL, blank, edge-whitespace and extra-space rows (one scan, long format)."""
    metrics: dict[str, Column] = {}
    for c in columns:
        metrics[f"{c}__null_rows"] = null_count(c)
        metrics[f"{c}__blank_rows"] = blank_count(c)
        metrics[f"{c}__whitespace_rows"] = whitespace_count(c)
        metrics[f"{c}__extra_space_rows"] = extra_space_count(c)
    wide = run_checks(df, metrics)
    entries = [F.struct(F.lit(c).alias("column_name"),
                        *[F.col(f"{c}__{m}").alias(m) for m in
                          ("null_rows", "blank_rows", "whitespace_rows", "extra_space_rows")])
               for c in columns]
    return wide.select(F.inline(F.array(*entries)))


# ---------------------------------------------------------------------------
# grouped checks
# ---------------------------------------------------------------------------


def _keys(keys: Sequence[str], case_insensitive: bool, collation: str | None = None) -> list[Column]:
    if collation:
        return [F.collate(F.col(k), collation).alias(k) for k in keys]
    if not case_insensitive:
        return [F.col(k) for k in keys]
    # lower() rather than a UTF8_LCASE collated key: same groups for these
    # values, but the aggregate stays hash-based (a collated grouping key is
    # planned as a sort aggregate)
    return [F.lower(F.col(k)).alias(k) for k in keys]


def duplicate_groups(df: DataFrame, keys: Sequence[str], *, case_insensitive: bool = False,
                     collation: str | None = None, count_col: str = "n_rows",
                     extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Key groups holding more than one row.  NULL keys form one group, as in SQL GROUP BY.
    ``case_insensitive`` compares lower-cased keys; ``collation`` (e.g. ``UTF8_LCASE``)
    compares them by that collation instead, at the price of a sort-based aggregate.
    ``extra`` adds more aggregates per group (e.g. distinct spellings)."""
    aggs = [row_count().alias(count_col)] + [e.alias(n) for n, e in (extra or {}).items()]
    return df.groupBy(*_keys(keys, case_insensitive, collation)).agg(*aggs).where(F.col(count_col) > 1)


def duplicate_summary(groups: DataFrame, count_col: str = "n_rows") -> DataFrame:
    """``(duplicate_groups, duplicate_rows)`` over the output of a duplicate check."""
    return groups.agg(F.count(F.lit(1)).alias("duplicate_groups"),
                      F.coalesce(F.sum(count_col), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def value_summary(df: DataFrame, column: str, predicates: Mapping[str, Callable[[Column], Column]], *,
                  total_col: str = "total_rows", duplicates_col: str = "duplicate_values") -> DataFrame:
    """One-row summary of a column: row count, rows matching each predicate,
    and the number of values that occur more than once.

    Rows are first counted per value (partial aggregation, so a value held by a
    third of the table is one row per task); every predicate is then evaluated
    once per distinct value and weighted by its count.  This replaces a summary
    built from scalar subqueries -- one pipeline, one scan, no cross join.
    """
    per = df.groupBy(column).agg(row_count().alias("_n"))
    v, n = F.col(column), F.col("_n")

    def weighted(pred: Column) -> Column:
        return F.coalesce(F.sum(F.when(pred, n)), F.lit(0)).cast("bigint")

    return per.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(total_col),
                   *[weighted(p(v)).alias(name) for name, p in predicates.items()],
                   count_where(n > 1).alias(duplicates_col))


def duplicate_text_groups(df: DataFrame, column: str, *, broadcast_max_rows: int = DEFAULT_MAX_ROWS,
                          count_col: str = "n_rows") -> DataFrame:
    """Exact duplicate groups of a long text column without shuffling every text.

    1. group by a 64-bit hash of the text (8 bytes per row cross the shuffle);
    2. keep only rows whose hash occurs more than once (semi join, broadcast
       when the candidate hash set is proven small);
    3. group the candidates by the full text, which makes the answer exact:
       hash collisions only add candidates, they can never merge two texts.
    """
    h = F.xxhash64(F.col(column)).alias("_h")
    cand = (df.select(h).groupBy("_h").agg(row_count().alias("_n")).where(F.col("_n") > 1).select("_h"))
    cand, _ = size_checked_broadcast(cut_lineage(cand), broadcast_max_rows)  # hashed once, then measured
    rows = df.select(F.col(column), h).join(cand, "_h", "left_semi")
    return rows.groupBy(column).agg(row_count().alias(count_col)).where(F.col(count_col) > 1)


def groups_over_bound(df: DataFrame, key: Sequence[str], bound: int) -> DataFrame:
    """Number of key groups with more than ``bound`` rows (one-row result)."""
    per = df.groupBy(*key).agg(row_count().alias("_n"))
    return per.agg(count_where(F.col("_n") > bound).alias("groups_over_bound"),
                   F.coalesce(F.max("_n"), F.lit(0)).cast("bigint").alias("max_group_size"))


# ---------------------------------------------------------------------------
# referential integrity
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Relation:
    """``child.fk -> parent.pk``; ``optional`` FKs allow NULL."""

    name: str
    child: DataFrame
    fk: str
    parent: DataFrame
    pk: str
    optional: bool = False


DEFAULT_BROADCAST_MAX_ROWS = DEFAULT_MAX_ROWS


def _parent_keys(parent: DataFrame, pk: str) -> DataFrame:
    # semi/anti joins need no distinct right side, so no shuffle is spent on one
    return parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str, optional: bool = False) -> DataFrame:
    """Child rows whose key has no parent.  A NULL mandatory key is an orphan."""
    if optional:
        child = child.where(F.col(fk).isNotNull())
    return child.join(_parent_keys(parent, pk), child[fk] == F.col("_pk"), "left_anti")


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str, optional: bool = False, *,
                 broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                 parent_key_rows: int | None = None) -> DataFrame:
    """``(orphan_rows, orphan_keys)``; a NULL key counts as one key.

    Two plans, chosen by a checked size:

    * parent keys proven small (row count <= ``broadcast_max_rows``): the child
      streams once past a broadcast hash set -- no shuffle of child rows, so
      a key holding a third of the child costs nothing extra;
    * otherwise the child is first reduced to ``(fk, rows)`` by a map-side
      partial aggregate (only distinct keys cross the shuffle, a hot key
      collapses to one row per partition) and the distinct keys are matched
      with a left outer join + IS NULL.  (A ``left_anti`` here would be pushed
      below the aggregate by Catalyst and shuffle every child row.)

    ``parent_key_rows`` lets a caller that already counted the parent keys
    (``integrity_report`` counts all parents in one job) skip the count.
    """
    if optional:
        child = child.where(F.col(fk).isNotNull())
    keys = _parent_keys(parent, pk)
    # the parent's row count bounds its key count and needs no column read;
    # fixed-width keys turn it into a byte bound, other keys are measured
    n_keys = parent.count() if parent_key_rows is None else parent_key_rows
    width = fixed_row_bytes(keys.schema)
    small = (fits(n_keys, n_keys * width, broadcast_max_rows) if width is not None
             else fits(*measure(keys), broadcast_max_rows))
    if small:
        missing = child.join(F.broadcast(keys), child[fk] == F.col("_pk"), "left_anti").select(
            F.col(fk).alias("_fk"))
        return missing.agg(
            F.count(F.lit(1)).alias("orphan_rows"),
            (F.count_distinct("_fk") + F.coalesce(F.max(F.when(F.col("_fk").isNull(), 1).otherwise(0)), F.lit(0)))
            .cast("bigint").alias("orphan_keys"))
    per_key = child.groupBy(F.col(fk).alias("_fk")).agg(row_count().alias("_n"))
    missing = per_key.join(keys, F.col("_fk") == F.col("_pk"), "left").where(F.col("_pk").isNull())
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
                       F.count(F.lit(1)).alias("orphan_keys"))


def _fusable(relations: Sequence[Relation], sizes: Sequence[int], max_rows: int) -> list[int]:
    """Positions of the relations whose parents fit into one pass *together*: smallest parents
    first, as long as the sum of their rows and bytes stays within the broadcast bounds."""
    chosen, rows, nbytes = [], 0, 0
    for i in sorted(range(len(relations)), key=lambda i: sizes[i]):
        width = fixed_row_bytes(_parent_keys(relations[i].parent, relations[i].pk).schema)
        if width is not None and fits(rows + sizes[i], nbytes + sizes[i] * width, max_rows):
            chosen.append(i)
            rows, nbytes = rows + sizes[i], nbytes + sizes[i] * width
    return sorted(chosen)


def fused_child_checks(child: DataFrame, relations: Sequence[Relation],
                       extra: Mapping[str, Column] | None = None) -> DataFrame:
    """All foreign keys of one child (plus any extra row metrics) in ONE pass.

    The child is left-joined to the *distinct* key set of every parent
    (broadcast: callers check the parents are small), so rows are neither
    multiplied nor shuffled, and one aggregate counts the misses of every
    relation together with the extra metrics.  Output: ``(check_name, issue_count)``,
    one row per relation and metric even where names repeat.
    """
    joined = child
    metrics: list[tuple[str, Column]] = list((extra or {}).items())
    for i, r in enumerate(relations):
        keys = (_parent_keys(r.parent, r.pk).distinct()
                .select(F.col("_pk").alias(f"_pk{i}"), F.lit(True).alias(f"_hit{i}")))
        joined = joined.join(F.broadcast(keys), child[r.fk] == F.col(f"_pk{i}"), "left")
        miss = F.col(f"_hit{i}").isNull()
        if r.optional:
            miss = miss & child[r.fk].isNotNull()
        metrics.append((r.name, count_where(miss)))
    wide = joined.agg(*[e.alias(f"_m{i}") for i, (_, e) in enumerate(metrics)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"_m{i}").alias("issue_count"))
                                          for i, (n, _) in enumerate(metrics)])))


def _relation_checks(child: DataFrame, relations: Sequence[Relation], sizes: Sequence[int], max_rows: int,
                     extra: Mapping[str, Column] | None = None) -> list[DataFrame]:
    """One pass for the extra metrics and every small parent, one plan each for the other relations."""
    fused = _fusable(relations, sizes, max_rows)
    parts = []
    if len(fused) > 1 or (fused and extra):
        parts.append(fused_child_checks(child, [relations[i] for i in fused], extra))
    else:
        fused = []
        if extra:
            parts.append(to_long(run_checks(child, extra), "check_name", "issue_count"))
    for i, r in enumerate(relations):
        if i not in fused:
            parts.append(orphan_count(r.child, r.fk, r.parent, r.pk, r.optional, broadcast_max_rows=max_rows,
                                      parent_key_rows=sizes[i])
                         .select(F.lit(r.name).alias("check_name"), F.col("orphan_rows").alias("issue_count")))
    return parts


def _parent_sizes(relations: Sequence[Relation]) -> list[int]:
    counts = reduce(DataFrame.unionByName, [
        r.parent.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n")
        for i, r in enumerate(relations)])
    sizes = {row["i"]: row["n"] for row in counts.collect()}
    return [sizes[i] for i in range(len(relations))]


def integrity_report(relations: Sequence[Relation], *,
                     broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """One ``(check_name, issue_count)`` row per relation, unioned.

    The size checks of all parents run as *one* job (a union of row counts,
    collected as one row per relation).  All relations of a child whose parents
    are proven small together are checked in a single pass
    (``fused_child_checks``); each other relation gets the plan its parent size
    allows (see ``orphan_count``).
    """
    sizes = _parent_sizes(relations)
    by_child: dict[int, list[int]] = {}
    for i, r in enumerate(relations):
        by_child.setdefault(id(r.child), []).append(i)
    parts: list[DataFrame] = []
    for idx in by_child.values():
        rels = [relations[i] for i in idx]
        parts += _relation_checks(rels[0].child, rels, [sizes[i] for i in idx], broadcast_max_rows)
    return reduce(DataFrame.unionByName, parts)


def spec_relations(tables: Mapping[str, DataFrame], specs) -> list[Relation]:
    """Relations declared by ``model.TableSpec`` foreign keys, for the tables present."""
    out = []
    for name, spec in specs.items():
        if name not in tables:
            continue
        for fk in spec.foreign_keys:
            if fk.parent in tables:
                out.append(Relation(f"{name}.{fk.column} -> {fk.parent}.{fk.parent_column}",
                                    tables[name], fk.column, tables[fk.parent], fk.parent_column, fk.optional))
    return out


def spec_check_names(tables: Mapping[str, DataFrame], specs) -> list[str]:
    """Names of the checks ``spec_report`` produces, derived from the specs alone."""
    names: list[str] = []
    for name in load_order(specs):
        if name not in tables:
            continue
        spec = specs[name]
        names += [f"{name}.{c} is null" for c in spec.required_columns()]
        names += [f"{name} duplicate ({', '.join(k)})" for k in (spec.primary_key, *spec.unique) if k]
    return names + [r.name for r in spec_relations(tables, specs)]


def spec_report(tables: Mapping[str, DataFrame], specs) -> DataFrame:
    """Every declared constraint of every table as a ``(check_name, issue_count)`` row.

    Constraints are metadata on ``model.TableSpec`` (Spark enforces none of them
    on files): required columns (declared NOT NULL, primary key, mandatory FKs)
    are NULL-counted in one fused aggregate per table; the primary key and each
    UNIQUE set report their duplicate groups; foreign keys report orphans via
    ``integrity_report``.  Tables are visited parents first, and declared
    collations rule all comparisons.
    """
    tables = {name: specs[name].collated(df) if name in specs else df for name, df in tables.items()}
    relations = spec_relations(tables, specs)
    sizes = _parent_sizes(relations) if relations else []
    parts: list[DataFrame] = []
    for name in load_order(specs):
        if name not in tables:
            continue
        spec, df = specs[name], tables[name]
        nulls = {f"{name}.{c} is null": null_count(c) for c in spec.required_columns()}
        idx = [i for i, r in enumerate(relations) if r.child is df]
        rels = [relations[i] for i in idx]
        parts += _relation_checks(df, rels, [sizes[i] for i in idx], DEFAULT_BROADCAST_MAX_ROWS, nulls)
        for key in (spec.primary_key, *spec.unique):
            if key:
                label = f"{name} duplicate ({', '.join(key)})"
                parts.append(duplicate_groups(df, list(key)).agg(row_count().alias("issue_count"))
                             .select(F.lit(label).alias("check_name"), "issue_count"))
    return reduce(DataFrame.unionByName, parts)
