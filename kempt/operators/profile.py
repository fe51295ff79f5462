"""Profiles: frequency tables, cardinality, ranges, code-point discovery, classification.

Every profile is an aggregate whose map-side partial step bounds what crosses
the shuffle by the number of distinct groups per partition, not by rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions import text
from kempt.operators.broadcast import bounded_by_rows, size_checked_broadcast
from kempt.operators.checks import count_where, row_count
from kempt.session import cut_lineage


def frequency(df: DataFrame, column: str | Column, count_col: str = "frequency", *, ordered: bool = True) -> DataFrame:
    """Value -> row count, most frequent first unless the caller needs no order (e.g. before a union)."""
    counts = df.groupBy(column).agg(row_count().alias(count_col))
    return counts.orderBy(F.desc(count_col)) if ordered else counts


def group_sizes(df: DataFrame, key: Sequence[str], size_col: str = "group_size") -> DataFrame:
    """Rows per key group."""
    return df.groupBy(*key).agg(row_count().alias(size_col))


def cardinality_histogram(df: DataFrame, key: Sequence[str], size_col: str = "children",
                          count_col: str = "parents") -> DataFrame:
    """How many parents have 1, 2, 3 ... children (group-by over group-by)."""
    return (group_sizes(df, key, size_col).groupBy(size_col)
            .agg(row_count().alias(count_col)).orderBy(size_col))


def numeric_range(df: DataFrame, column: str, *, with_sum: bool = False) -> DataFrame:
    """min / max / avg / non-NULL count of a numeric column, and its sum if asked for."""
    c = F.col(column)
    return df.agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"), *([F.sum(c).alias("sum_value")] if with_sum else []),
                  F.avg(c).alias("avg_value"), F.count(c).alias("non_null_rows"))


def first_artifact_discovery(df: DataFrame, column: str, width: int = 3, *,
                             example_key: str | None = None) -> DataFrame:
    """Code points at the first non-printable-ASCII position of each affected row,
    grouped: ``char1..charN, example, affected_rows``.

    With ``example_key`` the example is the smallest key of the group
    (``example_<key>`` column), which keeps the aggregate hash-based;
    ``first_artifact_examples`` fetches the texts of those few keys.  Without
    it the example is the smallest value (``MIN(text)``): Spark then plans a
    sort-based aggregate over whole texts, so keep that for short columns.
    """
    pos = text.first_non_ascii_pos(column)
    chars = [text.code_point_at(column, pos + i).alias(f"char{i + 1}") for i in range(width)]
    example = (F.min(column).alias("example") if example_key is None
               else F.min(example_key).alias(f"example_{example_key}"))
    return (df.where(text.has_non_ascii(column))
            .groupBy(*chars)
            .agg(example, row_count().alias("affected_rows")))


def first_artifact_examples(df: DataFrame, column: str, key: str, width: int = 3) -> DataFrame:
    """``first_artifact_discovery`` with the text of each group's smallest key as ``example``."""
    groups = cut_lineage(first_artifact_discovery(df, column, width, example_key=key))
    side, _ = size_checked_broadcast(groups)
    texts = df.select(F.col(key).alias(f"example_{key}"), F.col(column).alias("example"))
    return (texts.join(side, f"example_{key}").dropDuplicates([f"char{i + 1}" for i in range(width)])
            .select(*[f"char{i + 1}" for i in range(width)], "example", "affected_rows"))


def all_artifact_runs(df: DataFrame, column: str, id_col: str) -> DataFrame:
    """Every maximal non-ASCII run in every row (not only the first one):
    ``artifact, char1, occurrences, affected_rows``."""
    runs = df.select(id_col, F.explode(text.non_ascii_runs(column)).alias("artifact"))
    return (runs.groupBy("artifact")
            .agg(row_count().alias("occurrences"), F.count_distinct(id_col).alias("affected_rows"))
            .select("artifact", F.ascii("artifact").alias("char1"), "occurrences", "affected_rows"))


def classify_null_pattern(a: Column, b: Column, labels: tuple[str, str, str, str]) -> Column:
    """Label of the NULL pattern of two columns: (a NULL & b set, both set, a set & b NULL, both NULL)."""
    return (F.when(a.isNull() & b.isNotNull(), F.lit(labels[0]))
            .when(a.isNotNull() & b.isNotNull(), F.lit(labels[1]))
            .when(a.isNotNull() & b.isNull(), F.lit(labels[2]))
            .when(a.isNull() & b.isNull(), F.lit(labels[3])))


def null_rate_by_member(child: DataFrame, fk: str, parent: DataFrame, pk: str, label_col: str,
                        checked_col: str) -> DataFrame:
    """Rows and NULL rows of ``checked_col`` per parent member, members with NULLs only.

    The child is aggregated per key *before* the join, so the join sees one row
    per distinct key; unmatched and NULL keys form the NULL-label group, as a
    LEFT JOIN would give.
    """
    per_key = child.groupBy(F.col(fk).alias("_fk")).agg(
        row_count().alias("_total"), count_where(F.col(checked_col).isNull()).alias("_nulls"))
    labels = parent.select(F.col(pk).alias("_pk"), F.col(label_col).alias(label_col))
    joined = per_key.join(labels, F.col("_fk") == F.col("_pk"), "left")
    return (joined.groupBy(label_col)
            .agg(F.sum("_total").cast("bigint").alias("total_rows"),
                 F.sum("_nulls").cast("bigint").alias(f"null_{checked_col}"))
            .where(F.col(f"null_{checked_col}") > 0))


def null_association(child: DataFrame, member: str, checked_col: str) -> DataFrame:
    """Whether NULLs of ``checked_col`` go with ``member`` (systematic) or not (random): one row.

    The members by NULL / not NULL table's chi-square statistic, its degrees of
    freedom and Cramér's V (0: no association, 1: the member decides).  NULL
    members are a member of their own.  Without rows, with one member, or where
    all or no values are NULL there is nothing to associate: statistic and V
    are NULL.  Rows are counted per member first, so a hot member is one row
    per task, and one row leaves the second aggregate.
    """
    per_member = child.groupBy(member).agg(row_count().alias("t"), count_where(F.col(checked_col).isNull()).alias("h"))
    sums = per_member.agg(row_count().alias("n_members"), F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("n_rows"),
                          F.coalesce(F.sum("h"), F.lit(0)).cast("bigint").alias("n_null"),
                          F.sum(F.col("h").cast("double") * F.col("h") / F.col("t")).alias("_s"))
    n, a = F.col("n_rows").cast("double"), F.col("n_null").cast("double")
    chi = F.when((F.col("n_members") > 1) & (a > 0) & (a < n), (F.col("_s") - a * a / n) * n * n / (a * (n - a)))
    return sums.select("n_members", "n_rows", "n_null", F.greatest(chi, F.lit(0.0)).alias("chi_square"),
                       F.greatest(F.col("n_members") - 1, F.lit(0)).cast("bigint").alias("degrees_of_freedom"),
                       F.sqrt(F.greatest(chi, F.lit(0.0)) / n).alias("cramers_v"))


def children_per_member(parent: DataFrame, pk: str, child: DataFrame, fk: str,
                        count_col: str = "child_count") -> DataFrame:
    """Every parent member with its number of children, zero included.

    Children are counted per key first (partial aggregation), then joined to the
    parent, so the fact table is never shuffled row by row.
    """
    per_key = child.groupBy(F.col(fk).alias("_fk")).agg(row_count().alias("_n"))
    j = parent.join(per_key, parent[pk] == F.col("_fk"), "left")
    return j.select(*[parent[c] for c in parent.columns],
                    F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias(count_col))


def distinct_coverage(df: DataFrame, a: str, b: str, *, approx_rsd: float | None = None) -> DataFrame:
    """Rows, distinct ``a`` and distinct ``b`` of a link table (one aggregate).

    Exact by default (Spark plans the two distinct counts with an ``Expand``
    and a two-phase aggregate).  ``approx_rsd`` switches to HyperLogLog++
    sketches with that relative standard deviation: fixed-size state, no
    ``Expand``, for wide profiles of very high-cardinality columns.
    """
    if approx_rsd is None:
        da, db = F.count_distinct(a), F.count_distinct(b)
    else:
        da, db = F.approx_count_distinct(a, approx_rsd), F.approx_count_distinct(b, approx_rsd)
    return df.agg(row_count().alias("total_rows"), da.alias(f"distinct_{a}"), db.alias(f"distinct_{b}"))


def rows_at_max(df: DataFrame, column: str) -> DataFrame:
    """Rows holding the column maximum (``WHERE c = (SELECT MAX(c) ...)``)."""
    top = df.agg(F.max(column).alias("_max"))
    return df.join(F.broadcast(top), F.col(column) == F.col("_max"), "left_semi")


def domain_violations(df: DataFrame, column: str, domain: Sequence) -> DataFrame:
    """Distinct values outside an allowed domain, with their row counts (NULL included)."""
    c = F.col(column)
    return (df.where(~F.coalesce(c.isin(*domain), F.lit(False)))
            .groupBy(column).agg(row_count().alias("n_rows")))


def top_n_with_parent(child: DataFrame, fk: str, parent: DataFrame, pk: str, order: Sequence[str],
                      n: int) -> DataFrame:
    """``TOP n child JOIN parent ORDER BY <child columns>``, exact, without joining everything.

    The first ``n`` children by ``order`` are taken (per-partition top-n, then
    a merge) and broadcast -- a side of at most ``n`` rows -- against the parent
    scan.  Only if some of them have no parent (fewer than ``n`` rows survive
    the inner join) does it fall back to the full join, so the result is always
    the exact top ``n`` of the join.
    """
    ordered = [F.col(c) for c in order]
    head = cut_lineage(child.orderBy(*ordered).limit(n))
    joined = cut_lineage(bounded_by_rows(head, n).join(parent, F.col(fk) == parent[pk]))  # n rows where keys are unique
    if joined.count() == n:
        return joined.drop(pk) if pk != fk else joined
    full = child.join(parent, child[fk] == parent[pk]).orderBy(*ordered).limit(n)
    return full.drop(pk) if pk != fk else full
