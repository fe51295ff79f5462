"""Deterministic "dirty views" over the driver's star-schema tables.

The driver's tables carry no NULLs, orphans or text defects, so each query
injects defects with a fixed SQL projection.  The *same* projection text is
used by the Spark side (``selectExpr``) and by the DuckDB oracle (a CTE), so
both engines start from identical inputs.  Only portable SQL is used here
(``CASE``, ``%``, ``||``, ``replace``, ``CAST ... AS STRING/DECIMAL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kempt.session import ensure_parallelism

# view name -> (source table, [(column alias, SQL expression)])
VIEWS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "dirty_part": ("part", [
        ("id", "p_partkey"),
        ("nm", "CASE p_partkey % 40 WHEN 0 THEN ',' WHEN 1 THEN ',' || p_type "
               "WHEN 2 THEN p_name || ',' WHEN 3 THEN p_name || ',' || p_type "
               "WHEN 4 THEN p_type || ',' || p_name ELSE p_name END"),
    ]),
    "dirty_supplier": ("supplier", [
        ("id", "s_suppkey"),
        ("nm", "CASE s_suppkey % 8 WHEN 0 THEN s_name || ' Ltd' WHEN 1 THEN s_name || ' ltd.' "
               "WHEN 2 THEN s_name || '  Ltd.' WHEN 3 THEN 'Doctorâ€™s ' || s_name || ' Ltd.' "
               "WHEN 4 THEN s_name || ' Limited' WHEN 5 THEN ' ' || s_name "
               "WHEN 6 THEN s_name || ' pharmaceuticls Ltd.' ELSE s_name || ' Ltd.' END"),
        ("s_nationkey", "s_nationkey"),
    ]),
    "dirty_customer": ("customer", [
        ("c_custkey", "c_custkey"),
        ("c_name", "CASE WHEN c_custkey % 19 = 0 THEN ' ' || c_name "
                   "WHEN c_custkey % 23 = 0 THEN c_name || ' ' ELSE c_name END"),
        ("c_nationkey", "CASE WHEN c_custkey % 13 = 0 THEN NULL "
                        "WHEN c_custkey % 17 = 0 THEN 999 ELSE c_nationkey END"),
        ("c_acctbal", "CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_acctbal END"),
        ("c_mktsegment", "CASE WHEN c_custkey % 7 = 0 THEN NULL "
                         "WHEN c_custkey % 11 = 0 THEN '   ' ELSE c_mktsegment END"),
    ]),
    "dirty_docs": ("documents", [
        ("doc_id", "doc_id"),
        ("text", "CASE doc_id % 6 "
                 "WHEN 0 THEN replace(replace(text, 'é', 'Ã©'), 'ö', 'Ã¶') || ' Doctorâ€™s note' "
                 "WHEN 1 THEN replace(replace(text, 'é', 'Ã©'), 'ö', 'Ã¶') || ' costÂfree' "
                 "WHEN 2 THEN replace(replace(text, 'é', 'Ã©'), 'ö', 'Ã¶') || ' 5Â+Â10' "
                 "WHEN 3 THEN replace(replace(text, 'é', 'Ã©'), 'ö', 'Ã¶') || ' Î²-blocker' "
                 "ELSE replace(replace(text, 'é', 'Ã©'), 'ö', 'Ã¶') END"),
        # what a correct repair must give back
        ("expected", "CASE doc_id % 6 WHEN 0 THEN text || ' Doctor’s note' "
                     "WHEN 1 THEN text || ' cost free' WHEN 2 THEN text || ' 5 + 10' "
                     "WHEN 3 THEN text || ' β-blocker' ELSE text END"),
    ]),
    "dirty_orders": ("orders", [
        ("o_orderkey", "o_orderkey"),
        ("o_custkey", "CASE WHEN o_orderkey % 89 = 0 THEN NULL "
                      "WHEN o_orderkey % 97 = 0 THEN -o_custkey - 1 ELSE o_custkey END"),
    ]),
    # staging text: ids and prices as they arrive in a loosely typed snapshot
    "raw_orders_text": ("orders", [
        ("o_orderkey", "o_orderkey"),
        ("o_custkey", "CASE o_orderkey % 16 WHEN 0 THEN CAST(o_custkey AS STRING) || '.0' "
                      "WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN NULL "
                      "WHEN 4 THEN CAST(o_custkey AS STRING) || '.7' WHEN 5 THEN '9007199254740993' "
                      "WHEN 6 THEN '12d' WHEN 7 THEN '3f' WHEN 8 THEN 'NaN' WHEN 9 THEN '1e3' "
                      "WHEN 10 THEN '99999999999999999999' ELSE CAST(o_custkey AS STRING) END"),
        ("o_totalprice", "CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN '1e9' "
                         "WHEN 3 THEN NULL WHEN 4 THEN '3f' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END"),
    ]),
    "containers": ("part", [
        ("container_id", "p_partkey"),
        ("container_size", "CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Not for sale' "
                           "ELSE CAST(p_size AS STRING) || ' ml bottle' END"),
        ("unit_price", "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(10,2)) END"),
    ]),
    "typo_names": ("part", [
        ("id", "p_partkey"),
        ("nm", "CASE p_partkey % 29 WHEN 3 THEN replace(p_name, 'd', '') WHEN 11 THEN p_name || 's' "
               "WHEN 17 THEN replace(p_name, 'r', 'x') WHEN 23 THEN replace(p_name, 'll', 'l') ELSE p_name END"),
    ]),
    "part_variants": ("part", [
        ("id", "p_partkey"),
        ("nm", "CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name "
               "ELSE upper(substring(p_name, 1, 1)) || substring(p_name, 2) END"),
    ]),
    "form_names": ("part", [
        ("id", "p_partkey"),
        ("nm", "CASE p_partkey % 4 WHEN 0 THEN p_name || ' for ' || lower(p_type) "
               "WHEN 1 THEN p_name || ' or ' || p_type ELSE p_name END"),
    ]),
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Views whose consumers run regex and replace chains over whole texts.
SPREAD = ("dirty_docs",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The snapshot table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dirty view: its source table through the shared projection."""
    source, cols = VIEWS[name]
    rows = table(spark, sf_dir, source)
    if name in SPREAD:
        rows = ensure_parallelism(rows)
    return rows.selectExpr(*[f"{expr} AS {alias}" for alias, expr in cols])


def view_sql(name: str) -> str:
    """The same view as a SQL ``SELECT`` (used in the oracle's CTEs)."""
    source, cols = VIEWS[name]
    return "SELECT " + ", ".join(f"{expr} AS {alias}" for alias, expr in cols) + f" FROM {source}"


def with_views(*names: str) -> str:
    """``WITH v1 AS (...), v2 AS (...)`` prefix; callers append ``, more AS (...)``."""
    return "WITH " + ",\n".join(f"{n} AS ({view_sql(n)})" for n in names)
