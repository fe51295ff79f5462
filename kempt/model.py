"""Declared table specifications: schema, keys and constraints as metadata.

Spark does not enforce PRIMARY KEY, FOREIGN KEY, UNIQUE or NOT NULL on files,
so a ``TableSpec`` only *describes* them; ``operators.checks`` turns the
description into checks, and ``load_order`` gives the dependency order used
when a set of tables is rebuilt or published together.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Compares text without regard to letter case and to blanks at its end.
CASE_AND_TRAILING_BLANKS = "UTF8_LCASE_RTRIM"


@dataclass(frozen=True)
class ForeignKey:
    """``column`` references ``parent.parent_column``; ``optional`` allows NULL."""

    column: str
    parent: str
    parent_column: str
    optional: bool = False  # NULL values are allowed and not orphans


@dataclass(frozen=True)
class TableSpec:
    """Schema and declared keys of one table (metadata that drives checks, not enforcement)."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = field(default=())
    collations: tuple[tuple[str, str], ...] = ()  # (column, collation) of text columns compared by other rules than bytes

    def collated(self, df: DataFrame) -> DataFrame:
        """``df`` with the declared collations on its columns: joins, groups and comparisons follow them, values stay as they are.

        Collated columns of a child and its parent need the same collation.
        """
        if not self.collations:
            return df
        return df.withColumns({c: F.collate(F.col(c), name) for c, name in self.collations if c in df.columns})

    @property
    def columns(self) -> list[str]:
        """Column names in schema order."""
        return [f.name for f in self.schema.fields]

    def staging_schema(self, text_columns: Iterable[str]) -> T.StructType:
        """Same column order, with the given columns read as text for lenient casting."""
        text = set(text_columns)
        return T.StructType([T.StructField(f.name, T.StringType() if f.name in text else f.dataType, True)
                             for f in self.schema.fields])

    def required_columns(self) -> tuple[str, ...]:
        """NOT NULL columns: declared ones plus the primary key and mandatory FKs."""
        cols = list(self.not_null) + list(self.primary_key)
        cols += [fk.column for fk in self.foreign_keys if not fk.optional]
        return tuple(dict.fromkeys(cols))


def load_order(specs: Mapping[str, TableSpec]) -> list[str]:
    """Parents before children (topological order of the FK graph)."""
    order: list[str] = []
    state: dict[str, int] = {}

    def visit(name: str) -> None:
        mark = state.get(name, 0)
        if mark == 2:
            return
        if mark == 1:
            raise ValueError(f"foreign-key cycle through {name}")
        state[name] = 1
        for fk in specs[name].foreign_keys:
            if fk.parent in specs and fk.parent != name:
                visit(fk.parent)
        state[name] = 2
        order.append(name)

    for name in sorted(specs):
        visit(name)
    return order


def drop_order(specs: Mapping[str, TableSpec]) -> list[str]:
    """Children before parents."""
    return list(reversed(load_order(specs)))


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_I, _S, _L, _D = T.IntegerType(), T.StringType(), T.LongType(), T.DoubleType()

# The driver's star schema, declared once so integrity and snapshot code can use it.
STAR_SCHEMA: dict[str, TableSpec] = {
    "region": TableSpec("region", _schema(("r_regionkey", _I, False), ("r_name", _S, True)),
                        ("r_regionkey",)),
    "nation": TableSpec("nation", _schema(("n_nationkey", _I, False), ("n_name", _S, True),
                                          ("n_regionkey", _I, True)),
                        ("n_nationkey",), (ForeignKey("n_regionkey", "region", "r_regionkey"),)),
    "customer": TableSpec("customer", _schema(("c_custkey", _L, False), ("c_name", _S, True),
                                              ("c_nationkey", _I, True), ("c_acctbal", _D, True),
                                              ("c_mktsegment", _S, True)),
                          ("c_custkey",), (ForeignKey("c_nationkey", "nation", "n_nationkey"),)),
    "supplier": TableSpec("supplier", _schema(("s_suppkey", _L, False), ("s_name", _S, True),
                                              ("s_nationkey", _I, True), ("s_acctbal", _D, True)),
                          ("s_suppkey",), (ForeignKey("s_nationkey", "nation", "n_nationkey"),)),
    "part": TableSpec("part", _schema(("p_partkey", _L, False), ("p_name", _S, True), ("p_brand", _S, True),
                                      ("p_type", _S, True), ("p_size", _I, True), ("p_retailprice", _D, True)),
                      ("p_partkey",)),
    "orders": TableSpec("orders", _schema(("o_orderkey", _L, False), ("o_custkey", _L, True),
                                          ("o_orderstatus", _S, True), ("o_totalprice", _D, True),
                                          ("o_orderdate", T.TimestampType(), True),
                                          ("o_orderpriority", _S, True)),
                        ("o_orderkey",), (ForeignKey("o_custkey", "customer", "c_custkey"),)),
    "lineitem": TableSpec("lineitem", _schema(("l_orderkey", _L, False), ("l_partkey", _L, True),
                                              ("l_suppkey", _L, True), ("l_linenumber", _I, False),
                                              ("l_quantity", _D, True), ("l_extendedprice", _D, True),
                                              ("l_discount", _D, True), ("l_tax", _D, True),
                                              ("l_returnflag", _S, True), ("l_linestatus", _S, True),
                                              ("l_shipdate", T.TimestampType(), True)),
                          ("l_orderkey", "l_linenumber"),
                          (ForeignKey("l_orderkey", "orders", "o_orderkey"),
                           ForeignKey("l_partkey", "part", "p_partkey"),
                           ForeignKey("l_suppkey", "supplier", "s_suppkey"))),
}
