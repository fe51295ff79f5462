"""Delimited snapshot loading: declared schema, strict or lenient typing.

The reference bulk-loads UTF-8 CSV with a header row, comma separator and
``"`` quoting, some tables through an all-text staging table that is cast on
insert.  Here a staged load is simply a CSV scan with a text schema followed by
one projection of cast expressions; no staging table exists.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions import casts
from kempt.model import TableSpec

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "nullValue": "",
    "emptyValue": "",
    "multiLine": "false",
}


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, *, mode: str = "FAILFAST",
                   multi_line: bool = False, options: Mapping[str, str] | None = None) -> DataFrame:
    """Typed CSV scan.  ``FAILFAST`` raises on a malformed record (strict load);
    ``PERMISSIVE`` turns unparsable fields into NULL.  ``multi_line`` reads quoted
    line breaks, which makes each file one unsplittable task: prefer Parquet
    snapshots for large text columns."""
    opts = {**CSV_OPTIONS, "mode": mode, "multiLine": str(multi_line).lower(), **(options or {})}
    return spark.read.schema(schema).options(**opts).csv(path)


def read_staged(spark: SparkSession, path: str, spec: TableSpec, text_columns: Mapping[str, str],
                *, lenient: bool = True) -> DataFrame:
    """Read with the listed columns as text, then cast each to its declared type.

    ``text_columns`` maps column -> cast kind: ``"int"`` (``'299.0'`` -> 299)
    or ``"decimal"`` (the declared decimal).
    Lenient casts give NULL on bad text; strict ones raise.
    """
    raw = read_delimited(spark, path, spec.staging_schema(text_columns), mode="FAILFAST")
    return type_staged(raw, spec, text_columns, lenient=lenient)


def type_staged(raw: DataFrame, spec: TableSpec, text_columns: Mapping[str, str], *,
                lenient: bool = True) -> DataFrame:
    """The cast projection of a staged load (INSERT ... SELECT TRY_CAST ...)."""
    exprs: list[Column] = []
    for field in spec.schema.fields:
        kind = text_columns.get(field.name)
        c = F.col(field.name)
        if kind is None:
            exprs.append(c.cast(field.dataType).alias(field.name))
        elif kind == "int":
            to = field.dataType.simpleString()
            exprs.append((casts.lenient_int(c, to) if lenient else casts.strict_int(c, to)).alias(field.name))
        elif kind == "decimal":
            dt = field.dataType
            if not isinstance(dt, T.DecimalType):
                raise TypeError(f"{field.name}: decimal staging needs a DecimalType column")
            e = casts.lenient_decimal(c, dt.precision, dt.scale) if lenient else F.trim(c).cast(dt)
            exprs.append(e.alias(field.name))
        else:
            raise ValueError(f"unknown cast kind {kind!r}")
    return raw.select(*exprs)


def cast_failures(raw: DataFrame, casted: Mapping[str, Column]) -> DataFrame:
    """One aggregate over the staged text: per column, rows whose non-blank text
    the cast turned into NULL (``failed_<column>``)."""
    return raw.agg(*[F.count_if(casts.cast_failed(F.col(c), e)).alias(f"failed_{c}")
                     for c, e in casted.items()])
