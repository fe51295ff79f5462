"""Validation job: check a published snapshot against its table specs, fail loudly.

    spark-submit kempt/plans/validate_job.py <snapshot_root> \
        [--specs kempt.model:STAR_SCHEMA] [--expect "<check name>=<value>:<note>" ...]

Every constraint the specs declare (``checks.spec_report``) is expected to
have 0 issues unless ``--expect`` documents an exception.  The whole report (one
row per check) is printed; the process exits with status 1 when any check fails,
so a scheduler sees the failure.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kempt.operators import checks, report
from kempt.sources.snapshot import read_snapshot


def _load_specs(ref: str):
    module, _, attr = ref.partition(":")
    return getattr(importlib.import_module(module), attr)


def _parse_expectation(text: str) -> tuple[str, int, str | None]:
    name, _, rest = text.rpartition("=")
    value, _, note = rest.partition(":")
    return name, int(value), note or "documented exception"


def validate_snapshot(spark: SparkSession, root: str, specs, expectations=()):
    """The validation report of a snapshot: ``(check_name, actual, expected, status, note)``."""
    tables = read_snapshot(spark, root)
    specs = {n: s for n, s in specs.items() if n in tables}
    actual = checks.spec_report(tables, specs).select("check_name", F.col("issue_count").alias("actual"))
    overrides = {n: (v, note) for n, v, note in expectations}
    names = checks.spec_check_names(tables, specs)
    rows = [(n, *overrides.get(n, (0, None))) for n in names]
    rows += [(n, v, note) for n, (v, note) in overrides.items() if n not in names]
    return report.validate(actual, report.expectations(spark, rows))


def main(argv: list[str] | None = None) -> int:
    """Run the job; returns the process exit status (0 pass, 1 fail)."""
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("root")
    ap.add_argument("--specs", default="kempt.model:STAR_SCHEMA")
    ap.add_argument("--expect", action="append", default=[])
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    result = validate_snapshot(spark, args.root, _load_specs(args.specs),
                               [_parse_expectation(e) for e in args.expect])
    rows = result.orderBy("check_name").collect()   # one row per declared check
    print("\t".join(result.columns))
    for r in rows:
        print("\t".join("" if v is None else str(v) for v in r))
    return 1 if any(r["status"] == report.FAIL for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
