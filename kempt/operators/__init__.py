"""DataFrame -> DataFrame operators: repair rules, dimension merge, checks, profiles, reports."""

from kempt.operators import broadcast, checks, dimension, profile, report, rules

__all__ = ["broadcast", "checks", "dimension", "profile", "report", "rules"]
