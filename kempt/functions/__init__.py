"""Column-level building blocks (pure Spark SQL expressions)."""

from kempt.functions import casts, text

__all__ = ["casts", "text"]
