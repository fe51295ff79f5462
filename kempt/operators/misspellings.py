"""Misspelling discovery by deletion neighbourhoods.

Two values within one edit of each other share what is left when one character
is deleted from one or both of them.  So every distinct value is indexed under
itself and under each of its one-deletion forms, and values that meet in the
index are the candidates; no pair of values that do not meet is ever looked at.

For distance 1 the index key says more: a substitution deletes the *same*
position on both sides, an insertion meets the *whole* other value.  Every
candidate is then within distance 1, so the pairs are as many as the answers.
For distance 2 the forms have up to two deletions and candidates are checked.

A value of n characters has n forms (n * (n - 1) / 2 more for distance 2).  A
form of n characters can only come from the (n + 1) * alphabet values around
it, so its group is bounded by the spelling and not by the table: repeated
values are counted before they are indexed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.session import cut_lineage


def without(value: Column, position: Column) -> Column:
    """``value`` without the character at ``position`` (from 1)."""
    return F.concat(F.substring(value, F.lit(1), position - 1), F.substring(value, position + 1, F.length(value)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)`` of the non-NULL values, with a partial count before the shuffle."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _deletions(values: DataFrame) -> DataFrame:
    """``(value, n, position, form)``: every one-deletion form."""
    at = F.when(F.length("value") > 0, F.sequence(F.lit(1), F.length("value"))).otherwise(F.array().cast("array<int>"))
    return values.select("value", "n", F.explode(at).alias("position")).withColumn("form", without(F.col("value"), F.col("position")))


def _side(rows: DataFrame, p: str, *keys: str) -> DataFrame:
    return rows.select(F.col("value").alias(p), F.col("n").alias(f"n_{p}"), *keys)


def neighbours(values: DataFrame, max_distance: int = 1) -> DataFrame:
    """All unordered pairs ``(a, n_a, b, n_b, distance)``, a < b, of values within ``max_distance`` (1 or 2) edits."""
    forms = cut_lineage(_deletions(values))
    if max_distance == 1:
        left, right = _side(forms, "a", "form", "position"), _side(forms, "b", "form", "position")
        swapped = left.join(right, ["form", "position"]).where("a < b").select("a", "n_a", "b", "n_b")
        shorter = _side(values, "s").join(_side(forms, "l", "form"), F.col("s") == F.col("form")).select("s", "n_s", "l", "n_l").distinct()
        first = F.col("s") < F.col("l")
        added = shorter.select(F.when(first, F.col("s")).otherwise(F.col("l")).alias("a"), F.when(first, F.col("n_s")).otherwise(F.col("n_l")).alias("n_a"),
                               F.when(first, F.col("l")).otherwise(F.col("s")).alias("b"), F.when(first, F.col("n_l")).otherwise(F.col("n_s")).alias("n_b"))
        return swapped.unionByName(added).withColumn("distance", F.lit(1))
    if max_distance != 2:
        raise ValueError("max_distance is 1 or 2")
    at = F.when(F.length("form") > 0, F.sequence(F.lit(1), F.length("form"))).otherwise(F.array().cast("array<int>"))
    twice = forms.select("value", "n", "form", F.explode(at).alias("position")).select("value", "n", without(F.col("form"), F.col("position")).alias("form"))
    index = cut_lineage(values.select("value", "n", F.col("value").alias("form")).unionByName(forms.select("value", "n", "form"))
                        .unionByName(twice).distinct())
    pairs = _side(index, "a", "form").join(_side(index, "b", "form"), "form").where("a < b").select("a", "n_a", "b", "n_b").distinct()
    distance = F.levenshtein("a", "b")
    return pairs.withColumn("distance", distance).where(F.col("distance") <= 2)


def misspellings(df: DataFrame, column: str, *, ratio: int = 10, max_distance: int = 1) -> DataFrame:
    """Rare values beside a frequent one: ``(suspect, n_suspect, suggestion, n_suggestion, distance)``.

    A value is suspect where a value within ``max_distance`` edits occurs at
    least ``ratio`` times as often; its suggestion is the most frequent such
    value, of equal ones the nearest, then the least.  NULLs are no values; the
    empty text is one.
    """
    pairs = neighbours(cut_lineage(value_counts(df, column)), max_distance)
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("suspect"), F.col("n_a").alias("n_suspect"), F.col("b").alias("suggestion"), F.col("n_b").alias("n_suggestion"), "distance"),
        F.struct(F.col("b").alias("suspect"), F.col("n_b").alias("n_suspect"), F.col("a").alias("suggestion"), F.col("n_a").alias("n_suggestion"), "distance"))))
    rare = both.where(F.col("n_suggestion") >= ratio * F.col("n_suspect"))
    best = F.min(F.struct((-F.col("n_suggestion")).alias("m"), "distance", "suggestion"))
    return (rare.groupBy("suspect", "n_suspect").agg(best.alias("_b"))
            .select("suspect", "n_suspect", F.col("_b.suggestion").alias("suggestion"), (-F.col("_b.m")).alias("n_suggestion"), F.col("_b.distance").alias("distance")))
