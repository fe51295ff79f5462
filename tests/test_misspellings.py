"""Deletion neighbourhoods against all pairs."""

import random

import pytest

from kempt.operators import misspellings


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def names(seed, n):
    rng = random.Random(seed)
    out = ["", "a", "aa", "ab", "ba", "aab", "naïve", "naive", "日本", "日本語", "😀x", "x"]
    out += ["".join(rng.choice("abé ") for _ in range(rng.randrange(1, 8))) for _ in range(n)]
    return [rng.choice(out) for _ in range(3 * n)] + [None]


@pytest.mark.parametrize("d", [1, 2])
def test_neighbours_equal_all_pairs(spark, d):
    data = names(d, 60)
    counts = {v: data.count(v) for v in data if v is not None}
    found = misspellings.neighbours(misspellings.value_counts(spark.createDataFrame([(v,) for v in data], "nm string"), "nm"), d)
    want = {(a, counts[a], b, counts[b], distance(a, b)) for a in counts for b in counts if a < b and distance(a, b) <= d}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and {(a, x, b, y, n) if a < b else (b, y, a, x, n) for a, x, b, y, n in got} == want
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_suggestions(spark):
    data = ["Pharmaceuticals"] * 40 + ["Pharmaceuticls"] * 2 + ["Pharmaceutical"] * 30 + ["Pharmaceutica"] + ["Farma"] * 3 + [None] * 50
    got = {r.suspect: tuple(r)[1:] for r in misspellings.misspellings(spark.createDataFrame([(v,) for v in data], "nm string"), "nm").collect()}
    assert got == {"Pharmaceuticls": (2, "Pharmaceuticals", 40, 1), "Pharmaceutica": (1, "Pharmaceutical", 30, 1)}
    assert misspellings.misspellings(spark.createDataFrame([], "nm string"), "nm").count() == 0
