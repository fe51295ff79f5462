"""Reports and profiles against plain-Python equivalents on seeded random tables."""

import random
from collections import Counter

from pyspark.sql import functions as F

from kempt.operators import checks, profile, report


def test_diff_summary_histogram_against_python(spark):
    rnd = random.Random(11)
    before = {i: rnd.choice(["a", "b", None, "c "]) for i in range(400) if rnd.random() < 0.8}
    after = {i: (v if rnd.random() < 0.7 else rnd.choice(["a", "z", None]))
             for i, v in before.items() if rnd.random() < 0.9}
    after.update({i: "new" for i in range(400, 430)})
    b = spark.createDataFrame(sorted(before.items()), "id int, nm string")
    a = spark.createDataFrame(sorted(after.items()), "id int, nm string")

    diff = {r["id"]: r["change"] for r in report.diff_snapshots(b, a, ["id"]).collect()}
    want = {}
    for i in set(before) | set(after):
        want[i] = ("added" if i not in before else "removed" if i not in after
                   else "same" if before[i] == after[i] else "changed")
    assert diff == want

    summary = checks.value_summary(b, "nm", {"nulls": lambda v: v.isNull(),
                                             "edge": lambda v: v != F.trim(v)}).first().asDict()
    counts = Counter(before.values())
    assert summary == {"total_rows": len(before), "nulls": counts[None], "edge": counts["c "],
                       "duplicate_values": sum(1 for n in counts.values() if n > 1)}

    groups = {r["nm"]: r["n_rows"] for r in checks.duplicate_groups(b, ["nm"]).collect()}
    assert groups == {k: n for k, n in counts.items() if n > 1}

    child = spark.createDataFrame([(i % 37,) for i in range(500)] + [(99,)] * 60, "k int")
    hist = {r["children"]: r["parents"] for r in profile.cardinality_histogram(child, ["k"]).collect()}
    sizes = Counter(Counter([i % 37 for i in range(500)] + [99] * 60).values())
    assert hist == dict(sizes)
