"""Spark text expressions against plain-Python equivalents on seeded random strings
(one Spark job per property, thousands of cases)."""

import random
import re

from pyspark.sql import functions as F

from kempt.functions import text
from kempt.operators import dimension

TOKENS = ["a", "b", " ", "  ", ",", "é", "â€™", "Â", "Â+Â", "Ã¶", "Î²", "ß", "Ltd", "ltd.", "\n", "x,y", "’"]


def strings(n=3000, seed=7):
    rnd = random.Random(seed)
    return [(i, "".join(rnd.choice(TOKENS) for _ in range(rnd.randint(0, 8)))) for i in range(n)]


def py_mojibake(s):
    for a, b in text.MOJIBAKE_REPAIRS:
        s = s.replace(a, b)
    return s


def py_class(s):
    if s.startswith(","):
        return dimension.UNRECOVERABLE
    st = s.strip(",") if s.endswith(",") else s
    if "," in st:
        return dimension.COMPOSITE
    return dimension.STRIP if s.endswith(",") else dimension.CLEAN


def py_first_code_point(s):
    m = re.search(r"[^ -~]", s)
    return ord(m.group()) if m else None


def test_text_expressions_match_python(spark):
    rows = strings()
    df = spark.createDataFrame(rows, "id int, s string")
    c = F.col("s")
    got = df.select(
        "id", text.repair_mojibake(c).alias("moji"), dimension.member_class(c).alias("cls"),
        text.collapse_spaces(c).alias("spaces"), text.strip_chars(c, ",").alias("stripped"),
        text.text_before(c, ",").alias("before"), text.has_non_ascii(c).alias("na"),
        text.code_point_at(c, text.first_non_ascii_pos(c)).alias("cp"),
        text.has_extra_spaces(c).alias("extra")).orderBy("id").collect()
    for (i, s), r in zip(rows, got):
        assert r["moji"] == py_mojibake(s), s
        assert r["cls"] == py_class(s), s
        assert r["spaces"] == s.replace("  ", " "), s
        assert r["stripped"] == s.strip(","), s
        assert r["before"] == (s.split(",")[0] if "," in s else None), s
        assert r["na"] == bool(re.search(r"[^ -~]", s)), s
        assert r["cp"] == py_first_code_point(s), s
        assert r["extra"] == ("  " in s or s.startswith(" ") or s.endswith(" ")), s
