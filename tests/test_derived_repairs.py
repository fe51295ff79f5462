"""Repairs worked out from garbled text against Python's own codecs."""

from pyspark.sql import functions as F

from kempt.functions.text import MOJIBAKE_REPAIRS
from kempt.operators import derived_repairs


def garbled(text):
    return "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())


def test_every_character_comes_back(spark):
    chars = [chr(c) for c in [*range(0xA1, 0x250), *range(0x391, 0x3CA), *range(0x2010, 0x2027), 0x20AC, 0x2122, 0x1F600, 0x65E5]]
    df = spark.createDataFrame([(f"x {garbled(c)} y",) for c in chars], "t string")
    got = {r.artifact: r.repair for r in derived_repairs.derive_repairs(df, "t").collect()}
    assert got == {garbled(c): c for c in chars}


def test_fixed_pairs_are_found_and_counted(spark):
    texts = ["Doctorâ€™s noteâ€™s", "costÂfree", "5Â+Â10", "kÃ¶ln Ã¶", "Î²-blocker", "clichÃ©", "Â", "naïve café Ömer ÇA «x»", None, "", "Ã", "â€"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {(r.artifact, r.repair, r.kind, r.affected_rows) for r in derived_repairs.derive_repairs(df, "t").collect()}
    decoded, lost = derived_repairs.DECODED, derived_repairs.LOST_SPACE
    assert got == {("â€™", "’", decoded, 1), ("Â", " ", lost, 2), ("Â+Â", " + ", lost, 1), ("Ã¶", "ö", decoded, 1), ("Î²", "β", decoded, 1), ("Ã©", "é", decoded, 1)}
    assert set(MOJIBAKE_REPAIRS) <= {g[:2] for g in got}


def test_rules_repair_the_text(spark):
    df = spark.createDataFrame([("1 5Â+Â10 â€™ Ã¶ costÂfree",)], "t string")
    value = F.col("t")
    for rule in derived_repairs.as_rules(derived_repairs.derive_repairs(df, "t"), "t"):
        value = rule.apply(value)
    assert df.select(value).first()[0] == "1 5 + 10 ’ ö cost free"


def test_invalid_bytes_have_no_repair(spark):
    df = spark.createDataFrame([("í \u0080",), ("à\u0080\u0080",)], "t string")  # a surrogate, an overlong form
    assert derived_repairs.derive_repairs(df, "t").count() == 0
