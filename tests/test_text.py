from pyspark.sql import functions as F

from kempt.functions import text


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_non_ascii_detects_outside_printable_range(spark):
    assert one(spark, "Long-acting Î²-adrenoceptor", text.has_non_ascii)
    assert one(spark, "tab\there", text.has_non_ascii)
    assert not one(spark, "Plain ASCII ~!", text.has_non_ascii)
    assert one(spark, None, text.has_non_ascii) is None


def test_code_points_at_first_artifact(spark):
    v = "Doctorâ€™s Chemical Works Ltd."
    pos = one(spark, v, text.first_non_ascii_pos)
    assert pos == 7
    got = [one(spark, v, lambda c, i=i: text.code_point_at(c, text.first_non_ascii_pos(c) + i)) for i in range(3)]
    assert got == [226, 8364, 8482]


def test_code_point_guards_no_match_and_past_end(spark):
    # position 0 (no match) must not fall back to the first character
    assert one(spark, "abc", lambda c: text.code_point_at(c, F.lit(0))) is None
    assert one(spark, "abcé", lambda c: text.code_point_at(c, F.lit(5))) is None
    assert one(spark, "abcé", lambda c: text.code_point_at(c, F.lit(4))) == 233


def test_mojibake_chain_repairs_each_artifact(spark):
    cases = {
        "Doctorâ€™s": "Doctor’s",
        "ParacetamolÂ+ÂTramadol": "Paracetamol + Tramadol",
        "costÂfree": "cost free",
        "SjÃ¶gren": "Sjögren",
        "Î²-blocker": "β-blocker",
    }
    for raw, fixed in cases.items():
        assert one(spark, raw, text.repair_mojibake) == fixed


def test_replacements_apply_in_order(spark):
    chain = (("a", "b"), ("b", "c"))
    assert one(spark, "a", lambda c: text.replace_all(c, chain)) == "c"
    assert one(spark, "a", lambda c: text.replace_all(c, tuple(reversed(chain)))) == "b"
    # binary semantics: the apostrophe sequence and the NBSP remnant never collide
    assert one(spark, "âÂ€™", text.repair_mojibake) == "â €™"


def test_collapse_spaces_single_pass_and_runs(spark):
    assert one(spark, "a   b", text.collapse_spaces) == "a  b"
    assert one(spark, "a   b", lambda c: text.collapse_spaces(c, single_pass=False)) == "a b"
    assert one(spark, "Bronson  Laboratories (BD) Ltd.", text.collapse_spaces) == "Bronson Laboratories (BD) Ltd."


def test_delimiter_classes(spark):
    assert one(spark, ",", text.delimiter_issue) == "lone"
    assert one(spark, ",Something", text.delimiter_issue) == "leading"
    assert one(spark, "4-Quinolone preparations,", text.delimiter_issue) == "trailing"
    assert one(spark, "4-Quinolone preparations,Acute bacterial sinusitis", text.delimiter_issue) == "both_parts"
    assert one(spark, "Antacids", text.delimiter_issue) is None


def test_suffix_variants_case_sensitive(spark):
    assert one(spark, "West-Coast pharmaceutical works ltd.", text.suffix_variant) == "lowercase ltd."
    assert one(spark, "ADM Protexin Ltd", text.suffix_variant) == "Ltd"
    assert one(spark, "Acme Ltd.", text.suffix_variant) == "Ltd."
    assert one(spark, "Acme Limited", text.suffix_variant) == "Limited"
    assert one(spark, "Acme Inc", text.suffix_variant) is None


def test_lowercase_word_with_exclusions(spark):
    assert one(spark, "West-Coast pharmaceutical works", text.has_lowercase_word)
    assert not one(spark, "Bureau of Standards", text.has_lowercase_word)
    assert not one(spark, "Acme Pharma Ltd.", text.has_lowercase_word)


def test_text_before_guard(spark):
    assert one(spark, "a,b,c", lambda c: text.text_before(c, ",")) == "a"
    assert one(spark, "abc", lambda c: text.text_before(c, ",")) is None


def test_suffix_repairs(spark):
    assert one(spark, "ADM Protexin Ltd", lambda c: text.append_if_endswith(c, "Ltd", ".")) == "ADM Protexin Ltd."
    assert one(spark, "X works ltd.", lambda c: text.replace_when_endswith(c, "ltd.", "ltd.", "Ltd.")) == "X works Ltd."
    assert one(spark, ",,a,,", lambda c: text.strip_chars(c, ",")) == "a"


def test_lowercase_word_case_insensitive_parity(spark):
    ci = lambda c: text.has_lowercase_word(c, case_insensitive=True)
    assert one(spark, "Acme Pharma Ltd.", ci)           # any letter after a space matches
    assert not one(spark, "Bureau OF Standards", ci)    # exclusions match in any case
    assert not one(spark, "Acme Pharma Ltd.", text.has_lowercase_word)
