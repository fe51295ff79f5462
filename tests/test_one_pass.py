"""One-pass replacement against the chain of REPLACE calls."""

import random

import pytest
from pyspark.sql import functions as F

from kempt.operators import one_pass


def chain(text, pairs):
    for a, b in pairs:
        text = text.replace(a, b)
    return text


def spark_results(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_500_rules_equal_the_chain(spark):
    rng = random.Random(1)
    pairs = [(f"<{i:03d}>", f"[{chr(65 + i % 26)}{i}]") for i in range(500)]
    assert one_pass.interference(pairs) is None
    texts = ["".join(rng.choice([f"<{rng.randrange(600):03d}>", "<", ">", "0", "12", " ", "é", "[A1]"]) for _ in range(rng.randrange(30))) for _ in range(300)]
    texts += ["", None, "<000><000>"]
    got = spark_results(spark, texts, one_pass.replace_all(F.col("t"), pairs))
    assert got == [None if t is None else chain(t, pairs) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_random_rules(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("ab.$\\é x") for _ in range(rng.randrange(1, n)))
    pairs = [(word(4), rng.choice([word(3), "", "Q", "(R)"])) for _ in range(rng.randrange(1, 5))]
    texts = ["".join(rng.choice("ab.$\\é x") for _ in range(rng.randrange(25))) for _ in range(150)]
    assert spark_results(spark, texts, one_pass.replace_all(F.col("t"), pairs)) == [chain(t, pairs) for t in texts]


def test_proof_is_sound():
    rng = random.Random(7)
    proven = 0
    for _ in range(4000):
        pairs = [("".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))), "".join(rng.choice("abcQR") for _ in range(rng.randrange(0, 3))))
                 for _ in range(rng.randrange(2, 4))]
        if one_pass.interference(pairs) is None:
            proven += 1
            table = dict(reversed(pairs))
            for _ in range(20):
                text = "".join(rng.choice("abc") for _ in range(rng.randrange(15)))
                out, i = "", 0
                while i < len(text):
                    hit = max((a for a in table if text.startswith(a, i)), key=len, default=None)
                    out, i = (out + table[hit], i + len(hit)) if hit else (out + text[i], i + 1)
                assert out == chain(text, pairs), (pairs, text)
    assert proven > 100


def test_longest_match_wins_and_rules_that_interfere_are_named():
    assert one_pass.interference([("Â+Â", " + "), ("Â", " ")]) == (0, 1)
    assert one_pass.interference([("ab", ""), ("cd", "x")]) == (0, 1)  # c + ab + d
    assert one_pass.interference([("ab", "c"), ("cd", "x")]) == (0, 1)
    assert one_pass.interference([("cd", "x"), ("ab", "c")]) is None  # the earlier rule does not see it


def test_longest(spark):
    pairs = [("a", "1"), ("ab", "2"), ("abc", "3"), ("b c", "4"), ("\\.$", "5")]
    assert spark_results(spark, ["abcab a b c \\.$ ."], one_pass.replace_once(F.col("t"), pairs)) == ["32 1 4 5 ."]
