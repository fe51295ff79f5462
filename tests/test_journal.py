"""The change journal: forward and back, whole or by rule, with conflicts reported."""

import random

from pyspark.sql import functions as F

from kempt.operators import journal, rules

SCHEMA = "id long, nm string, n int"
RULES = [rules.replace_rule("a to b", "nm", "a", "b"), rules.set_value("low", "n", 0, lambda c: c < 3),
         rules.replace_rule("bb to c", "nm", "bb", "c"), rules.Rule("trim", "nm", F.trim), rules.Rule("double", "n", lambda c: c * 2)]


def made(seed=1, n=200):
    rng = random.Random(seed)
    return [(i, rng.choice([None, "".join(rng.choice("ab c") for _ in range(rng.randrange(6)))]), rng.choice([None, 1, 2, 3, 9])) for i in range(n)]


def rows(df):
    return sorted(map(str, df.collect()))


def test_forward_and_back(spark):
    before = spark.createDataFrame(made(), SCHEMA)
    log = journal.change_journal(before, ["id"], RULES)
    after = rules.apply_rules(before, RULES)
    forward = journal.apply_journal(before, log, ["id"])
    assert rows(forward.rows) == rows(after) and forward.conflicts.count() == 0
    back = journal.roll_back(after, log, ["id"])
    assert rows(back.rows) == rows(before) and back.conflicts.count() == 0


def test_journal_lists_every_step(spark):
    def step(rule, nm, n):
        return {"a to b": (nm and nm.replace("a", "b"), n), "low": (nm, 0 if n is not None and n < 3 else n), "bb to c": (nm and nm.replace("bb", "c"), n),
                "trim": (nm and nm.strip(" "), n), "double": (nm, None if n is None else n * 2)}[rule.name]

    want = []
    for i, nm, n in made():
        for seq, rule in enumerate(RULES):
            old, (nm, n) = {"nm": nm, "n": n}, step(rule, nm, n)
            new = {"nm": nm, "n": n}
            if old[rule.column] != new[rule.column]:
                text = lambda v: None if v is None else str(v)
                want.append((i, rule.column, seq, rule.name, text(old[rule.column]), text(new[rule.column])))
    got = journal.change_journal(spark.createDataFrame(made(), SCHEMA), ["id"], RULES)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_last_rule_alone(spark):
    before = spark.createDataFrame(made(2), SCHEMA)
    log = journal.change_journal(before, ["id"], RULES)
    back = journal.roll_back(rules.apply_rules(before, RULES), log, ["id"], rules=["trim"])
    assert rows(back.rows) == rows(rules.apply_rules(before, [r for r in RULES if r.name != "trim"])) and back.conflicts.count() == 0


def test_conflicts_stay_and_are_reported(spark):
    before = spark.createDataFrame([(1, "a ", 9), (2, "a", 9), (3, "x", 1)], SCHEMA)
    log = journal.change_journal(before, ["id"], RULES)
    after = rules.apply_rules(before, RULES).withColumn("nm", F.when(F.col("id") == 2, "edited").otherwise(F.col("nm")))
    back = journal.roll_back(after, log, ["id"], rules=["a to b"])
    assert {(r.id, r.column_name, r.reason, r.current, r.expected) for r in back.conflicts.collect()} == {
        (1, "nm", "later change", "b", "b "), (2, "nm", "other value", "edited", "b")}
    assert rows(back.rows) == rows(after)
    assert {r.id for r in journal.roll_back(after, log, ["id"]).conflicts.collect()} == {2}


def test_null_keys_missing_rows_and_empty_journals(spark):
    before = spark.createDataFrame([(None, "a", 1), (5, "a", 1)], SCHEMA)
    log = journal.change_journal(before, ["id"], RULES)
    after = rules.apply_rules(before, RULES)
    assert rows(journal.roll_back(after, log, ["id"]).rows) == rows(before)
    assert rows(journal.roll_back(after.where("id = 5"), log, ["id"]).rows) == rows(before.where("id = 5"))
    assert rows(journal.roll_back(after, log.limit(0), ["id"]).rows) == rows(after)


def test_published_with_the_snapshot(spark, scratch):
    before = spark.createDataFrame(made(4), SCHEMA)
    log = journal.change_journal(before, ["id"], RULES)
    counts = journal.write_with_journal(rules.apply_rules(before, RULES), log, f"{scratch}/s", "names")
    assert counts == {"names": 200, "names__journal": log.count()}
    after, kept = journal.read_with_journal(spark, f"{scratch}/s", "names")
    assert rows(journal.roll_back(after, kept, ["id"]).rows) == rows(before)
