"""Decontamination against brute force."""

import hashlib
import random
import re

from kempt.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items, window=13):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + k]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, met = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                for item in windows.get(tuple(w[s:s + k]), ()):
                    hit.update(range(s, s + k))
                    met.add(item)
        names = ",".join(sorted(map(str, met)))
        out.append((doc, len(w), len(hit), len(met), hashlib.sha256(names.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def cases(seed):
    rng = random.Random(seed)
    pick = lambda n: rng.choices(["the", "of", "Ça", "É2", "x9", *[f"t{k}" for k in range(30)]], k=n)
    items = [(i, " ".join(pick(rng.choice([1, 3, 13, 14, 40])))) for i in range(12)] + [(90, None), (91, "!!"), (92, "the the the " * 6), (92, "the of")]
    rows = []
    for i in range(60):
        parts = [" ".join(pick(rng.choice([0, 5, 60])))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            w = words(rng.choice(items)[1])
            cut = rng.randrange(len(w) // 2 + 1)
            parts += [", ".join(w[cut:]).upper() if rng.random() < 0.5 else " ".join(w[cut:]), " ".join(pick(4))]
        rows.append((i, "\n".join(parts)))
    return rows + [(100, None), (101, ""), (102, "the " * 300), (102, "the " * 300), (None, rows[3][1])], items


def test_hits_equal_brute_force(spark, docs_of):
    for seed in (1, 2):
        rows, items = cases(seed)
        got = decontaminate.contamination(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"))
        columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        assert sorted(map(tuple, got.select(columns).collect()), key=repr) == brute(rows, items)


def test_clean_documents_stay_and_columns_too(spark, docs_of):
    item = " ".join(f"q{k}" for k in range(20))
    docs = docs_of([(1, item), (2, "clean words"), (3, "pad " * 1000 + item), (None, item)]).withColumnsRenamed({"lang": "row", "source": "term"})
    kept = decontaminate.keep_clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3]


def test_empty_tables(spark, docs_of):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs_of([(1, "a b")]), no_items).collect()] == [0]
    assert decontaminate.contamination(docs_of([(1, "a")]).limit(0), no_items).count() == 0


def test_proximity(spark, docs_of):
    docs = docs_of([(1, "alpha x x beta y alpha"), (2, "beta alpha"), (3, "alpha " + "x " * 50 + "beta")], parts=1)
    tokens = decontaminate.test_tokens(spark.createDataFrame([(1, "alpha beta")], "item_id long, text string"))
    documents, postings, terms = decontaminate.build_index(docs, tokens)
    got = decontaminate.proximity_matches(postings, terms, "alpha", "beta", 2).join(documents, "row")
    assert sorted((r.doc_id, r.left_pos, r.right_pos) for r in got.collect()) == [(1, 5, 3), (2, 1, 0)]
    assert decontaminate.proximity_matches(postings, terms, "alpha", "beta", 3).count() == 3


def test_native_plan(spark, docs_of):
    plan = decontaminate.contamination(docs_of([(1, "a b")]), spark.createDataFrame([(1, "a b")], "item_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_rows_are_judged_by_their_texts(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(13))
    rows = [(1, item), (1, "clean text of the same id"), (None, item), (None, "clean"), (2, None), (2, "")]
    kept = decontaminate.keep_clean(docs_of(rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, "clean text of the same id"), (None, item), (None, "clean"), (2, None), (2, "")], key=str)


def test_no_python_worker_is_started(spark, docs_of, monkeypatch):
    text = " ".join(f"w{k}" for k in range(40))
    docs, items = docs_of([(1, text), (2, "other words")]), docs_of([(7, text)]).selectExpr("doc_id as item_id", "text")

    def refuse(*args, **kwargs):
        raise AssertionError("rows from Python are dealt out by Python workers of their own")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    got = decontaminate.contamination(docs, items).select("doc_id", "n_hit", "contaminated").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 40, True), (2, 0, False)]
