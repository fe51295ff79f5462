"""The n-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest

from kempt.llm import jaccard
from kempt.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, num=80, den=100):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return {doc: (len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)}


def corpus(seed, n_families=12, per_family=12):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    common_passage = rng.choices(vocabulary, k=60)
    rows = []
    for _ in range(n_families):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 40, 120, 300]))
        if rng.random() < 0.5:
            base = common_passage + base
        for _ in range(per_family):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary).upper()
            if rng.random() < 0.3:
                words = words[rng.randrange(3):]
            rows.append((len(rows) * 3 + 1, " ".join(words)))
    return rows + [(5000, None), (5001, ""), (5002, " \n "), (5003, "One two"), (5004, "one TWO"), (5005, "one  two three")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("options", [{}, {"sketch_bits": 6, "block_rows": 4}])
def test_components_equal_brute_force(docs_of, seed, options):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs_of(rows), **options).collect()}
    assert got == brute(rows)


def test_long_lists_with_salts_equal_brute_force(docs_of):
    """A small sketch calls every list long, so pivots of salts and of lists are used."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs_of(rows), sketch_bits=8).collect()}
    assert got == brute(rows)


def test_divide_skip_equals_brute_force():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(120)]
    index = jaccard.InvertedLists(sets)
    for query in sets:
        expected = [i for i, s in enumerate(sets) if len(s) and len(query)
                    and 100 * len(np.intersect1d(s, query)) >= 50 * len(np.union1d(s, query))]
        for weight in (0.0, 0.01, 1.0):
            assert sorted(index.search(query, 50, 100, weight)) == expected


def test_wide_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(40):
        a = np.unique(rng.integers(0, 1 << 63, 2500, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 1 << 63, rng.integers(0, 2500), dtype=np.uint64)]))
        assert jaccard._unlike(jaccard._wide_bitmap(a), jaccard._wide_bitmap(b)) <= len(np.setxor1d(a, b))


def test_empty_table_and_extra_columns(spark, docs_of):
    assert jaccard.near_duplicates(docs_of([(1, "a")]).limit(0)).count() == 0
    docs = docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "x"), (None, "x"), (None, None)])
    docs = docs.withColumnsRenamed({"lang": "set_id", "source": "id", "n_chars": "n"})
    kept = jaccard.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (True, 0), (True, 0)]


def test_connected_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (5, 4)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{k: 1000 for k in range(1000, 1100)}}


def test_rows_of_one_id_are_told_apart_by_their_texts(spark, docs_of):
    a, b, c = (" ".join(f"{p}{i}" for i in range(40)) for p in "abc")
    rows = [(1, a), (1, a), (1, b), (2, b + " end"), (3, c), (3, c + " end"), (4, None), (4, ""), (None, a), (5, a), (6, c)]
    kept = jaccard.keep_representatives(docs_of(rows))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    three = [x for x in got if x[0] == 3]
    assert len(three) == 1 and three[0][1] in (c, c + " end")  # linked rows of one id: one stays
    assert sorted((x for x in got if x[0] != 3), key=str) == sorted([(1, a), (1, b), (4, None), (4, ""), (None, a)], key=str)
    assert kept.columns == docs_of(rows).columns


def test_many_copies_get_their_component_by_broadcast(spark, docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, text) for i in range(1500)] + [(2000, text + " more"), (2001, "other words that stand quite alone here"), (2002, None)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs_of(rows)).collect()}
    assert got == {**{i: 0 for i in range(1500)}, 2000: 0, 2001: 2001, 2002: 2002}


def brute_components(edges):
    least = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            least.setdefault(a, a)
            least.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if a in least and b in least and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                moved = True
    return least


@pytest.mark.parametrize("seed", [1, 2])
def test_connected_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + k, 1001 + k) for k in range(30)]
    edges += [(500, 600 + k) for k in range(40)] + [(None, 1), (2, None), (None, None), (7000, 7000), (-5, -9), (-9, -5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute_components(edges)


def test_stars_take_few_jobs(spark, scratch):
    """Every job and broadcast takes buffers and threads of the driver, however few the rows."""
    edges = [(100 * k, 100 * k + j) for k in range(5) for j in range(1, 8)]
    spark.createDataFrame(edges, "a long, b long").write.parquet(f"{scratch}/edges")
    spark.sparkContext.setJobGroup(scratch, "components")
    try:
        found = connected_components(spark.read.parquet(f"{scratch}/edges"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(scratch)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.node: r.root for r in found.collect()} == brute_components(edges)
    assert len(jobs) <= 10
