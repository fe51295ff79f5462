"""Edit fingerprints: walks, likeness, successors, distances and near duplicates."""

import hashlib
import random

import numpy as np

from kempt.llm import edit_fingerprints as ef

ROWS = [(5, "abc def ghi"), (9, None), (2, "x"), (7, "é日本 text 😀 " * 50), (7, "é日本 text 😀 " * 50), (1, ""), (None, "no id"), (30, "long " * 20000)]


def edits(rng, text, k):
    chars = list(text)
    for _ in range(k):
        at = rng.randrange(len(chars))
        rng.choice([lambda: chars.pop(at), lambda: chars.insert(at, rng.choice("qxz")), lambda: chars.__setitem__(at, rng.choice("qxz"))])()
    return "".join(chars)


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 8))) for _ in range(n))


def test_fingerprints_do_not_depend_on_company():
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(0, 300)) for _ in range(80)] + ["", "a", prose(rng, 4000)]
    together = ef.fingerprints(texts)
    for i, t in enumerate(texts):
        assert (ef.fingerprints([t])[0] == together[i]).all()
    assert not together[80].any() and together[81].all()


def test_likeness_falls_with_edits():
    rng = random.Random(2)
    texts = [prose(rng, 250) for _ in range(60)]
    base = ef.fingerprints(texts)
    means = [ef.likeness(base, ef.fingerprints([edits(rng, t, k) for t in texts])).mean() for k in (0, 1, 10, 100)]
    assert means[0] == 1 and means[0] > means[1] > means[2] > means[3]
    assert means[1] > 0.9 and ef.likeness(base[1:], base[:-1]).mean() < 0.2


def test_edit_distance_equals_dynamic_programme():
    rng = random.Random(3)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ("".join(rng.choices("ab", k=rng.randint(0, 12))) for _ in range(2))
        most = rng.randint(0, 12)
        assert ef.edit_distance(a, b, most) == min(plain(a, b), most + 1)


def test_successors_equal_brute_force(docs_of):
    got = ef.with_successors(docs_of(ROWS), chars=200).collect()
    assert len(got) == len(ROWS)
    ordered = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in ordered]
    following = texts[1:] + texts[:1]
    changed = [t[:len(t) - len(t) // 2] + f[:len(t) // 2] for t, f in zip(texts, following)]
    prints, after = ef.fingerprints(texts), ef.fingerprints(changed)
    expected = {(i, len(t), hashlib.sha256(c.encode()).hexdigest(), p.tobytes().hex(), a.tobytes().hex(),
                 float((p == a).mean()), float((p == n).mean()))
                for (i, _), t, c, p, a, n in zip(ordered, texts, changed, prints, after, ef.fingerprints(following))}
    assert {tuple(r) for r in got} == expected


def test_successors_of_few_rows(docs_of):
    (row,) = ef.with_successors(docs_of([(3, "abcd")])).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert ef.with_successors(docs_of([(None, "abcd"), (None, "xy")])).count() == 2
    assert ef.with_successors(docs_of([(3, "abcd")]).limit(0)).count() == 0


def test_near_duplicates_join_edited_copies(docs_of):
    rng = random.Random(4)
    rows, family = [], {}
    for f in range(8):
        base = prose(rng, 200)
        for k in range(6):
            rows.append((len(rows) + 1, edits(rng, base, 3 * k) if k else base))
            family[len(rows)] = f * 6 + 1
    rows += [(100, ""), (101, None), (102, "lone text"), (103, rows[0][1])]
    got = {r.doc_id: r.component_id for r in ef.near_duplicates(docs_of(rows), band_slots=4).collect()}
    assert {i: got[i] for i in (100, 101, 102, 103)} == {100: 100, 101: 101, 102: 102, 103: 1}
    assert all((got[i] - 1) // 6 == (least - 1) // 6 for i, least in family.items())  # no two families meet
    assert sum(got[i] == least for i, least in family.items()) >= 0.95 * len(family)  # bands are sampled


def test_defaults_find_edited_copies_up_to_the_stated_distance(docs_of):
    rng = random.Random(8)
    rows, pairs = [], []
    for words in (5, 40, 400):
        for rate in (0.01, 0.05, 0.1, 0.19):
            for _ in range(8):
                base = prose(rng, words)
                near = edits(rng, base, max(1, int(rate * len(base))))
                if ef.edit_distance(base, near, len(base)) <= 0.2 * max(len(base), len(near)):
                    pairs.append((len(rows), len(rows) + 1))
                rows += [(len(rows), base), (len(rows) + 1, near)]
    got = {r.doc_id: r.component_id for r in ef.near_duplicates(docs_of(rows)).collect()}
    assert len(pairs) >= 80 and sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
    assert all(got[i] // 2 == i // 2 for i in got if len(rows[i][1]) > 100)  # no other long texts meet


def test_far_distances_equal_dynamic_programme():
    rng = random.Random(9)
    for _ in range(40):
        a, b = ("".join(rng.choices("abcé😀", k=rng.randint(60, 160))) for _ in range(2))
        table = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(table[j] + 1, new[-1] + 1, table[j - 1] + (x != y)))
            table = new
        assert ef._unlike(a, b) <= table[-1] == ef.edit_distance(a, b, 200)
        for most in (33, table[-1] - 1, table[-1]):
            assert ef.edit_distance(a, b, most) == (min(table[-1], most + 1) if abs(len(a) - len(b)) <= most else most + 1)
