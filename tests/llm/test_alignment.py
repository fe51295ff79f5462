"""Tokenizer alignment against both tokenizers' whole encodings, byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from kempt.llm import alignment, tokens
from kempt.llm.common import materialise

A, B = tokens.public_path("byte_bpe_50k.json"), tokens.public_path("piece_bpe_32k.model")
ODD = ["a", "  lead", "trail  ", "a\n b", "a\n\n  b c", "<|endoftext|> x <|endoftext|>", "é à 日本語 𝒳 ½", "▁x ▁ y", "<0x41> <0xE3>",
       "  x　 y", "\x1c a\x1d b", "tab\t here", "x" * 3000, "\r\n \r\n", "🏳️‍🌈 👨‍👩‍👧 ok", "\x00 a", "it's  we'll 've", "don 't", "   ",
       " \n a", "ﬁ ﬂ Å", "é x", "", None]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def plain(aligner, text):
    """(n_a, n_b, n_groups, n_links), groups and linked pairs from spans of decoded bytes."""
    if not text:
        return (0, 0, 0, 0), "", []
    text = " " + text
    a, b = aligner.a.encode(text, add_special_tokens=False).ids, aligner.b.encode(text[1:])
    spans = []
    for ids, table in ((a, aligner.bytes_a), (b, aligner.bytes_b)):
        at, own, joined = 0, [], b""
        for i in ids:
            own.append((at, at + len(table[i]), i))
            at += len(table[i])
            joined += table[i]
        if joined != text.encode():
            return (0, 0, 0, 0), "", []
        spans.append(own)
    cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    groups = [[",".join(str(i) for s, e, i in own if low <= s and e <= high) for own in spans] for low, high in zip([0, *cuts], cuts)]
    links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if max(s, t) < min(e, f)]
    return (len(a), len(b), len(groups), len(links)), ";".join("|".join(g) for g in groups), sorted(links)


def texts():
    rng = random.Random(3)
    letters = "ab \n\té日😀.'1▁<>0xE  "
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(400)]


def test_equals_whole_encodings(aligner):
    chunk = texts()
    numbers, groups, of_text, codes = aligner.texts(chunk)
    for i, text in enumerate(chunk):
        links = sorted((c >> alignment.SHIFT, c & 0xFFFFFF) for c in codes[of_text == i].tolist())
        assert (tuple(numbers[i][:4].tolist()), groups[i], links) == plain(aligner, text), text


def test_a_full_dictionary_is_emptied(aligner):
    small = alignment.Aligner(A, B, max_pieces=3)
    for start in range(0, 60, 7):
        part = texts()[start:start + 7]
        assert small.texts(part)[1] == aligner.texts(part)[1]


def test_query_columns(spark, aligner, monkeypatch):
    from kempt.llm import queries

    rng = random.Random(5)
    words = ["alpha", "beta", "naïve", "2024", "it's", "日本", "zz", "the"]
    chunk = [t for t in texts()[:60]] + [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(80)]
    rows = [(i % 120, t, "clash") for i, t in enumerate(chunk)]  # some ids repeat
    df = spark.createDataFrame(rows, "doc_id long, text string, groups string").repartition(4)
    monkeypatch.setattr(queries, "documents", lambda *_: df)
    whole = alignment.link_scores
    for frequent in (1 << 17, 5, 0):  # broadcast pairs, both ways, joined pairs
        monkeypatch.setattr(alignment, "link_scores", lambda aligned: whole(aligned, frequent=frequent))
        found = sorted([tuple(r) for r in queries.op12_tokenizer_alignment(spark, "").collect()], key=str)
        results = [plain(aligner, t) for t in chunk]
        held = Counter(p for _, _, links in results for p in set(links))
        best = defaultdict(int)
        for (a, _), n in held.items():
            best[a] = max(best[a], n)
        want = [(i, *n, sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                 hashlib.sha256(g.encode()).hexdigest() if n[0] else "") for (i, _, _), (n, g, links) in zip(rows, results)]
        assert found == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    aligned = materialise(alignment.align(df, path_a=A, path_b=B), "aligned")
    assert aligned.count() == 0 and alignment.link_scores(aligned).count() == 0
