"""Token files, packing and the chunk encoder against the tokenizer itself."""

import random
import tempfile
import zlib

import numpy as np
import pytest

from kempt.llm import packing, token_files, tokens

TEXTS = [(4, "Hello, WORLD. It's don't 12.5 <|endoftext|> x"), (1, None), (2, ""), (3, "é́ ΣΑΣ İ. ſ क़. ² a.\n\tb  c"),
         (3, "é́ ΣΑΣ İ. ſ क़. ² a.\n\tb  c"), (None, "no id"), (9, "word " * 3000), (10, "日本語 text " * 40)]


def plain(text, end):
    encode = tokens.encoder(tokens.default_tokenizer()).tokenizer.encode
    return [*encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunks_encode_like_whole_texts():
    own = tokens.ChunkEncoder(tokens.default_tokenizer(), max_chunks=50)  # emptied often
    rng = random.Random(7)
    parts = [*"aAbZé É\n\t.,'’12½٣ΣςİK中!%$\x1c\xa0²", "<|endoftext|>", "I'm ", "don't.", " foo, ", "Foo."]
    for _ in range(400):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(3)] + [None]
        flat, at = own.encode(texts)
        for i, t in enumerate(texts):
            assert flat[at[i]:at[i + 1]].tolist() == own.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_no_texts_have_no_ids():
    flat, at = tokens.ChunkEncoder(tokens.default_tokenizer()).encode([])
    assert len(flat) == 0 and at.tolist() == [0]


def test_token_files_round_trip(spark, docs_of):
    folder = tempfile.mkdtemp(prefix="kempt-tok-") + "/files"
    token_files.write_token_files(docs_of(TEXTS), folder, tokenizer=tokens.default_tokenizer(), end_id=2, partitions=3)
    rows = token_files.read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
    expected = sorted(TEXTS, key=lambda r: (r[0] is None, r[0] or 0))
    assert [r["id"] for r in rows] == [i for i, _ in expected]
    start = 0
    for row, (_, text) in zip(rows, expected):
        ids = plain(text, 2)
        assert (row["start"], row["n_tokens"], row["ids"], row["ids_crc32"]) == (start, len(ids), ids, crc(ids))
        start += len(ids)


def test_empty_table_gives_empty_files(spark, docs_of):
    folder = tempfile.mkdtemp(prefix="kempt-tok-") + "/files"
    docs = docs_of(TEXTS).limit(0)
    token_files.write_token_files(docs, folder, tokenizer=tokens.default_tokenizer(), end_id=2, partitions=2)
    assert token_files.read_token_files(spark, folder).count() == 0
    assert packing.pack(docs, tokenizer=tokens.default_tokenizer(), end_id=1).count() == 0


@pytest.mark.parametrize("capacity", [64, 2048])
def test_cut_lengths_are_reciprocal(capacity):
    for n in range(1, 3 * capacity):
        cut = packing.cut_lengths(n, capacity)
        assert sum(cut) == n
        assert all(length == capacity // (capacity // length) for length in cut)


def test_packing_places_every_id_once(spark, docs_of):
    rows = TEXTS + [(100 + i, "some words here " * (i % 37)) for i in range(300)]
    out = packing.pack(docs_of(rows), tokenizer=tokens.default_tokenizer(), end_id=1, capacity=256, with_ids=True).toPandas()
    assert out.length.sum() == sum(len(plain(t, 1)) for _, t in rows)
    for _, piece in out.iterrows():
        assert crc(piece.ids) == piece.ids_crc32 and len(piece.ids) == piece.length
    ordered = out.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()  # gapless from 0
    total = ordered.groupby("sequence_id").length.sum()
    assert total.max() <= 256 and sorted(total.index) == list(range(len(total)))
    padding = sum(0 if n & (n - 1) == 0 else 256 - n for n in total)
    assert padding <= 0.05 * total.sum()
    by_id = {i: t for i, t in rows if i is not None}
    for doc, own in out[out.doc_id.isin([4, 9, 10, 120])].sort_values("start").groupby("doc_id"):
        assert np.concatenate(list(own.ids)).tolist() == plain(by_id[doc], 1)
