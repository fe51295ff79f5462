"""The whole pipeline on a small snapshot against plain Python, stage by stage and through ``run``."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline
from kempt.llm import secrets, tokens, toxicity
from kempt.llm.common import documents, held_out

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"


def prose(rng, n):
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(n))


def snapshot(spark, folder):
    rng = random.Random(1)
    bench = [(k, prose(rng, 30)) for k in range(4)] + [(9, "short item"), (10, None)]
    rows, labels = [], []
    for i in range(260):
        text = prose(rng, rng.randint(5, 90))
        toxic = i % 4 == 0
        if toxic:
            words = text.split()
            for k in range(0, len(words), 3):
                words[k] = rng.choice(["zzvile", "zzfoul", "zzhate"])
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(toxic), None))
    clean = [t for i, t in rows if i % 4 and len(t.split()) > 40]
    rows += [(300 + k, t) for k, t in enumerate(clean[:20])]  # copies
    rows += [(330 + k, t + " tail") for k, t in enumerate(clean[:10])]  # near copies
    rows += [(350 + k, prose(rng, 12) + " " + bench[k % 4][1]) for k in range(6)] + [(360, bench[0][1])]
    rows += [(370 + k, prose(rng, 20) + ' password = "' + "".join(rng.choices("abcdef0123456789", k=24)) + '" ' + prose(rng, 5)) for k in range(12)]
    rows += [(400, None), (401, ""), (402, "one"), (None, prose(rng, 20)), (403, "é " * 3000), (5, prose(rng, 30)), (403, "ß " * 10), (404, "short item")]
    table = [(i, t, "en", "s", None if t is None else len(t), 0.5) for i, t in rows]
    spark.createDataFrame(table, DOCS).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return bench


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def representatives(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if sets[i] and sets[k] and 100 * both >= 80 * (len(sets[i]) + len(sets[k]) - both):
                root[find(i)] = find(k)
    groups = defaultdict(list)
    for i in range(len(rows)):
        if sets[i] and rows[i][0] is not None:
            groups[find(i)].append(rows[i][0])
    out = [r for r, s in zip(rows, sets) if not s or r[0] is None]
    return sorted([i for i, _ in out] + [min(ids) for ids in groups.values()], key=str)


def contaminated(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit = split(text), set()
    windows = {tuple(w[i:i + 13]) for _, t in items for w in [split(t)] if w for i in range(max(len(w) - 12, 1))}
    for w in windows:
        for s in range(len(words) - len(w) + 1):
            if tuple(words[s:s + len(w)]) == w:
                hit |= set(range(s, s + len(w)))
    return bool(hit) and 20 * len(hit) >= len(words)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_run_equals_plain_python(spark, tmp_path):
    sf = str(tmp_path)
    items = snapshot(spark, sf)
    docs = documents(spark, sf)
    before = pairs(docs)

    labels = documents(spark, sf, "labels").select("doc_id", "toxic").where(~held_out("doc_id", 3, 1))
    model = toxicity.fit(docs, labels)
    kept = pairs(corpus_pipeline.drop_toxic(spark, docs, sf))
    score = lambda t: toxicity.score(model, np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0]
    assert sorted(kept, key=str) == sorted([r for r in before if score(r[1]) < 0.7], key=str)
    gone = {i for i, _ in before} - {i for i, _ in kept}
    assert len(gone & set(range(0, 260, 4))) > 50 and not {i for i in gone if i >= 300 or i % 4}

    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 0.5) for i, t in rows], DOCS).repartition(3)
    unique = pairs(corpus_pipeline.drop_near_duplicates(spark, frame(kept), sf))
    assert sorted([i for i, _ in unique], key=str) == representatives(kept) and set(unique) <= set(kept)
    assert not {i for i, _ in unique} & (set(range(300, 320)) | set(range(330, 340)))

    clean = pairs(corpus_pipeline.drop_contaminated(spark, frame(unique), sf))
    assert sorted(clean, key=str) == sorted([r for r in unique if not contaminated(r[1], items)], key=str)
    assert not {i for i, _ in clean} & {*range(350, 356), 360, 404}

    redacted = corpus_pipeline.redact_secrets(spark, frame(clean), sf)
    assert redacted.columns == frame(clean).columns
    texts = dict((i, (t, n)) for i, t, n in redacted.select("doc_id", "text", "n_chars").collect() if i not in (5, 403, None))
    for i, t in clean:
        spans = secrets.base_spans(t or "")
        if i in texts and spans:
            assert "[SECRET]" in texts[i][0] and all(t[a:b] not in texts[i][0] for a, b, _ in spans) and texts[i][1] == len(texts[i][0])
    assert sum("[SECRET]" in (t or "") for t, _ in texts.values()) >= 12

    out = corpus_pipeline.run(spark, sf).collect()
    encode = tokens.ChunkEncoder(tokens.default_tokenizer()).tokenizer
    ids = {i: [*encode.encode(t or "", add_special_tokens=False).ids, 1] for i, (t, _) in texts.items()}
    found = defaultdict(list)
    used = defaultdict(list)
    for r in out:
        found[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        used[r.sequence_id].append((r.offset, r.length))
    assert {i for i in found} == {i for i, _ in clean}
    for i, own in ids.items():
        at = 0
        for start, length, crc, total in sorted(found[i]):
            assert (start, total) == (at, len(own)) and crc == zlib.crc32(np.array(own[at:at + length], "<u4").tobytes())
            at += length
        assert at == len(own)
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_snapshot(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


