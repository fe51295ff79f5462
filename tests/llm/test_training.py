"""Models learn from every row: shards, their mean, and calibrations over all rows held back."""

import random

import numpy as np
from pyspark.sql import functions as F

from kempt.llm import secrets, toxicity, training


def watched(monkeypatch):
    """Rows that the shards learn from, and rows that the calibration counts."""
    learnt, counted = [], []
    shards, cells = training.over_shards, training.cells

    def over_shards(rows, *rest):
        learnt.append(rows.count())
        return shards(rows, *rest)

    def counting(*rest):
        out = cells(*rest)
        counted.append(out)
        return out

    monkeypatch.setattr(training, "over_shards", over_shards)
    monkeypatch.setattr(training, "cells", counting)
    return learnt, counted


def test_shards_move_the_start_by_their_weighted_mean(spark):
    def learn(p, rows):
        n = len(rows)
        p["a"] += np.float32(n)
        p["b"][n % 3] += 5
        return {"a": np.full(2, float(n)), "b": (np.arange(3) == n % 3) * 1.0}

    start = {"a": np.zeros((2, 4), np.float32), "b": np.zeros(3, np.float32)}
    rows = spark.range(1000).repartition(6, "id")
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    got = training.over_shards(rows, 6, start, learn)
    assert np.allclose(got["a"], sum(n * n for n in sizes) / sum(sizes)) and not start["a"].any()
    assert got["b"].tolist() == [5.0 if any(n % 3 == k for n in sizes) else 0.0 for k in range(3)]
    assert (training.over_shards(rows.where("id < 0"), 6, start, learn)["a"] == 0).all()


def test_shards_send_only_what_they_have_learnt(spark):
    def learn(p, rows):
        at = np.unique(np.array(rows["id"]) % 10_000)
        p["a"][at] += len(rows)
        weight = np.zeros(10_000)
        weight[at] = len(rows)
        return {"a": weight, "b": np.full(3, float(len(rows)))}

    start = {"a": np.zeros((10_000, 4), np.float32), "b": np.ones(3, np.float32)}
    rows = spark.range(300).repartition(6, "id")
    sent = training._changes(rows, start, learn).where("name = 'a'")
    assert sent.agg(F.sum(F.octet_length("weight")), F.sum(F.octet_length("change")), F.sum(F.octet_length("rows"))).first()[:] == (300 * 8, 300 * 32, 300 * 4)
    of = {r["id"]: r["n"] for r in rows.withColumn("p", F.spark_partition_id()).withColumn("n", F.expr("count(*) over (partition by p)")).collect()}
    got = training.over_shards(rows, 1, start, learn)
    assert (got["a"][:300] == np.array([of[k] for k in range(300)])[:, None]).all() and not got["a"][300:].any()
    assert (got["b"] == 1).all()


def test_cells_count_every_row(spark):
    rows = spark.createDataFrame([(k % 2, (k % 50) / 7 - 3) for k in range(999)] + [(1, 1e9)], "y long, x double")
    for parts in (1, 5):
        x, y, n = training.cells(rows.repartition(parts), ["x"], "y", 8, 30.0)
        assert n.sum() == 1000 and n[y == 1].sum() == 500 and x.max() == 30.0
        assert abs((x * n[:, None]).sum() - sum((k % 50) / 7 - 3 for k in range(999)) - 30) < 1e-2


def test_threshold_from_counts_keeps_both_shares():
    rng = np.random.default_rng(4)
    for means, recall in (((3, -3), 0.9), ((0.5, 0), 0.99), ((-1, 1), 0.7)):
        logit = np.concatenate([rng.normal(means[0], 1, 700), rng.normal(means[1], 1, 5000)])
        y = np.repeat([1, 0], [700, 5000])
        cell, first, n = np.unique(np.stack([y, np.floor(logit * 256)]), axis=1, return_index=True, return_counts=True)
        model = secrets.calibrated({}, logit[first], y[first], n.astype(float), recall)
        score = 1 / (1 + np.exp(-(logit * model["calibration"][0] + model["calibration"][1])))
        over = score >= model["threshold"]
        assert over[y == 1].mean() >= recall
        assert model["threshold"] > 0.5 - 1e-9 and over[y == 0].mean() <= 0.002 or over[y == 1].mean() < recall + 0.02


def test_secrets_learn_from_every_candidate(spark, monkeypatch):
    rng = random.Random(3)
    keys = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(400)]
    rows = [(k, f"see host.number{k}.example.com and token={keys[k]} or plainwordsofno{'abcdefghij'[k % 10] * 5}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = secrets.labelled_pieces(docs).distinct()
    total, found = pieces.count(), pieces.where("found").count()
    learnt, counted = watched(monkeypatch)
    models = [secrets.fit(docs.repartition(parts), max_pieces=50, shard_pieces=100) for parts in (1, 6)]
    (_, y, n), _ = counted
    assert learnt[0] + n.sum() == total > 800 and 0 < n[y == 1].sum() < found
    assert models[0]["threshold"] == models[1]["threshold"] and (models[0]["params"]["conv"] == models[1]["params"]["conv"]).all()
    spans = secrets.scan(docs, models[0])
    assert spans.where("n_assign = 1 and n_hex = 1").count() == 400 and spans.where("spans like '%model%'").count() < 20


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    rng = random.Random(9)
    rows = []
    for k in range(900):
        words = [f"word{rng.randrange(300)}" for _ in range(rng.choice([10, 80]))]
        if k % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(["vile", "scum", "idiot"])
        rows.append((k, " ".join(words), int(k % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.where("doc_id < 700").select("doc_id", "toxic")
    learnt, counted = watched(monkeypatch)
    models = [toxicity.fit(docs.drop("toxic").repartition(parts), labels, max_rows=150, start_rows=150) for parts in (1, 5)]
    assert learnt[0] + counted[0][2].sum() == 700 and counted[0][2].sum() > 100
    assert all((models[0]["params"][k] == models[1]["params"][k]).all() for k in models[0]["params"])
    assert (models[0]["calibration"] == models[1]["calibration"]).all()
    got = toxicity.predict(docs, models[0], threshold=0.5, keep=("toxic",)).where("doc_id >= 700")
    assert got.where("predicted = toxic").count() > 170  # 133 without a model
