"""Extra columns with the operators' own names, NULLs, ties, long texts and empty tables."""

import pytest
from pyspark.sql import functions as F

from kempt.llm import decontaminate, language, packing, quality, secrets, token_files, tokens, toxicity, url_filters

CLASHES = ["id", "text_", "row", "term", "pos", "start", "length", "k", "part", "score", "predicted", "_text", "_label", "spans", "label", "n", "held_out", "base",
           "symbols", "found", "lang_pred", "n_words", "sequence_id", "offset", "host", "pattern", "valid_from", "list", "active"]
ROWS = [(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "no id here"), (4, "long " * 60_000), (5, "é ½ 日本")]


@pytest.fixture(params=["plain", "clashing"])
def docs(spark, request):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("lang", F.lit("aa"))
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if request.param == "clashing" else df


OPERATORS = {
    "packing": lambda d, spark: packing.pack(d, tokenizer=tokens.default_tokenizer(), end_id=1).select("doc_id").distinct(),
    "decontaminate": lambda d, spark: decontaminate.contamination(d, spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")),
    "quality": lambda d, spark: quality.predict(quality.statistics_table(d), {"share": 0.5}),
    "secrets": lambda d, spark: secrets.scan(d, None),
    "toxicity": lambda d, spark: toxicity.predict(d, None),
    "language": lambda d, spark: language.predict(d, language.fit(d)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_rows_and_empty_tables(spark, docs, name):
    want = sorted({i for i, _ in ROWS} if name == "packing" else [i for i, _ in ROWS], key=str)
    assert sorted([r[0] for r in OPERATORS[name](docs, spark).select("doc_id").collect()], key=str) == want
    assert OPERATORS[name](docs.limit(0), spark).count() == 0


def test_token_files(spark, docs, scratch):
    token_files.write_token_files(docs, f"{scratch}/files", tokenizer=tokens.default_tokenizer(), end_id=2)
    assert sorted([r.id for r in token_files.read_token_files(spark, f"{scratch}/files").collect()], key=str) == sorted([i for i, _ in ROWS], key=str)
    token_files.write_token_files(docs.limit(0), f"{scratch}/none", tokenizer=tokens.default_tokenizer(), end_id=2)
    assert token_files.read_token_files(spark, f"{scratch}/none").count() == 0


def test_url_filters(spark):
    rows = [(1, "http://a.example.com/x", 3), (1, "http://a.example.com/x", 3), (2, None, 3), (None, "http://b.example.com", None)]
    captures = spark.createDataFrame(rows, "page_id long, url string, day int").withColumns({c: F.lit("clash") for c in CLASHES})
    events = spark.createDataFrame([("l", "example.com", 1, "add")], "list string, pattern string, day int, action string").withColumn("active", F.lit(1))
    assert sorted([(r.page_id, r.blocked) for r in url_filters.evaluate(captures, events).collect()], key=str) == [(1, True), (1, True), (2, False), (None, False)]


def test_conflicting_labels_and_texts_of_one_id_give_one_model(spark):
    rows = [(k, f"word{k} " * 12 + ("vile " * 8 if k % 3 == 0 else "")) for k in range(60)] + [(3, "another text of id three"), (3, "vile " * 30)]
    labels = [(k, int(k % 3 == 0)) for k in range(60)] + [(6, 0), (7, 1)]
    models = []
    for parts in (1, 7):
        d = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        models.append(toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int").repartition(parts), min_steps=3, epochs=1))
    assert (models[0]["params"]["out"] == models[1]["params"]["out"]).all() and (models[0]["calibration"] == models[1]["calibration"]).all()
