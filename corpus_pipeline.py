"""The training-corpus pipeline: toxicity, near duplicates, decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  All but the last return the columns of ``documents``; the last
returns one row per packed piece.  ``run`` writes each stage's rows to the
shared scratch folder and reads them back, so a lost executor costs at most the
tasks of one stage.

In every stage NULL and empty texts are empty documents: they are not toxic, are
like no other document, hold no benchmark words and no secret, and are packed
as their end id.  Rows without an id are kept.  Repeated rows are judged alike,
and of rows that are like each other one stays, the least id first, then the
least digest.  Texts of any length are read whole; an empty table stays empty;
further columns stay until the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.llm import decontaminate, jaccard, packing, secrets, tokens, toxicity
from kempt.llm.common import documents, held_out, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores under 0.7; it learns from the labelled rows whose crc32 remainder is not 1."""
    labels = documents(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id", 3, 1))
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones (Jaccard 0.8 on 5-word shingles): the least id."""
    return jaccard.keep_representatives(docs, width=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in passages of the benchmark."""
    return decontaminate.keep_clean(docs, documents(spark, sf_dir, "benchmark"), window=13, share=20)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and ``n_chars`` counted anew."""
    clean = secrets.redact(docs, secrets.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in its sequence of at most 2048."""
    return packing.pack(docs, tokenizer=tokens.default_tokenizer(), end_id=1, capacity=2048)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("secret_scans", redact_secrets), ("packing", pack_sequences)]

#: The models and the tokenizer have no SQL form; tests/llm/test_pipeline.py compares every stage and run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the snapshot's documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
