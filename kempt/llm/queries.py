"""The ``opN_<name>`` queries: each operator over its whole table, digested to the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.llm import (alignment, conversations, decontaminate, edit_fingerprints, jaccard, language, packing, quality, secrets,
                       token_files, tokens, top_k, toxicity, url_filters)
from kempt.llm.common import documents, held_out, materialise
from kempt.session import scratch_path


def op1_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with the likeness to that and to the next document's."""
    return edit_fingerprints.with_successors(documents(spark, sf_dir))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and the least document reachable over links of Jaccard 0.8 on 5-word shingles."""
    return jaccard.near_duplicates(documents(spark, sf_dir), width=5, num=80, den=100)


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence of at most 2048 ids."""
    return packing.pack(documents(spark, sf_dir), tokenizer=tokens.default_tokenizer(), end_id=1, capacity=2048)


def op4_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the folds whose crc32 remainder is not 1."""
    table = materialise(quality.statistics_table(documents(spark, sf_dir)), "statistics")
    labels = documents(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out("doc_id", 3, 1))
    scored = quality.predict(table, quality.fit(table.join(labels, "doc_id")))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list events of the hosts in ``pages`` and of their parent domains, dated by each name's least page id."""
    hosts = pages.select(url_filters.host(F.col("url")).alias("pattern"), "page_id").where("pattern is not null")
    parents = hosts.where("size(split(pattern, '[.]')) >= 4").select(F.expr("substring(pattern, locate('.', pattern) + 1)").alias("pattern"), "page_id")
    first = lambda df: df.groupBy("pattern").agg(F.min("page_id").alias("m"))
    host_log = first(hosts).select(F.lit("hosts").alias("list"), "pattern", F.expr(
        "explode(array(struct((m * 31) % 365 AS day, 'add' AS action), struct((m * 31) % 365 + 20 + m % 60 AS day, 'remove' AS action)))").alias("e"))
    domain_log = first(parents).select(F.lit("domains").alias("list"), "pattern", F.expr(
        "explode(array(struct((m * 17) % 365 AS day, 'add' AS action), struct((m * 17) % 365 + 45 AS day, 'remove' AS action)))").alias("e"))
    return host_log.unionByName(domain_log).select("list", "pattern", "e.day", "e.action")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the dated host and domain lists as of its fetch day (derived from its id)."""
    pages = documents(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", ((F.col("page_id") * 7919) % 365).alias("day"))
    return url_filters.evaluate(captures, list_events(pages))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base findings and the network's further spans of every document."""
    docs = documents(spark, sf_dir)
    return secrets.scan(docs, secrets.fit(docs))


def fit_toxicity(spark: SparkSession, sf_dir: str) -> dict | None:
    """The toxicity model of a snapshot: labels of rows whose crc32 remainder is not 1."""
    labels = documents(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id", 3, 1))
    return toxicity.fit(documents(spark, sf_dir), labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the folds whose crc32 remainder is not 1."""
    scored = toxicity.predict(documents(spark, sf_dir), fit_toxicity(spark, sf_dir), threshold=0.7)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document for 13-word windows."""
    return decontaminate.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), window=13, share=20)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents and reads every document back from them."""
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), folder, tokenizer=tokens.default_tokenizer(), end_id=2)
    return token_files.read_token_files(spark, folder).withColumnRenamed("id", "doc_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the folds whose crc32 remainder is not 2."""
    docs = documents(spark, sf_dir).withColumn("held_out", held_out("doc_id", 4, 2))
    model = language.fit(docs.where(~F.col("held_out")))
    return (language.predict(docs, model)
            .select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every vector whose id is divisible by 100, against all other vectors."""
    return top_k.top_k(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document, the links weighed by how many documents hold their pair."""
    aligned = alignment.align(documents(spark, sf_dir), path_a=tokens.public_path("byte_bpe_50k.json"),
                              path_b=tokens.public_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    aligned = materialise(aligned.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256"), "aligned")
    return (aligned.drop("pairs", "times").join(alignment.link_scores(aligned), "rid")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after the stated damage, its cheapest repair and the digest of the repaired rows."""
    damaged = conversations.damage(documents(spark, sf_dir, "conversations"))
    return conversations.report(conversations.repair(damaged, gone_col="gone", times_col="times"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_edit_fingerprints, op2_ngram_jaccard_join, op3_harmonic_packing, op4_quality_discriminant,
                            op5_url_filters, op6_secret_scan, op7_toxicity, op8_benchmark_decontamination, op9_token_files,
                            op10_language_id, op11_exact_top_k, op12_tokenizer_alignment, op13_conversation_repair)
}

#: The words, windows and hits of op8, window by window.
_OP8 = """
WITH lowered AS (SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
     items AS (SELECT item_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
     windows AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
         FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
               FROM items WHERE len(w) > 0)),
     lengths AS (SELECT DISTINCT k FROM windows),
     spots AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS phrase
         FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM lowered, lengths)),
     met AS (SELECT r, s, k, item_id FROM spots JOIN windows USING (k, phrase)),
     hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM met) GROUP BY r),
     names AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
         FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM met) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM lowered LEFT JOIN hits USING (r) LEFT JOIN names USING (r)"""

#: The state of a name on a day is that of its last event up to then.
_OP5 = """
WITH captures AS (SELECT row_number() OVER () AS r, page_id, (page_id * 7919) % 365 AS day,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host FROM pages),
     named AS (SELECT host AS pattern, min(page_id) AS m FROM captures WHERE host IS NOT NULL GROUP BY 1),
     parents AS (SELECT substr(host, strpos(host, '.') + 1) AS pattern, min(page_id) AS m FROM captures
         WHERE len(string_split(host, '.')) >= 4 GROUP BY 1),
     events AS (SELECT 'hosts' AS l, pattern, (m * 31) % 365 AS day, true AS listed FROM named
         UNION ALL SELECT 'hosts', pattern, (m * 31) % 365 + 20 + m % 60, false FROM named
         UNION ALL SELECT 'domains', pattern, (m * 17) % 365, true FROM parents
         UNION ALL SELECT 'domains', pattern, (m * 17) % 365 + 45, false FROM parents),
     names AS (SELECT r, day, array_to_string(labels[i:], '.') AS pattern FROM
         (SELECT r, day, string_split(host, '.') AS labels, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS i
          FROM captures WHERE host IS NOT NULL)),
     state AS (SELECT n.r, n.pattern, e.l, max_by(e.listed, e.day) AS listed, max(e.day) AS since
         FROM names n JOIN events e ON n.pattern = e.pattern AND e.day <= n.day GROUP BY ALL),
     active AS (SELECT r, count(*) AS n, max({'length': length(pattern), 'pattern': pattern, 'since': since}) AS best
         FROM state WHERE listed GROUP BY r)
SELECT page_id, host, day, coalesce(n, 0) AS n_active, best.pattern AS pattern, best.since AS valid_from,
       coalesce(n, 0) > 0 AS blocked FROM captures LEFT JOIN active USING (r)"""

#: Shingles as texts, all pairs of documents that share one, and what is reachable over the links.
_OP2 = """
WITH RECURSIVE words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     shingles AS (SELECT DISTINCT r, s FROM (SELECT r, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS s
         FROM words WHERE len(w) > 0)),
     sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
     shared AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
     links AS (SELECT x, y FROM shared JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
     steps AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
     reach AS (SELECT r AS x, r AS y FROM words UNION SELECT reach.x, steps.y FROM reach JOIN steps ON reach.y = steps.x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, min(o.doc_id) AS component_id
FROM words w JOIN reach ON reach.x = w.r JOIN words o ON o.r = reach.y LEFT JOIN sizes ON sizes.r = w.r GROUP BY w.r, w.doc_id, n"""

#: Every query against every other row.
_OP11 = """
WITH vectors AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
         FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
         FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.r <> c.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10"""

ORACLE: dict[str, str] = {"op2_ngram_jaccard_join": _OP2, "op5_url_filters": _OP5, "op8_benchmark_decontamination": _OP8, "op11_exact_top_k": _OP11}
