"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations only.

The index stores a posting (document row, position, term) for every occurrence
of a test term in the corpus; other terms can be in no match.  Terms are
ranked by their list lengths.  Of each 13-word window the rarest term's list
is taken first: a posting at ``pos`` of a term at ``item_pos`` can only belong
to a match on the diagonal ``pos - item_pos``.  The lists of all other terms
of the item, adjusted by their offsets, are then intersected on these
diagonals, and a run of at least 13 consecutive hits is a match of every
window in it.

Words: A-Z lower-cased, maximal runs of ``[0-9a-z]`` and non-ASCII characters.
A NULL or empty text has no words; an item of fewer words than the window is
one window; repeated rows are documents (or items) of their own.  Of equally
rare terms the first in the window leads.  Texts of any length are read whole;
without documents there are no rows, without items no hits; further columns,
whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm import common

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Ends each document's words; it can be no word.
_END = "\x01"
#: Rows up to which the terms, anchors and candidate rows are broadcast; more are joined by shuffles.
BROADCAST_ROWS = 500_000


def _small(df: DataFrame) -> DataFrame:
    """A broadcast hint for a written table of proven size."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def words(text: Column) -> Column:
    """The words of a text, cased as they are."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BETWEEN), lambda w: w != "")


def lower_az(word: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return (F.when(F.octet_length(word) == F.char_length(word), F.lower(word))
            .otherwise(F.translate(word, _UPPER, _UPPER.lower())))


def test_tokens(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, item_pos, n_item, word) of every test word; ``item`` numbers the rows."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
                        words(F.col(text_col)).alias("w"))
    rows = rows.select("item", "item_id", F.size("w").alias("n_item"), F.posexplode("w").alias("item_pos", "word"))
    return common.materialise(rows.withColumn("word", lower_az(F.col("word"))), "test-tokens")


def build_index(docs: DataFrame, tokens: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, postings, terms): (row, doc_id, n_words), (row, pos, term) and (term, word, df)."""
    vocabulary = (tokens.select("word").distinct().withColumn("term", F.row_number().over(Window.orderBy("word")))
                  .unionByName(docs.sparkSession.range(0, 1, 1, 1).select(F.lit(_END).alias("word"), F.lit(0).alias("term"))))
    vocabulary = common.materialise(vocabulary, "vocabulary")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.array_append(words(F.col(text_col)), F.lit(_END)).alias("w"))
    rows = rows.select("row", "doc_id", F.posexplode("w").alias("pos", "word"))
    found = (rows.withColumn("word", lower_az(F.col("word"))).join(_small(vocabulary), "word")
             .select("row", "pos", "term", F.when(F.col("term") == 0, F.col("doc_id")).alias("doc_id")))
    index = common.materialise(found, "postings")
    documents = index.where("term = 0").select("row", "doc_id", F.col("pos").alias("n_words"))
    postings = index.where("term > 0").select("row", "pos", "term")
    frequency = postings.groupBy("term").agg(F.count("*").alias("df"))
    terms = common.materialise(vocabulary.join(frequency, "term"), "terms", few=True)
    return documents, postings, terms


def phrase_hits(postings: DataFrame, terms: DataFrame, tokens: DataFrame, window: int = 13) -> DataFrame:
    """(row, pos, item) of every document word inside an occurrence of an item's window."""
    ranked = tokens.join(terms, "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    ahead = Window.partitionBy("item").orderBy("item_pos").rowsBetween(0, window - 1)
    anchors = (ranked.withColumn("rarest", F.min(F.struct("df", "item_pos", "term")).over(ahead))
               .where(F.col("item_pos") <= F.greatest(F.col("n_item") - window, F.lit(0)))
               .where("rarest.df > 0").select("item", "rarest.item_pos", "rarest.term").distinct())
    anchors = common.materialise(anchors, "anchors", few=True)
    diagonals = (postings.join(_small(anchors), "term")
                 .select("row", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct())
    diagonals = common.materialise(diagonals, "diagonals")
    candidates = common.materialise(diagonals.select("row").distinct(), "candidate-rows", few=True)

    # every other list of the item, adjusted by its offset, on these diagonals
    wanted = (diagonals.join(_small(ranked.where("df > 0").select("item", "item_pos", "n_item", "term")), "item")
              .withColumn("pos", F.col("diagonal") + F.col("item_pos")).where("pos >= 0"))
    own = postings.join(_small(candidates), "row", "left_semi")
    met = wanted.join(own, ["row", "pos", "term"])
    along = Window.partitionBy("row", "item", "diagonal")
    runs = met.withColumn("run", F.col("item_pos") - F.row_number().over(along.orderBy("item_pos")))
    long_enough = F.count("*").over(Window.partitionBy("row", "item", "diagonal", "run"))
    return (runs.withColumn("length", long_enough).where(F.col("length") >= F.least(F.col("n_item"), F.lit(window)))
            .select("row", "pos", "item"))


def proximity_matches(postings: DataFrame, terms: DataFrame, left: str, right: str, slop: int) -> DataFrame:
    """(row, left_pos, right_pos) wherever two words stand at most ``slop`` positions apart.

    Positions are dealt to cells of ``slop + 1``, so each posting meets three
    cells of its own document and never a whole list.
    """
    width = slop + 1

    def listed(word: str, name: str) -> DataFrame:
        return (postings.join(F.broadcast(terms.where(F.col("word") == word).limit(1)), "term")  # one row
                .select("row", F.col("pos").alias(name), F.expr(f"pos div {width}").alias("cell")))

    near = listed(right, "right_pos").withColumn("cell", F.explode(F.expr("array(cell - 1, cell, cell + 1)")))
    return (listed(left, "left_pos").join(near, ["row", "cell"])
            .where(F.abs(F.col("left_pos") - F.col("right_pos")) <= slop).select("row", "left_pos", "right_pos"))


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = 13, share: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (hit words at least 1/share)."""
    tokens = test_tokens(items, item_id, item_text)
    documents, postings, terms = build_index(docs, tokens, id_col, text_col)
    hits = common.materialise(phrase_hits(postings, terms, tokens, window), "hits")
    names = tokens.select("item", "item_id").distinct()
    n_hit = hits.select("row", "pos").distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    of_items = (hits.select("row", "item").distinct().join(_small(names), "item")
                .select("row", F.col("item_id").cast("string").alias("item_id")).distinct()
                .groupBy("row").agg(F.count("*").alias("n_items"),  # at most the benchmark's items
                                    F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("names")))
    found = documents.join(n_hit, "row", "left").join(of_items, "row", "left")
    n_hit, n_words = F.coalesce("n_hit", F.lit(0)), F.col("n_words").cast("long")
    return found.select(F.col("doc_id").alias(id_col), n_words.alias("n_words"), n_hit.alias("n_hit"),
                        F.coalesce("n_items", F.lit(0)).alias("n_items"),
                        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
                        ((n_hit > 0) & (share * n_hit >= n_words)).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated; rows without an id are kept.

    A row is judged by its own text, so ids may repeat; NULL and empty texts
    have no words and stay.
    """
    digest = F.struct(F.xxhash64(text_col).alias("a"), F.xxhash64(F.lit(1), text_col).alias("b"))  # 128 bits stand for a text
    texts = docs.select(digest.alias("_digest"), F.col(text_col).alias("_text"))
    found = contamination(texts, items, id_col="_digest", text_col="_text", **options).where("contaminated")
    found = common.materialise(found.select("_digest").distinct(), "contaminated", few=True)
    return docs.join(_small(found), (digest == F.col("_digest")) & F.col(id_col).isNotNull(), "left_anti").select(docs.columns)
