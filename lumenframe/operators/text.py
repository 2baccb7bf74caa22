"""Tokens, term weights and keyword scores in long form (doc, term, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import lookup


def token_array(text: Column, min_length: int = 3) -> Column:
    """Lower-case words of letters only, of at least ``min_length``.

    A word is cut at blanks and punctuation but for apostrophes, hyphens and underscores
    within it; one that holds anything else than letters is dropped whole.
    """
    # One pattern takes both kinds of words, the kept ones as its group; the others leave it empty.
    kept = rf"([a-z\p{{L}}]{{{min_length},}}+)(?![\p{{L}}\p{{N}}]|['’_-]+[\p{{L}}\p{{N}}])"
    other = r"[a-z\p{L}\p{N}]++(?:['’_-]+[a-z\p{L}\p{N}]+)*+"
    return F.array_remove(F.regexp_extract_all(F.lower(text), F.lit(f"{kept}|{other}"), F.lit(1)), "")


def each_term(words: DataFrame, *keep: str | Column) -> DataFrame:
    """One row per element of ``_w``.

    A plain explode would make the planner test the array for emptiness first and run
    the token pattern over every text twice.
    """
    return words.select(*keep, F.explode_outer("_w").alias("term")).where(F.col("term").isNotNull())


def tokens(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return each_term(docs.select(key, token_array(F.col(text)).alias("_w")), key)


def without_stop_words(toks: DataFrame, stop: DataFrame, known_rows: int | None = None) -> DataFrame:
    return lookup(toks, stop.select("term").distinct(), ["term"], "left_anti", known_rows=known_rows)


def lemmatised(toks: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace each token by its lemma; tokens outside the table stay as they are."""
    joined = lookup(toks, lemmas.select("term", "lemma"), ["term"], "left")
    return joined.withColumn("term", F.coalesce("lemma", "term")).drop("lemma")


def bag_of_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, doc_terms, term, tf); ``doc_terms`` counts every kept token of the text."""
    return term_counts(docs.select(key, token_array(F.col(text)).alias("_w")), key)


def term_counts(words: DataFrame, key: str) -> DataFrame:
    """(key, doc_terms, term, tf) of rows (key, _w), counted within each row: no shuffle.

    The words of a text are sorted; a term's count is how far the next one starts.
    """
    rows = words.select(key, F.sort_array("_w").alias("_w"))
    starts = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1)))
    rows = rows.where(F.size("_w") > 0).select(key, "_w", starts.alias("_from"))
    counted = F.transform("_from", lambda i, k: F.struct(
        F.get("_w", i).alias("term"), (F.coalesce(F.get("_from", k + 1), F.size("_w")) - i).cast("bigint").alias("tf")
    ))
    each = rows.select(key, F.size("_w").alias("doc_terms"), F.explode(counted).alias("_t"))
    return each.select(key, "doc_terms", "_t.term", "_t.tf")


def count_terms(toks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The same from a token table (after stop words and lemmas were applied)."""
    tf = toks.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    # One window partition is the distinct terms of one text.
    return tf.withColumn("doc_terms", F.sum("tf").over(Window.partitionBy(key)).cast("int"))


def document_frequency(bag: DataFrame) -> DataFrame:
    return bag.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def top_terms(df: DataFrame, n_terms: int) -> DataFrame:
    """Terms of highest document frequency; ties by term."""
    return df.orderBy(F.desc("df"), "term").limit(n_terms)


def vocabulary(bag: DataFrame, n_docs: Column, n_terms: int = 5000) -> DataFrame:
    """(term, term_id, df, idf) of the top terms; at most ``n_terms`` rows."""
    kept = top_terms(document_frequency(bag), n_terms)
    # The window runs over the limited vocabulary only.
    ids = F.row_number().over(Window.orderBy(F.desc("df"), "term")) - 1
    return kept.select("term", ids.alias("term_id"), "df", F.log(n_docs / F.col("df")).alias("idf"))


def row_total(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.select(F.lit(1).alias("_one")).agg(F.count(F.lit(1))).scalar()


def weigh(bag: DataFrame, vocab: DataFrame) -> DataFrame:
    """tf-idf: idf * tf / all tokens of the text.  The vocabulary is a limited top list."""
    return bag.join(F.broadcast(vocab), "term").withColumn(
        "weight", F.col("idf") * F.col("tf") / F.col("doc_terms")
    )


def query_weights(vocab: DataFrame, words: list[str]) -> DataFrame:
    """idf weight of each query word; unknown words drop out."""
    return vocab.where(F.col("term").isin([w.lower() for w in words])).select("term", "term_id", "idf")


def score_documents(weights: DataFrame, query: DataFrame, key: str = "doc_id") -> DataFrame:
    """Dot product of one query with every document that shares a term with it."""
    q = F.broadcast(query.select("term", F.col("idf").alias("_q")))  # rows of a word list
    return weights.join(q, "term").groupBy(key).agg(F.sum(F.col("weight") * F.col("_q")).alias("score"))
