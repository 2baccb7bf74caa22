"""Term weights, latent semantic index, text scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import sources as S
from ..operators import lsa as L
from ..operators import ordinal
from ..operators import text as X
from ..operators.classify import fitted, text_classifier
from ..operators.features import with_split
from ..runtime import fresh_path, spread_table, table
from .joins import TOKENS, WORD_LIST, WORDS, corpus
from .registry import query


@query(
    "tokenize_filter",
    f"""with {TOKENS}, stop as (select term from freq order by df desc, term limit 50)
        select doc_id, term, count(*) as tf from tok where term not in (select term from stop) group by 1, 2""",
)
def tokenize_filter(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id")
    stop = X.top_terms(X.document_frequency(X.bag_of_words(docs)), 50)
    return X.count_terms(X.without_stop_words(X.tokens(docs), stop, 50)).drop("doc_terms")


@query("term_frequency", f"with {TOKENS} select doc_id, term, tf, doc_terms::int as doc_terms from bag join totals using (doc_id)")
def term_frequency(spark, sf):
    return X.bag_of_words(spread_table(spark, sf, "documents", "doc_id"))


@query("document_frequency", f"with {TOKENS} select term, df from freq")
def document_frequency(spark, sf):
    return X.document_frequency(X.bag_of_words(spread_table(spark, sf, "documents", "doc_id")))


@query("idf", f"with {TOKENS} select term, term_id, df, round(idf, 8) + 0.0 as idf from vocab")
def idf(spark, sf):
    _, _, vocab = corpus(spark, sf)
    return vocab.withColumn("idf", F.round("idf", 8) + 0.0)


@query("tfidf", f"with {TOKENS} select doc_id, term, tf, df, round(weight, 10) + 0.0 as weight from weights")
def tfidf(spark, sf):
    _, bag, vocab = corpus(spark, sf)
    return X.weigh(bag, vocab).select("doc_id", "term", "tf", "df", (F.round("weight", 10) + 0.0).alias("weight"))


@query("query_vector", f"with {TOKENS} select term, term_id, round(idf, 8) + 0.0 as idf from vocab where term in ({WORD_LIST})")
def query_vector(spark, sf):
    _, _, vocab = corpus(spark, sf)
    return X.query_weights(vocab, [*WORDS, "zzzunknown"]).withColumn("idf", F.round("idf", 8) + 0.0)


# Stop words of the index, and words searched for.
STOP = [
    "the", "and", "that", "was", "for", "this", "with", "are", "from", "des", "les", "une", "est", "pour", "que", "und", "der",
    "die", "das", "los", "las", "por", "para", "con", "del", "una",
]
SOUGHT = ["tion", "thing", "ment", "keit", "than"]


_INDEXES: dict[tuple[str, str], L.SemanticIndex] = {}


def semantic_index(spark, sf):
    """The index of a folder's documents: fitted once per application, its tables in the shared folder."""
    key = spark.sparkContext.applicationId, sf
    if key not in _INDEXES:
        _INDEXES[key] = L.fit(L.word_table(spread_table(spark, sf, "documents", "doc_id"), stop=STOP), n_terms=5000, k=25)
    return _INDEXES[key]


@query("lsa_fit")
def lsa_fit(spark, sf):
    index = semantic_index(spark, sf)
    energy = L._long(index.scaled_documents(), ["doc_id"], "us").groupBy("concept").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("document_norm")
    )
    return index.singular_values().join(energy, "concept")


@query("scale_rows_by_singular")
def scale_rows_by_singular(spark, sf):
    return semantic_index(spark, sf).scaled_documents()


@query("top_terms_per_concept")
def top_terms_per_concept(spark, sf):
    return L.top_terms_per_concept(semantic_index(spark, sf), 25)


@query("top_docs_per_concept")
def top_docs_per_concept(spark, sf):
    return L.top_docs_per_concept(semantic_index(spark, sf), 25)


@query("top_genres_per_concept")
def top_genres_per_concept(spark, sf):
    return L.top_genres_per_concept(semantic_index(spark, sf), table(spark, sf, "documents"), "source")


@query("semantic_search")
def semantic_search(spark, sf):
    return L.search(semantic_index(spark, sf), SOUGHT, 25)


def report(spark, sf):
    docs = table(spark, sf, "documents").withColumn("title", F.concat_ws(" :", "source", "doc_id"))
    return L.concept_report(semantic_index(spark, sf), docs, "title", "source")


@query("concept_report")
def concept_report(spark, sf):
    return report(spark, sf)


@query("write_report")
def write_report(spark, sf):
    rows = report(spark, sf)
    path = S.write_lines(rows, L.report_lines(rows), fresh_path(spark, "report"))
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("line"))


@query("text_scorer")
def text_scorer(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id").select("doc_id", "text")
    labelled = docs.join(table(spark, sf, "labels"), "doc_id").withColumn("label", F.col("quality").cast("double"))
    train = with_split(labelled, "doc_id", 0.8).where("part = 'train'")
    model = fitted(text_classifier(n_features=1 << 14), train.withColumn("words", X.token_array(F.col("text"))))
    scored = model.transform(docs.withColumn("words", X.token_array(F.col("text"))))
    return scored.select(
        "doc_id",
        (F.col("prediction").cast("int") + 1).alias("score"),
        F.get(vector_to_array("probability"), F.lit(1)).alias("probability"),
    )


@query("ordered_text_scores")
def ordered_text_scores(spark, sf):
    """One of four ordered scores for every text: low quality or high, toxic or not within each."""
    docs = spread_table(spark, sf, "documents", "doc_id").select("doc_id", X.token_array(F.col("text")).alias("words"))
    level = 1 + 2 * F.max("quality") + F.when(F.max("toxic") == 1, 0).otherwise(1)
    labels = table(spark, sf, "labels").groupBy("doc_id").agg(level.alias("level"))
    train = with_split(docs.join(labels, "doc_id"), "doc_id", 0.8).where("part = 'train'")
    model = ordinal.fit(train, "words", "level")
    return ordinal.score(docs, model, "words", ["doc_id"])
