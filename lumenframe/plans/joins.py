"""Lookups and pairwise values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import daily as D
from ..operators import joins as J
from ..operators import text as X
from ..operators.ordering import top_per_group
from ..runtime import cut_lineage, spread_table, table
from .registry import query

TOKENS = r"""
tok as (select doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+(?:[''’_-]+[\p{L}\p{N}]+)*'), lambda w: regexp_full_match(w, '\p{L}{3,}'))) as term from documents),
bag as (select doc_id, term, count(*) as tf from tok group by 1, 2),
totals as (select doc_id, sum(tf) as doc_terms from bag group by 1),
freq as (select term, count(*) as df from bag group by 1),
vocab as (select term, df, ln((select count(*) from documents) / df::double) as idf,
                 (row_number() over (order by df desc, term) - 1)::int as term_id
          from freq order by df desc, term limit 5000),
weights as (select doc_id, term, term_id, tf, df, idf, idf * tf / doc_terms as weight
            from bag join totals using (doc_id) join vocab using (term))
"""


def corpus(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id")
    bag = X.bag_of_words(docs)
    return docs, bag, X.vocabulary(bag, X.row_total(docs))


@query(
    "lookup_join",
    """with t as (select lang, doc_id, row_number() over (partition by lang order by n_chars desc, doc_id)::int as rank from documents)
       select t.lang, t.rank, doc_id, d.source as genre from t join documents d using (doc_id) where rank <= 25""",
)
def lookup_join(spark, sf):
    docs = table(spark, sf, "documents")
    tops = top_per_group(docs.select("lang", "doc_id", "n_chars"), ["lang"], [F.desc("n_chars"), F.col("doc_id")], 25)
    genres = docs.select("doc_id", F.col("source").alias("genre"))
    # A top list: 25 rows per language.
    return genres.join(F.broadcast(tops), "doc_id").select("lang", "rank", "doc_id", "genre")


@query(
    "broadcast_map_join",
    f"with {TOKENS} select doc_id, count(*) as known, round(sum(idf * tf), 4) as idf_mass from weights group by 1",
)
def broadcast_map_join(spark, sf):
    _, bag, vocab = corpus(spark, sf)
    return X.weigh(bag, vocab).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("known"), F.round(F.sum(F.col("idf") * F.col("tf")), 4).alias("idf_mass")
    )


@query(
    "stopword_anti_join",
    f"""with {TOKENS}, stop as (select term from freq order by df desc, term limit 100)
        select doc_id, count(*) as kept, count(distinct term) as terms from tok
        where term not in (select term from stop) group by 1""",
)
def stopword_anti_join(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id")
    stop = X.top_terms(X.document_frequency(X.bag_of_words(docs)), 100)
    counted = X.count_terms(X.without_stop_words(X.tokens(docs), stop, 100))
    return counted.groupBy("doc_id").agg(F.sum("tf").alias("kept"), F.count(F.lit(1)).alias("terms"))


@query(
    "lemma_lookup_join",
    f"""with {TOKENS}, lemmas as (select f.term, g.term as lemma from freq f join freq g on f.term = g.term || 's')
        select doc_id, count(*) as n, count(distinct coalesce(lemma, term)) as lemmas
        from tok left join lemmas using (term) group by 1""",
)
def lemma_lookup_join(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id")
    terms = X.tokens(docs).select("term").distinct()
    plural = terms.select(F.concat("term", F.lit("s")).alias("term"), F.col("term").alias("lemma"))
    lemmas = cut_lineage(plural.join(terms, "term", "left_semi"))  # counted, then joined
    toks = X.lemmatised(X.tokens(docs), lemmas)
    return X.count_terms(toks).groupBy("doc_id").agg(
        F.sum("tf").alias("n"), F.count(F.lit(1)).alias("lemmas")
    )


@query(
    "positional_attach",
    """with d as (select cast(o_orderdate as date) as t, sum(o_totalprice) as y from orders group by 1),
       c as (select t, y, lag(y) over (order by t) as prev, row_number() over (order by t) as i from d)
       select a.t as date, round(100 * (b.y / b.prev - 1), 4) as y, a.i - 1 as position
       from c a join c b on b.i = a.i + 1""",
    text=("date",),
)
def positional_attach(spark, sf):
    daily = D.daily_series(
        table(spark, sf, "orders"), F.lit("all"), F.col("o_orderdate"), y=F.sum("o_totalprice")
    )
    dates = daily.select(F.col("t").alias("date"))
    changes = D.pct_change(daily, "y", "change").select("t", F.round("change", 4).alias("y"))
    # The shorter differenced series takes the dates of the earlier days, by position.
    return J.positional_attach(dates, changes, "date", "t").drop("t")


def molecules(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    return vectors.select("vec_id", V.reshape(F.col("e"), 4, 16).alias("atoms"))


ATOMS = """
atoms as (select vec_id, i, embedding[i * 16 + 1 : i * 16 + 16]::double[] as p
          from embeddings, (select unnest([0, 1, 2, 3])::int as i)),
pairs as (select a.vec_id, a.i, b.i as j, 1 / list_distance(a.p, b.p) as inverse
          from atoms a join atoms b on a.vec_id = b.vec_id and a.i < b.i)
"""


@query("pair_self_join", f"with {ATOMS} select vec_id, i, j, round(inverse, 6) as inverse from pairs")
def pair_self_join(spark, sf):
    pairs = J.record_pairs(molecules(spark, sf), "vec_id", F.col("atoms"))
    return pairs.withColumn("inverse", F.round("inverse", 6))


@query(
    "inverse_distance_descriptor",
    f"""with {ATOMS} select vec_id, (row_number() over (partition by vec_id order by i, j) - 1)::int as pos, round(inverse, 6) as value from pairs""",
)
def inverse_distance_descriptor(spark, sf):
    found = J.inverse_distance_descriptor(molecules(spark, sf), "vec_id", F.col("atoms"))
    each = found.select("vec_id", F.posexplode("descriptor").alias("pos", "value"))
    return each.withColumn("value", F.round("value", 6))


@query(
    "kernel_pairs",
    """with e as (select vec_id, embedding::double[] as x from embeddings),
       marks as (select vec_id as landmark, x as l from e order by md5(cast(vec_id as varchar)), vec_id limit 16),
       d as (select vec_id, landmark, list_dot_product(x, l) as xy, list_distance(x, l) as gap from e, marks)
       select vec_id, landmark, round(xy, 6) as linear, round(pow(1 + 0.5 * xy, 2), 6) as poly,
              round(exp(-0.5 * gap * gap), 6) as rbf, round(tanh(0.5 * xy + 1), 6) as sigmoid from d""",
)
def kernel_pairs(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    values = J.kernel_values(rows, "vec_id", "x", J.pick_landmarks(rows, "vec_id", "x", 16), 0.5, 1.0, 2)
    return values.select(
        "vec_id", "landmark", *[F.round(c, 6).alias(c) for c in ("linear", "poly", "rbf", "sigmoid")]
    )


WORDS = ["the", "with", "que", "und", "para"]
WORD_LIST = ", ".join(f"'{w}'" for w in WORDS)


@query(
    "query_doc_score",
    f"""with {TOKENS} select doc_id, round(sum(weight * idf), 8) as score from weights
        where term in ({WORD_LIST}) group by 1""",
)
def query_doc_score(spark, sf):
    _, bag, vocab = corpus(spark, sf)
    scores = X.score_documents(X.weigh(bag, vocab), X.query_weights(vocab, WORDS))
    return scores.withColumn("score", F.round("score", 8))
