"""Sort, limit, best row, append."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as X
from ..operators.ordering import best_row
from ..runtime import spread_table, table
from .joins import TOKENS
from .registry import query


@query("top_terms", f"with {TOKENS} select term, df from vocab")
def top_terms(spark, sf):
    bag = X.bag_of_words(spread_table(spark, sf, "documents", "doc_id"))
    return X.top_terms(X.document_frequency(bag), 5000)


@query(
    "order_results",
    """select p_type as model, round(regr_r2(p_retailprice, p_size), 8) as r2 from part group by 1 order by r2""",
)
def order_results(spark, sf):
    part = table(spark, sf, "part")
    return part.groupBy(F.col("p_type").alias("model")).agg(
        F.round(F.regr_r2("p_retailprice", "p_size"), 8).alias("r2")
    ).orderBy("r2", "model")


@query("head_rows", "select * from orders order by o_orderkey limit 10", text=("o_orderdate",))
def head_rows(spark, sf):
    return table(spark, sf, "orders").orderBy("o_orderkey").limit(10)


@query(
    "argmin_row",
    """select p_type, arg_min(p_partkey, (p_retailprice, p_partkey)) as p_partkey, min(p_retailprice) as p_retailprice
       from part group by 1""",
)
def argmin_row(spark, sf):
    score = F.struct("p_retailprice", "p_partkey")
    return best_row(table(spark, sf, "part"), ["p_partkey", "p_retailprice"], score, ["p_type"])


@query(
    "union_rows",
    """select c_nationkey as nation, c_acctbal as balance, 'customer' as side from customer
       union all select s_nationkey, s_acctbal, 'supplier' from supplier""",
)
def union_rows(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("side")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("side"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")
    )
    return customers.unionByName(suppliers)
