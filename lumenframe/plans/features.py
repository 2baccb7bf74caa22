"""Feature preparation."""

from __future__ import annotations

from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import features as X
from ..operators import profile as P
from ..runtime import spread_table, table
from .profiling import edge_sql
from .registry import query


def split_sql(key: str, seed: int = 12345) -> str:
    """The same md5 fraction in DuckDB."""
    return f"(('0x' || substring(md5('{seed}:' || cast({key} as varchar)), 1, 8))::bigint / 4294967296.0::double)"


@query("feature_hash")
def feature_hash(spark, sf):
    customer = spread_table(spark, sf, "customer", "c_custkey")
    hasher = FeatureHasher(
        inputCols=["c_nationkey", "c_acctbal", "c_mktsegment", "c_name"],
        outputCol="features",
        numFeatures=1234,
        categoricalCols=["c_nationkey"],
    )
    # The stored cells of the sparse vectors: a handful, where the whole width would be 1,234.
    hashed = hasher.transform(customer).select("c_custkey", F.unwrap_udt("features")["values"].alias("v"))
    return hashed.select(
        "c_custkey",
        F.size(F.filter("v", lambda x: x != 0)).alias("filled"),
        F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    )


@query(
    "label_index",
    """select o_orderkey, i from orders join (select o_orderpriority, (row_number() over (order by count(*) desc, o_orderpriority) - 1)::double as i
       from orders group by 1) using (o_orderpriority)""",
)
def label_index(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return X.label_index(orders, "o_orderpriority", "i").drop("o_orderpriority")


@query(
    "assemble_features",
    """select p_partkey, unnest([0, 1, 2])::int as pos, unnest([p_size::double, p_retailprice, p_partkey::double]) as value from part""",
)
def assemble_features(spark, sf):
    wide = X.assemble(table(spark, sf, "part"), ["p_size", "p_retailprice", "p_partkey"])
    return wide.select("p_partkey", F.posexplode(vector_to_array("features")).alias("pos", "value"))


BUCKETED = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]


@query(
    "quantile_buckets",
    f"with src as ({edge_sql(BUCKETED, 15, 'lineitem')}) "
    + " union all ".join(
        f"""select '{c}' as feature, {c} as bucket, count(*) as n from src group by all""" for c in BUCKETED
    ),
)
def quantile_buckets(spark, sf):
    cut = P.quantile_buckets(spread_table(spark, sf, "lineitem", "l_orderkey").select(*BUCKETED), BUCKETED, 15)
    long = cut.select(*[F.col(f"{c}_discretized").alias(c) for c in BUCKETED]).unpivot([], BUCKETED, "feature", "bucket")
    return long.groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query(
    "standardize",
    """select p_partkey, round((p_size - m) / s, 8) + 0.0 as p_size, round((p_retailprice - n) / r, 8) + 0.0 as p_retailprice
       from part, (select avg(p_size) as m, stddev_pop(p_size) as s, avg(p_retailprice) as n, stddev_pop(p_retailprice) as r from part)""",
)
def standardize(spark, sf):
    z = X.standardize(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return z.select("p_partkey", *[(F.round(c, 8) + 0.0).alias(c) for c in ("p_size", "p_retailprice")])


@query(
    "range_scale",
    f"""with s as (select *, case when {split_sql('l_orderkey')} < 0.8 then 'train' else 'test' end as part from lineitem),
        m as (select min(l_quantity) as a, max(l_quantity) as b, min(l_extendedprice) as c, max(l_extendedprice) as d from s where part = 'train')
        select l_orderkey, l_linenumber, l_partkey, part, round((l_quantity - a) / (b - a), 8) as l_quantity,
               round((l_extendedprice - c) / (d - c), 8) + 0.0 as l_extendedprice from s, m""",
)
def range_scale(spark, sf):
    rows = X.with_split(table(spark, sf, "lineitem"), "l_orderkey", 0.8)
    cols = ["l_quantity", "l_extendedprice"]
    scaled = X.range_scale(rows, cols, rows.where("part = 'train'"))
    return scaled.select(
        "l_orderkey", "l_linenumber", "l_partkey", "part", *[(F.round(c, 8) + 0.0).alias(c) for c in cols]
    )


@query(
    "treatment_coding",
    """select c_custkey, unnest([0, 1, 2, 3, 4])::int as pos, unnest([c_acctbal, (c_mktsegment = 'MACHINERY')::int::double, (c_mktsegment = 'HOUSEHOLD')::int::double,
              (c_mktsegment = 'FURNITURE')::int::double, (c_mktsegment = 'BUILDING')::int::double]) as value from customer""",
)
def treatment_coding(spark, sf):
    customer = table(spark, sf, "customer").withColumn("y", F.col("c_nationkey").cast("double"))
    coded = X.treatment_coding(customer, "y ~ c_acctbal + c_mktsegment")
    return coded.select("c_custkey", F.posexplode(vector_to_array("features")).alias("pos", "value"))


@query(
    "interaction_terms",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity * l_discount as "l_quantity:l_discount",
              case when l_quantity >= 30 then l_tax else 0.0 end as "big:l_tax" from lineitem""",
)
def interaction_terms(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("big", F.when(F.col("l_quantity") >= 30, 1).otherwise(0))
    terms = X.interactions([("l_quantity", "l_discount"), ("big", "l_tax")])
    return items.select("l_orderkey", "l_linenumber", "l_partkey", *[c.alias(n) for n, c in terms.items()])


@query(
    "polynomial_terms",
    """select p_partkey, round(d, 6) + 0.0 as p_size_1, round(d * d, 6) as p_size_2, round(d * d * d, 6) + 0.0 as p_size_3
       from (select p_partkey, p_size - (select avg(p_size) from part) as d from part)""",
)
def polynomial_terms(spark, sf):
    powers = X.polynomial_terms(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", 3)
    return powers.select("p_partkey", *[(F.round(f"p_size_{i}", 6) + 0.0).alias(f"p_size_{i}") for i in (1, 2, 3)])


@query(
    "random_split",
    f"select o_orderkey, case when {split_sql('o_orderkey')} < 0.9 then 'train' else 'test' end as part from orders",
)
def random_split(spark, sf):
    return X.with_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.9)
