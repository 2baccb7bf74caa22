"""Counts, moments, quantiles, histograms, correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frame as X
from ..operators import profile as P
from ..runtime import spread_table, table
from .registry import query


@query("row_count", "select 'lineitem' as name, count(*) as n from lineitem union all select 'orders', count(*) from orders")
def row_count(spark, sf):
    names = ["lineitem", "orders"]
    counts = [table(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n") for t in names]
    return counts[0].unionByName(counts[1])


@query(
    "distinct_values",
    """select 'value' as what, c_mktsegment as name, cast(1 as bigint) as n from (select distinct c_mktsegment from customer)
       union all select 'count', 'c_nationkey', count(distinct c_nationkey) from customer""",
)
def distinct_values(spark, sf):
    customer = table(spark, sf, "customer")
    found = customer.select("c_mktsegment").distinct().select(
        F.lit("value").alias("what"), F.col("c_mktsegment").alias("name"), F.lit(1).cast("bigint").alias("n")
    )
    number = customer.agg(F.count_distinct("c_nationkey").alias("n")).select(
        F.lit("count").alias("what"), F.lit("c_nationkey").alias("name"), "n"
    )
    return found.unionByName(number)


@query("group_count", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2")
def group_count(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "null_counts",
    """select count(*) filter (doc_id is null) as doc_id, count(*) filter (source is null) as source,
              count(*) filter (quality is null) as quality, count(*) filter (toxic is null) as toxic
       from documents left join labels using (doc_id)""",
)
def null_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return P.null_counts(docs.join(table(spark, sf, "labels"), "doc_id", "left"))


@query(
    "find_duplicates",
    """select p_name, p_brand, p_type, count(*) as dupe_count from part group by all having count(*) > 1
       union all select md5(text), lang, source, count(*) from documents group by all having count(*) > 1""",
)
def find_duplicates(spark, sf):
    part = P.duplicates(table(spark, sf, "part").select("p_name", "p_brand", "p_type"))
    docs = P.duplicates(table(spark, sf, "documents").select(F.md5("text").alias("p_name"), F.col("lang").alias("p_brand"), F.col("source").alias("p_type")))
    return part.unionByName(docs)


@query("drop_duplicates", "select distinct l_suppkey, l_quantity, l_returnflag from lineitem")
def drop_duplicates(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag").dropDuplicates()


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "numeric_summary",
    " union all ".join(
        f"""select '{c}' as "column", min({c}) as min, round(quantile_cont({c}, 0.25), 6) as q1, round(quantile_cont({c}, 0.5), 6) as median,
            round(avg({c}), 8) as mean, round(quantile_cont({c}, 0.75), 6) as q3, max({c}) as max from lineitem"""
        for c in NUMERIC
    ),
)
def numeric_summary(spark, sf):
    s = P.numeric_summary(spread_table(spark, sf, "lineitem", "l_orderkey"), NUMERIC)
    return s.select("column", "min", *[F.round(c, d).alias(c) for c, d in (("q1", 6), ("median", 6), ("mean", 8), ("q3", 6))], "max")



@query(
    "skewness",
    " union all ".join(
        f"""select '{c}' as "column", round(avg(pow(d, 3)) / pow(avg(d * d), 1.5), 6) + 0.0 as skew
            from (select {c} - (select avg({c}) from lineitem) as d from lineitem)"""
        for c in NUMERIC
    ),
)
def skewness(spark, sf):
    return P.moments(table(spark, sf, "lineitem"), NUMERIC).select("column", (F.round("skew", 6) + 0.0).alias("skew"))


@query(
    "kurtosis",
    " union all ".join(
        f"""select '{c}' as "column", round(kurtosis_pop({c}) + 3, 6) as kurtosis from lineitem""" for c in NUMERIC
    ),
)
def kurtosis(spark, sf):
    return P.moments(table(spark, sf, "lineitem"), NUMERIC).select("column", F.round("kurtosis", 6).alias("kurtosis"))


BINS = """select {by} least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29)::int as bin,
                 round(lo + bin * ((hi - lo) / 30), 4) as from_value, count(*) as n
          from lineitem, (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem) group by all"""


@query("histogram", BINS.format(by=""))
def histogram(spark, sf):
    h = P.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30)
    return h.withColumn("from_value", F.round("from_value", 4))


@query("histogram_by_group", BINS.format(by="l_returnflag,"))
def histogram_by_group(spark, sf):
    h = P.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30, ["l_returnflag"])
    return h.withColumn("from_value", F.round("from_value", 4))


@query(
    "boxplot_stats",
    """with q as (select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.5) as median,
                         quantile_cont(l_extendedprice, 0.75) as q3 from lineitem group by 1),
       f as (select *, l_extendedprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside from lineitem join q using (l_returnflag))
       select l_returnflag, round(any_value(q1), 6) as q1, round(any_value(median), 6) as median, round(any_value(q3), 6) as q3,
              min(l_extendedprice) filter (inside) as whisker_low, max(l_extendedprice) filter (inside) as whisker_high,
              count(*) filter (not inside) as outliers, count(*) as n from f group by 1""",
)
def boxplot_stats(spark, sf):
    b = P.boxplot(spread_table(spark, sf, "lineitem", "l_orderkey"), "l_returnflag", "l_extendedprice")
    return b.select("l_returnflag", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high", "outliers", "n")


PEARSON = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flag", "status"]


@query(
    "pearson_matrix",
    "with x as (select *, ascii(l_returnflag) as r, dense_rank() over (order by l_returnflag) as flag, dense_rank() over (order by l_linestatus) as status from lineitem) "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 8) + 0.0 as r from x"
        for i, a in enumerate(PEARSON)
        for b in PEARSON[i + 1 :]
    ),
)
def pearson_matrix(spark, sf):
    items = X.with_factor_code(table(spark, sf, "lineitem"), "l_returnflag", "flag")
    items = X.with_factor_code(items, "l_linestatus", "status")
    return P.pearson_pairs(items, PEARSON).select("a", "b", (F.round("r", 8) + 0.0).alias("r"))


SPEARMAN = ["l_quantity", "l_discount", "l_tax", "l_suppkey", "l_partkey", "l_linenumber"]


def spearman_sql(source: str) -> str:
    ranks = ", ".join(
        f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as r_{c}"
        for c in [*SPEARMAN, "l_extendedprice"]
    )
    rows = " union all ".join(
        f"select '{c}' as feature, round(corr(r_{c}, r_l_extendedprice), 8) + 0.0 as rho from r" for c in SPEARMAN
    )
    return f"with src as ({source}), r as (select {ranks} from src) {rows}"


@query("spearman_pairs", spearman_sql("select * from lineitem"))
def spearman_pairs(spark, sf):
    s = P.spearman_with(spread_table(spark, sf, "lineitem", "l_orderkey"), "l_extendedprice", SPEARMAN)
    return s.withColumn("rho", F.round("rho", 8) + 0.0)


def edge_sql(columns: list[str], buckets: int, source: str) -> str:
    """Bucket = number of distinct inner quantiles at or below the value."""
    probs = "[" + ", ".join(repr(i / buckets) for i in range(1, buckets)) + "]"
    edges = ", ".join(f"list_distinct(quantile_cont({c}::double, {probs})) as e_{c}" for c in columns)
    cuts = ", ".join(f"len(list_filter(e_{c}, lambda e: {c} >= e))::double as {c}" for c in columns)
    return f"select * replace ({cuts}) from {source}, (select {edges} from {source})"


@query("spearman_discretized", spearman_sql(edge_sql(SPEARMAN, 15, "lineitem")))
def spearman_discretized(spark, sf):
    items = spread_table(spark, sf, "lineitem", "l_orderkey").select("l_extendedprice", *SPEARMAN)
    cut = P.quantile_buckets(items, SPEARMAN, 15)
    cut = cut.select("l_extendedprice", *[F.col(f"{c}_discretized").alias(c) for c in SPEARMAN])
    return P.spearman_with(cut, "l_extendedprice", SPEARMAN).withColumn("rho", F.round("rho", 8) + 0.0)


@query(
    "group_sum_all",
    """select l_suppkey, sum(l_quantity) as l_quantity, round(sum(l_extendedprice), 2) as l_extendedprice,
              round(sum(l_discount), 4) as l_discount, round(sum(l_tax), 4) as l_tax from lineitem group by 1""",
)
def group_sum_all(spark, sf):
    items = table(spark, sf, "lineitem").select("l_suppkey", *NUMERIC)
    places = {"l_quantity": 6, "l_extendedprice": 2, "l_discount": 4, "l_tax": 4}
    return items.groupBy("l_suppkey").agg(*[F.round(F.sum(c), places[c]).alias(c) for c in NUMERIC])
