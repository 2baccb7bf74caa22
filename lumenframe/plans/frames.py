"""Projections, filters, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frame as X
from ..runtime import table
from .registry import query
from .sources import type_baskets


@query("select_columns", "select o_orderkey, o_totalprice, o_orderpriority from orders")
def select_columns(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    "rename_drop",
    "select cast(o_orderdate as date) as date, o_totalprice as y, o_orderkey from orders",
    text=("date",),
)
def rename_drop(spark, sf):
    renamed = table(spark, sf, "orders").withColumnsRenamed({"o_orderdate": "date", "o_totalprice": "y"})
    return renamed.drop("o_custkey", "o_orderstatus", "o_orderpriority").withColumn("date", F.to_date("date"))


@query("columns_except", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax from lineitem")
def columns_except(spark, sf):
    items = table(spark, sf, "lineitem")
    return items.select(*X.columns_except(items, "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"))


@query(
    "filter_sentinel",
    "select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where l_returnflag is distinct from 'N'",
)
def filter_sentinel(spark, sf):
    kept = X.drop_sentinel(table(spark, sf, "lineitem"), "l_returnflag", "N")
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "filter_by_period",
    """select 'before' as part, o_orderkey, o_totalprice from orders where year(o_orderdate) < 1998
       union all select 'year', o_orderkey, o_totalprice from orders where year(o_orderdate) = 2000
       union all select 'month', o_orderkey, o_totalprice from orders where year(o_orderdate) = 1999 and month(o_orderdate) = 12""",
)
def filter_by_period(spark, sf):
    orders = table(spark, sf, "orders")
    parts = {
        "before": X.years_before(orders, "o_orderdate", 1998),
        "year": X.in_year(orders, "o_orderdate", 2000),
        "month": X.in_month(orders, "o_orderdate", 1999, 12),
    }
    labelled = [p.select(F.lit(k).alias("part"), "o_orderkey", "o_totalprice") for k, p in parts.items()]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


@query(
    "drop_missing",
    "select d.doc_id, l.quality, l.toxic from documents d left join labels l using (doc_id) where l.quality is not null and l.toxic is not null",
)
def drop_missing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").na.drop()


@query(
    "fill_missing",
    """select d.doc_id, coalesce(l.quality, 0) as quality, coalesce(l.toxic, 0) as toxic,
              coalesce(l.quality / nullif(l.toxic, 0), 0.0)::double as ratio
       from documents d left join labels l using (doc_id)""",
)
def fill_missing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    ratio = X.ratio_or_zero(F.col("quality"), F.col("toxic")).alias("ratio")
    return joined.select("doc_id", "quality", "toxic", ratio).na.fill(0)


@query(
    "threshold_flag",
    "select p_partkey, p_size, case when p_size >= 30 then 1 else 0 end as size_rng from part",
)
def threshold_flag(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", "p_size", X.threshold_flag(F.col("p_size"), 30).alias("size_rng"))


@query("unique_label", "select doc_id, source || ' :' || doc_id as title from documents")
def unique_label(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", X.unique_label(F.col("source"), F.col("doc_id")).alias("title"))


@query(
    "baseline_shift",
    "select p_partkey, round(p_retailprice - (select min(p_retailprice) from part), 6) as shifted from part",
)
def baseline_shift(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    shifted = X.baseline_shift(part, "p_retailprice", "shifted")
    return shifted.select("p_partkey", F.round("shifted", 6).alias("shifted"))


@query(
    "truncate_text",
    """select doc_id, w::int as "window", substring(text, w * 800 + 1, 800) as piece
       from (select doc_id, text, unnest(range(0, greatest(ceil(length(text) / 800.0)::bigint, 1))) as w from documents)""",
)
def truncate_text(spark, sf):
    return X.text_windows(table(spark, sf, "documents"), "text", 800).select("doc_id", "window", "piece")


@query(
    "melt_wide",
    """select s_suppkey as key, s_name as value from supplier
       union all select s_suppkey, cast(s_nationkey as varchar) from supplier
       union all select s_suppkey, case when s_acctbal >= 0 then cast(s_acctbal as varchar) end from supplier where s_acctbal >= 0""",
)
def melt_wide(spark, sf):
    wide = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"),
        "s_name",
        F.col("s_nationkey").cast("string").alias("nation"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal").cast("string")).alias("balance"),
    )
    return X.melt(wide, ["key"], ["s_name", "nation", "balance"])


@query(
    "one_hot_rows",
    """select c_custkey, (c_mktsegment = 'AUTOMOBILE')::int as "AUTOMOBILE", (c_mktsegment = 'BUILDING')::int as "BUILDING",
              (c_mktsegment = 'FURNITURE')::int as "FURNITURE", (c_mktsegment = 'HOUSEHOLD')::int as "HOUSEHOLD",
              (c_mktsegment = 'MACHINERY')::int as "MACHINERY" from customer""",
)
def one_hot_rows(spark, sf):
    return X.one_hot(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment").drop("c_mktsegment")


@query(
    "one_hot_grouped",
    """select l_orderkey, count(*) filter (l_returnflag = 'A') as "A", count(*) filter (l_returnflag = 'N') as "N",
              count(*) filter (l_returnflag = 'R') as "R" from lineitem group by l_orderkey""",
)
def one_hot_grouped(spark, sf):
    return X.multi_hot(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag")


@query(
    "factor_codes",
    """select o_orderkey, code from orders join
       (select p, row_number() over (order by p)::int as code from (select distinct o_orderpriority as p from orders))
       on o_orderpriority = p""",
)
def factor_codes(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return X.with_factor_code(orders, "o_orderpriority", "code").drop("o_orderpriority")


@query(
    "state_matrix",
    """select l_orderkey as label, bool_or(p_type = 'ECONOMY')::int as "ECONOMY",
              bool_or(p_type = 'LARGE')::int as "LARGE", bool_or(p_type = 'MEDIUM')::int as "MEDIUM", bool_or(p_type = 'PROMO')::int as "PROMO",
              bool_or(p_type = 'SMALL')::int as "SMALL", bool_or(p_type = 'STANDARD')::int as "STANDARD"
       from lineitem join part on l_partkey = p_partkey group by 1""",
)
def state_matrix(spark, sf):
    baskets = type_baskets(spark, sf)
    long = baskets.select(F.col("l_orderkey").alias("label"), F.explode("items").alias("item"))
    hot = X.multi_hot(long, "label", "item")
    return hot.select("label", *[(F.col(c) > 0).cast("int").alias(c) for c in hot.columns[1:]])
