"""Itemsets, rules, subclusters, user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import baskets as B
from ..operators import clusters as C
from ..operators import ward
from ..operators import udfs as U
from ..operators.features import standardize
from ..runtime import spread_table, table
from .registry import query
from .sources import type_baskets

MASKS = """
items as (select p_type as item, (row_number() over (order by p_type) - 1)::int as bit from (select distinct p_type from part)),
baskets as (select l_orderkey, bit_or(1 << bit) as b from lineitem join part on l_partkey = p_partkey join items on p_type = item group by 1),
cand as (select unnest(range(1, 1 << (select count(*)::int from items))) as m),
freq as (select m, count(*) as freq, count(*) / (select count(*) from baskets)::double as support from cand join baskets on (b & m) = m group by 1 having count(*) / (select count(*) from baskets)::double >= 0.1),
names as (select m, string_agg(item, '|' order by item) as names from cand join items on (m >> bit) & 1 = 1 group by 1)
"""


@query("frequent_itemsets", f"with {MASKS} select names as items, freq, round(support, 8) as support from freq join names using (m)")
def frequent_itemsets(spark, sf):
    found = B.frequent_itemsets(type_baskets(spark, sf), "items", 0.1)
    return found.select(F.concat_ws("|", "items").alias("items"), "freq", F.round("support", 8).alias("support"))


@query(
    "association_rules",
    f"""with {MASKS} select l.names as lhs, r.names as rhs, round(f.support, 8) as support, round(f.support / a.support, 8) as confidence,
        round(f.support / a.support / b.support, 8) as lift
        from freq f join freq a on (f.m & a.m) = a.m and a.m <> f.m join freq b on b.m = f.m - a.m
        join names l on l.m = a.m join names r on r.m = b.m where f.support / a.support >= 0.2""",
)
def association_rules(spark, sf):
    rules = B.association_rules(B.frequent_itemsets(type_baskets(spark, sf), "items", 0.1), 0.2)
    return rules.select(
        F.concat_ws("|", "lhs").alias("lhs"),
        F.concat_ws("|", "rhs").alias("rhs"),
        *[F.round(c, 8).alias(c) for c in ("support", "confidence", "lift")],
    )


def points(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("vec_1"), F.col("l_extendedprice").alias("vec_2")
    )
    return standardize(items, ["vec_1", "vec_2"])


CELLS = """
z as (select (l_quantity - a) / b as vec_1, (l_extendedprice - c) / d as vec_2 from lineitem,
      (select avg(l_quantity) as a, stddev_pop(l_quantity) as b, avg(l_extendedprice) as c, stddev_pop(l_extendedprice) as d from lineitem)),
cells as (select floor(vec_1 / sqrt(0.5))::bigint as cell_1, floor(vec_2 / sqrt(0.5))::bigint as cell_2, count(*) as n, avg(vec_1) as vec_1, avg(vec_2) as vec_2,
                 sqrt(var_pop(vec_1) + var_pop(vec_2)) as radius from z group by 1, 2)
"""


@query(
    "cf_subclusters",
    f"with {CELLS} select cell_1, cell_2, n, round(vec_1, 8) + 0.0 as vec_1, round(vec_2, 8) + 0.0 as vec_2, round(radius, 8) as radius from cells",
)
def cf_subclusters(spark, sf):
    cells = C.subclusters(points(spark, sf), ["vec_1", "vec_2"], 0.5)
    return cells.withColumns({c: F.round(c, 8) + 0.0 for c in ("vec_1", "vec_2", "radius")})


@query("cf_global_clusters")
def cf_global_clusters(spark, sf):
    columns, fine = ["vec_1", "vec_2"], 0.05
    rows = points(spark, sf)
    cells = C.global_clusters(C.subclusters(rows, columns, fine), columns, 100)
    return C.label_points(rows, cells, columns, fine)


@query("cf_ward_clusters")
def cf_ward_clusters(spark, sf):
    """Every point with one of 100 clusters, merged from the subclusters by Ward's criterion."""
    columns, fine = ["vec_1", "vec_2"], 0.05
    rows = points(spark, sf)
    cells = ward.clusters(C.subclusters(rows, columns, fine), columns, 100)
    return C.label_points(rows, cells, columns, fine)


@query("cluster_counts", f"with {CELLS} select count(*) as clusters, sum(n)::bigint as points, max(n) as largest from cells")
def cluster_counts(spark, sf):
    return C.cluster_counts(C.subclusters(points(spark, sf), ["vec_1", "vec_2"], 0.5))


@query("cluster_counts_global")
def cluster_counts_global(spark, sf):
    columns = ["vec_1", "vec_2"]
    cells = C.subclusters(points(spark, sf), columns, 0.05)
    return C.cluster_counts(C.global_clusters(cells, columns, 100), "cluster")


@query("row_function", "select doc_id, length(text)::int as n, (length(text) % 5 + 1)::int as score from documents")
def row_function(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.length("text").alias("n"))
    return U.apply_per_value(docs, "n", "score", "int", lambda v: v % 5 + 1)


@query(
    "group_function",
    """select l_suppkey, l_returnflag, sum(l_quantity) as l_quantity, count(*) as n from lineitem group by 1, 2""",
)
def group_function(spark, sf):
    items = spread_table(spark, sf, "lineitem", "l_orderkey").select("l_suppkey", "l_returnflag", "l_quantity")
    return U.reduce_groups(
        items,
        ["l_suppkey", "l_returnflag"],
        {"l_quantity": "double", "n": "bigint"},
        lambda pdf: {"l_quantity": pdf["l_quantity"].sum(), "n": len(pdf)},
        lambda pdf: {"l_quantity": pdf["l_quantity"].sum(), "n": pdf["n"].sum()},
    )


@query(
    "partition_function",
    r"""select doc_id, len(list_filter(regexp_extract_all(lower(text), '\p{L}+'), lambda w: length(w) > 2))::int as n from documents""",
)
def partition_function(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id").select("doc_id", "text")
    return U.count_words(docs, "doc_id", "text")
