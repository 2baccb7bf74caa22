"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..runtime import table
from .registry import query


@query(
    "text_functions",
    r"""select doc_id, string_split(text, ' ')[1] as first_word, substring(text, 3, 5) as cut, lower(source) as low,
               length(text)::int as n, regexp_full_match(string_split(text, ' ')[1], '\p{L}+')::int as letters,
               concat_ws(', ', lang, source) as joined, len(regexp_extract_all(text, '\p{L}+'))::int as words
        from documents""",
)
def text_functions(spark, sf):
    first = F.get(F.split("text", " "), F.lit(0))
    return table(spark, sf, "documents").select(
        "doc_id",
        first.alias("first_word"),
        F.substring("text", 3, 5).alias("cut"),
        F.lower("source").alias("low"),
        F.length("text").alias("n"),
        first.rlike(r"^\p{L}+\z").cast("int").alias("letters"),
        F.concat_ws(", ", "lang", "source").alias("joined"),
        F.size(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("words"),
    )


@query(
    "math_functions",
    """select l_orderkey, l_linenumber, l_partkey, round(ln(l_extendedprice), 8) as ln_price, round(sqrt(l_quantity), 8) as root,
              round(exp(-l_discount), 8) as decay, round(tanh(l_tax), 8) as squash, round(pow(l_quantity, 3), 4) as cube,
              round(abs(l_discount - l_tax), 8) as gap, round(cbrt(l_quantity - 25), 8) + 0.0 as root3,
              round_even(l_quantity / 2, 0) as half_even from lineitem""",
)
def math_functions(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.log("l_extendedprice"), 8).alias("ln_price"),
        F.round(F.sqrt("l_quantity"), 8).alias("root"),
        F.round(F.exp(-F.col("l_discount")), 8).alias("decay"),
        F.round(F.tanh("l_tax"), 8).alias("squash"),
        F.round(F.pow("l_quantity", F.lit(3.0)), 4).alias("cube"),
        F.round(F.abs(F.col("l_discount") - F.col("l_tax")), 8).alias("gap"),
        (F.round(F.cbrt(F.col("l_quantity") - 25), 8) + 0.0).alias("root3"),
        F.bround(F.col("l_quantity") / 2, 0).alias("half_even"),
    )


@query(
    "date_functions",
    """select event_id, cast(ts as date) as day, year(ts)::int as year, month(ts)::int as month,
              day(ts)::int as dom, hour(ts)::int as hour from events""",
    text=("day",),
)
def date_functions(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf, "events").select(
        "event_id",
        F.to_date(text, "yyyy-MM-dd").alias("day"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("dom"),
        F.hour("ts").alias("hour"),
    )


@query(
    "array_functions",
    """with e as (select vec_id, embedding::double[] as x from embeddings)
       select vec_id, len(x[2:])::int as tail, round(list_dot_product(x, list_reverse(x)), 6) as dot,
              round(pow(list_distance(x, list_reverse(x)), 2), 6) as gap2, round(sqrt(list_dot_product(x, x)), 6) as norm,
              len(list_distinct(list_transform(x, lambda v: sign(v))))::int as signs from e""",
)
def array_functions(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    x, back = F.col("x"), F.reverse("x")
    return rows.select(
        "vec_id",
        F.size(F.slice(x, 2, F.size(x))).alias("tail"),
        F.round(V.dot(x, back), 6).alias("dot"),
        F.round(V.squared_distance(x, back), 6).alias("gap2"),
        F.round(V.norm(x), 6).alias("norm"),
        F.size(F.array_distinct(F.transform(x, F.signum))).alias("signs"),
    )


@query(
    "type_functions",
    """select o_orderkey, try_cast(substring(o_orderpriority, 1, 1) as int) as level,
              coalesce(try_cast(o_orderpriority as double), -1.0)::double as not_a_number, cast(o_totalprice as bigint) as whole,
              cast(o_orderkey as varchar) as label
       from (select * replace (trunc(o_totalprice) as o_totalprice) from orders)""",
)
def type_functions(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"),
        F.coalesce(F.col("o_orderpriority").try_cast("double"), F.lit(-1.0)).alias("not_a_number"),
        F.col("o_totalprice").cast("bigint").alias("whole"),
        F.col("o_orderkey").cast("string").alias("label"),
    )
