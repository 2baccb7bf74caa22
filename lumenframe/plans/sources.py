"""Readers and writers: each query writes a table in the layout and reads it back."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sources as S
from ..runtime import fresh_path, lookup, table
from .registry import query


@query(
    "read_csv_inferred",
    "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
)
def read_csv_inferred(spark, sf):
    path = S.write_csv(table(spark, sf, "customer"), fresh_path(spark, "csv"))
    return S.read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("read_csv_multiline", "select doc_id, source, text from documents")
def read_csv_multiline(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    path = S.write_csv(docs, fresh_path(spark, "plots"), quote_all=True)
    return S.read_multiline_csv(spark, path, docs.schema).select("doc_id", "source", "text")


@query(
    "read_libsvm",
    """select cast(label as double) as label, count(*) as n,
              round(sum(list_sum(embedding::double[])), 3) as feature_sum
       from embeddings group by 1""",
)
def read_libsvm(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    path = fresh_path(spark, "libsvm")
    (
        rows.write.format("libsvm")
        .option("mapreduce.output.fileoutputformat.compress", "true")
        .option("mapreduce.output.fileoutputformat.compress.codec", "org.apache.hadoop.io.compress.BZip2Codec")
        .save(path)
    )
    back = S.read_libsvm(spark, path, 64)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return back.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(total), 3).alias("feature_sum")
    )


def weather_lines(lineitem):
    """Line items dressed as weather records; returned items carry the missing code."""

    def digits(col, width, sign=True):
        body = F.lpad(F.abs(col).cast("int").cast("string"), width - int(sign), "0")
        return F.concat(F.when(col < 0, "-").otherwise("+"), body) if sign else body

    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    ship = F.col("l_shipdate")
    return F.concat(
        F.lit("#" * 15),
        F.date_format(ship, "yyyyMMdd"),
        digits(F.col("l_linenumber"), 2, sign=False),
        F.lit("###"),
        digits(F.round(quantity * 1000), 6),
        digits(F.when(flag == "R", -1).otherwise(1) * F.round(F.col("l_discount") * 100000), 7),
        F.lit("#" * 5),
        digits(quantity, 5),
        F.lit("#" * 9),
        digits(F.col("l_linenumber") * 10, 3, sign=False),
        F.lit("##"),
        digits(F.round(F.col("l_tax") * 1000), 4, sign=False),
        F.lit("#"),
        digits(quantity * 100, 5, sign=False),
        F.lit("###"),
        digits(F.floor("l_extendedprice"), 6, sign=False),
        F.lit("###"),
        F.when(flag == "N", "+9999").otherwise(
            digits(F.when(flag == "R", -1).otherwise(1) * quantity * 10, 5)
        ),
        F.lit("#"),
        digits(F.round(F.col("l_discount") * 1000) - 50, 5),
    )


@query(
    "read_fixed_width",
    """select year(l_shipdate)::int as year, month(l_shipdate)::int as month, count(*) as n,
              sum(day(l_shipdate))::bigint as days, sum(l_linenumber)::bigint as hours,
              round(sum(l_quantity), 3) as latitude,
              round(sum(case when l_returnflag = 'R' then -1 else 1 end * l_discount * 100), 3) as longitude,
              sum(l_quantity::int)::bigint as elevation, sum(l_linenumber * 10)::bigint as direction,
              round(sum(l_tax * 100), 3) as speed, sum((l_quantity * 100)::int)::bigint as ceiling_height,
              sum(floor(l_extendedprice)::bigint)::bigint as distance,
              round(sum(round(l_discount * 1000) - 50) / 10, 3) + 0.0 as dew_point,
              round(sum(case when l_returnflag = 'R' then -1 else 1 end * l_quantity), 3) as air
       from lineitem where l_returnflag <> 'N' group by 1, 2""",
)
def read_fixed_width(spark, sf):
    items = table(spark, sf, "lineitem")
    path = S.write_lines(items, weather_lines(items), fresh_path(spark, "weather"))
    w = S.read_fixed_width(spark, path)
    return w.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("day").alias("days"),
        F.sum("hour").alias("hours"),
        F.round(F.sum("latitude"), 3).alias("latitude"),
        F.round(F.sum("longitude"), 3).alias("longitude"),
        F.sum("elevationDimension").alias("elevation"),
        F.sum("directionAngle").alias("direction"),
        F.round(F.sum("speedRate"), 3).alias("speed"),
        F.sum("ceilingHeightDimension").alias("ceiling_height"),
        F.sum("distanceDimension").alias("distance"),
        F.round(F.sum("dewPointTemperature"), 3).alias("dew_point"),
        F.round(F.sum("airTemperature"), 3).alias("air"),
    )


@query(
    "read_whitespace_points",
    "select cast(p_size as double) as vec_1, p_retailprice as vec_2 from part",
)
def read_whitespace_points(spark, sf):
    part = table(spark, sf, "part")
    line = F.concat(F.lit("  "), F.col("p_size").cast("string"), F.lit(" \t  "), F.col("p_retailprice").cast("string"))
    return S.read_points(spark, S.write_lines(part, line, fresh_path(spark, "points")))


def type_baskets(spark, sf):
    """Part types per order: a set over a handful of types, so it stays small per key."""
    items = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    types = table(spark, sf, "part").select("p_partkey", "p_type")
    return (
        lookup(items, types, ["p_partkey"])
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_set("p_type")).alias("items"))
    )


@query(
    "read_ragged_lines",
    """select cast(l_orderkey as varchar) as key, count(distinct p_type) as n_items,
              string_agg(distinct p_type, '|' order by p_type) as items
       from lineitem join part on l_partkey = p_partkey group by l_orderkey""",
)
def read_ragged_lines(spark, sf):
    baskets = type_baskets(spark, sf)
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("items"))
    path = S.write_lines(baskets, line, fresh_path(spark, "ragged"), "ISO-8859-1")
    back = S.read_ragged(spark, path)
    return back.select(
        "key", F.size("items").cast("bigint").alias("n_items"), F.concat_ws("|", "items").alias("items")
    )


@query(
    "read_text_skip_rows",
    """select n_name as word from (select n_name, row_number() over (order by n_nationkey) as line from nation)
       where line not in (2, 6)""",
)
def read_text_skip_rows(spark, sf):
    nation = table(spark, sf, "nation").orderBy("n_nationkey").coalesce(1)  # a 25-row reference list
    line = F.concat_ws(" ", "n_name", F.lit("State of"), F.col("n_regionkey").cast("string"))
    path = S.write_lines(nation, line, fresh_path(spark, "states"))
    return S.read_list_skipping(spark, path, [1, 5])


@query(
    "read_word_list",
    "select distinct word from (select unnest(string_split(p_name, ' ')) as word from part) where word <> ''",
)
def read_word_list(spark, sf):
    words = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return S.read_words(spark, S.write_lines(words, F.col("word"), fresh_path(spark, "words")))


@query(
    "read_array_records",
    """select vec_id, len(embedding)::int as width, round(list_sum(embedding::double[]), 6) as total,
              round(embedding[1]::double, 6) as head from embeddings""",
)
def read_array_records(spark, sf):
    df = S.read_array_records(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return df.select(
        "vec_id",
        F.size("embedding").alias("width"),
        F.round(total, 6).alias("total"),
        F.round(F.get("embedding", F.lit(0)), 6).alias("head"),
    )


@query(
    "extract_html_elements",
    r"""select page_id, (pos - 1)::int as pos,
               regexp_replace(el, '(?s)<[^>]*>', '', 'g') as text,
               regexp_extract(el, '(?is)^<[^>]*?\shref="([^"]*)"', 1) as href
        from (select page_id, unnest(els) as el, generate_subscripts(els, 1) as pos
              from (select page_id, regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>.*?</a>') as els from pages))""",
)
def extract_html_elements(spark, sf):
    return S.extract_elements(table(spark, sf, "pages"), "page_id", "html", "a", attribute="href")


@query(
    "extract_nested_elements",
    r"""with p as (select page_id, '<div class="page">' || html || '</div>' as html from pages where html is not null),
             t as (select page_id, regexp_extract_all(html, '(?is)<div(?:\s[^>]*)?>|</div\s*>') as tags,
                          string_split_regex(html, '(?is)<div(?:\s[^>]*)?>|</div\s*>') as gaps from p),
             u as (select *, unnest(range(1, len(tags) + 1)) as i from t),
             d as (select *, tags[i] like '</%' as closing,
                          sum(case when tags[i] like '</%' then -1 else 1 end) over (partition by page_id order by i) as depth from u),
             c as (select o.page_id, o.i, min(k.i) as j from d o join d k on k.page_id = o.page_id and k.i > o.i and k.closing and k.depth = o.depth - 1
                   where not o.closing group by 1, 2),
             w as (select page_id, i, array_to_string(list_transform(range(i, j + 1), lambda x: tags[x] || case when x < j then gaps[x + 1] else '' end), '') as el
                   from c join u using (page_id, i))
        select page_id, (row_number() over (partition by page_id order by i) - 1)::int as pos,
               regexp_replace(el, '(?s)<[^>]*>', '', 'g') as text, regexp_extract(el, '(?is)^<[^>]*?\sclass="([^"]*)"', 1) as class from w""",
)
def extract_nested_elements(spark, sf):
    """Every page inside a frame of the name of its own inner boxes."""
    framed = F.concat(F.lit('<div class="page">'), "html", F.lit("</div>"))
    pages = table(spark, sf, "pages").where("html is not null").select("page_id", framed.alias("html"))
    return S.extract_elements(pages, "page_id", "html", "div", attribute="class")


@query(
    "extract_reviews",
    r"""select doc_id // 10 as page_id, (row_number() over (partition by doc_id // 10 order by doc_id, quality, toxic) - 1)::int as pos,
               regexp_replace(text, '[<>]', ' ', 'g') as review, (quality + 1)::int as real_score
        from documents join labels using (doc_id) where text is not null and quality is not null""",
)
def extract_reviews(spark, sf):
    """Pages of ten labelled documents as reviews with stars, taken apart again."""
    both = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").where("text is not null and quality is not null")
    star = lambda n: F.concat(F.lit('<div class="stars x" aria-label="'), n.cast("string"), F.lit(' star rating"></div>'))
    review = F.concat(
        F.lit('<p class="comment y">'), F.regexp_replace("text", "[<>]", " "), F.lit("</p>"), star(F.col("quality") + 1)
    )
    rows = both.select(F.floor(F.col("doc_id") / 10).alias("page_id"), F.struct("doc_id", "quality", "toxic", review.alias("html")).alias("r"))
    # At most ten documents of one id range stand on a page.
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["html"]), "\n")
    pages = rows.groupBy("page_id").agg(F.concat(star(F.lit(5)), joined).alias("html"))
    return S.paired_review_rows(
        pages, text_tag="p", text_class="comment", score_tag="div", score_class="stars", score_attribute="aria-label"
    )


@query(
    "frame_with_schema",
    """select year(l_shipdate)::int as year, l_quantity::int as quantity, count(*) as n,
              round(sum(l_extendedprice), 2) as price from lineitem group by 1, 2""",
)
def frame_with_schema(spark, sf):
    schema = T.StructType(
        [
            T.StructField("year", T.IntegerType(), False),
            T.StructField("quantity", T.IntegerType(), False),
            T.StructField("price", T.DoubleType(), False),
        ]
    )
    raw = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy").alias("year"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    typed = S.enforce_schema(raw, schema)
    return typed.groupBy("year", "quantity").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price")
    )


@query(
    "write_csv",
    """select o_orderstatus, o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total,
              min(o_orderdate) as first_day from orders group by 1, 2""",
    text=("first_day",),
)
def write_csv(spark, sf):
    orders = table(spark, sf, "orders")
    back = S.read_csv(spark, S.write_csv(orders, fresh_path(spark, "orders")), orders.schema)
    return back.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").alias("first_day"),
    )


@query("save_load_model", "select count(*) as n, cast(0 as bigint) as changed from part")
def save_load_model(spark, sf):
    part = table(spark, sf, "part")
    stages = [
        VectorAssembler(inputCols=["p_partkey", "p_size"], outputCol="features"),
        LinearRegression(labelCol="p_retailprice", solver="normal"),
    ]
    model = Pipeline(stages=stages).fit(part)
    path = fresh_path(spark, "model")
    model.write().overwrite().save(path)
    scored = PipelineModel.load(path).transform(
        model.transform(part).withColumnsRenamed({"prediction": "before"}).drop("features")
    )
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("prediction") != F.col("before"), 1)).alias("changed"),
    )
