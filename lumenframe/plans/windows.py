"""Lags, changes, ordinals and chronological splits of daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import daily as D
from ..operators import text as X
from ..operators.ranking import ordinal
from ..runtime import spread_table, table
from .joins import TOKENS
from .registry import query

DAILY = """
daily as (select o_orderstatus as series_id, cast(o_orderdate as date) as t, round(sum(o_totalprice), 2) as y,
                 count(*)::double as y2 from orders group by 1, 2)
"""
EVENT_DAYS = """
evd as (select event_type as series_id, cast(ts as date) as t, count(*)::double as y, round(sum(value), 2) as y2 from events group by 1, 2)
"""


def order_days(spark, sf):
    """Price per day and order status; the count as second series."""
    return D.daily_series(
        table(spark, sf, "orders"),
        F.col("o_orderstatus"),
        F.col("o_orderdate"),
        y=F.round(F.sum("o_totalprice"), 2),
        y2=F.count(F.lit(1)).cast("double"),
    )


def event_days(spark, sf):
    return D.daily_series(
        table(spark, sf, "events"),
        F.col("event_type"),
        F.col("ts"),
        y=F.count(F.lit(1)).cast("double"),
        y2=F.round(F.sum("value"), 2),
    )


@query(
    "lag_column",
    f"with {EVENT_DAYS} select series_id, t, y, lag(y) over (partition by series_id order by t) as prev from evd",
    text=("t",),
)
def lag_column(spark, sf):
    return D.lagged(event_days(spark, sf), "y", 1).select("series_id", "t", "y", F.col("lag1").alias("prev"))


@query(
    "lag_table",
    f"""with {DAILY} select series_id, t, y, coalesce(lag(y, 1) over w, 0.0) as x1, coalesce(lag(y, 2) over w, 0.0) as x2,
        coalesce(lag(y, 3) over w, 0.0) as x3 from daily window w as (partition by series_id order by t)""",
    text=("t",),
)
def lag_table(spark, sf):
    return D.lag_table(order_days(spark, sf).drop("y2"), "y", 3)


@query(
    "pct_change",
    f"""with {DAILY} select series_id, t, round(100 * (y / prev - 1), 6) as change from
        (select *, lag(y) over (partition by series_id order by t) as prev from daily) where prev is not null""",
    text=("t",),
)
def pct_change(spark, sf):
    changed = D.pct_change(order_days(spark, sf), "y", "change")
    return changed.select("series_id", "t", F.round("change", 6).alias("change"))


@query(
    "cube_root",
    f"""with {DAILY} select series_id, t, round(cbrt(100 * (y / prev - 1)), 6) + 0.0 as steady from
        (select *, lag(y) over (partition by series_id order by t) as prev from daily) where prev is not null""",
    text=("t",),
)
def cube_root(spark, sf):
    changed = D.pct_change(order_days(spark, sf), "y", "change")
    return changed.select("series_id", "t", (F.round(F.cbrt("change"), 6) + 0.0).alias("steady"))


@query(
    "dense_ids",
    f"""with {TOKENS} select 'term' as what, term as name, term_id::bigint as id from vocab
        union all select 'doc', cast(doc_id as varchar), row_number() over (order by doc_id) - 1 from documents""",
)
def dense_ids(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id")
    vocab = X.vocabulary(X.bag_of_words(docs), X.row_total(docs))
    terms = vocab.select(F.lit("term").alias("what"), F.col("term").alias("name"), F.col("term_id").cast("bigint").alias("id"))
    numbered = ordinal(docs.select("doc_id"), [], "doc_id", "id")
    return terms.unionByName(
        numbered.select(F.lit("doc").alias("what"), F.col("doc_id").cast("string").alias("name"), "id")
    )


@query(
    "chrono_split",
    f"""with {DAILY} select series_id, t, case when row_number() over (partition by series_id order by t)
        <= round_even(0.8::double * count(*) over (partition by series_id), 0) then 'train' else 'test' end as part from daily""",
    text=("t",),
)
def chrono_split(spark, sf):
    return D.chrono_split(order_days(spark, sf)).select("series_id", "t", "part")


@query(
    "expanding_origin",
    f"""with {DAILY}, p as (select *, lag(y) over (partition by series_id order by t) as x from daily),
        r as (select series_id, t, y, x, count(x) over w as pairs, regr_slope(y, x) over w as slope, regr_intercept(y, x) over w as c from p
              window w as (partition by series_id order by t rows between unbounded preceding and 1 preceding))
        select series_id, t, pairs, case when pairs > 1 then round(slope, 6) + 0.0 end as slope,
               case when pairs > 1 then round(c + slope * x, 3) end as forecast from r""",
    text=("t",),
)
def expanding_origin(spark, sf):
    run = D.expanding_ar1(order_days(spark, sf), "y")
    return run.select(
        "series_id",
        "t",
        F.coalesce("pairs", F.lit(0)).cast("bigint").alias("pairs"),
        (F.round("slope", 6) + 0.0).alias("slope"),
        F.round("forecast", 3).alias("forecast"),
    )
