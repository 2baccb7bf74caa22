"""Metrics, checked with a fixed rule standing in for a model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import ols
from ..runtime import table
from .registry import query

RULED = """
ruled as (select o_orderstatus as label, case when o_totalprice >= 300000 then 'F' when o_totalprice >= 150000 then 'O' else 'P' end as prediction from orders),
cells as (select label, prediction, count(*) as n from ruled group by 1, 2),
per as (select l.label, support, called, coalesce(tp, 0) as tp from
        (select label, sum(n)::bigint as support from cells group by 1) l
        join (select prediction, sum(n)::bigint as called from cells group by 1) c on l.label = c.prediction
        left join (select label, n as tp from cells where label = prediction) t on t.label = l.label)
"""


def cells(spark, sf):
    """Order status against a price rule."""
    price = F.col("o_totalprice")
    rule = F.when(price >= 300000, "F").when(price >= 150000, "O").otherwise("P")
    ruled = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("label"), rule.alias("prediction"))
    return ruled, M.confusion(ruled, "label", "prediction")


@query(
    "confusion_matrix",
    f"""with {RULED} select label, count(*) filter (prediction = 'F') as "pred_F", count(*) filter (prediction = 'O') as "pred_O",
        count(*) filter (prediction = 'P') as "pred_P" from ruled group by 1""",
)
def confusion_matrix(spark, sf):
    return M.confusion_matrix(cells(spark, sf)[0], "label", "prediction")


@query("accuracy", f"with {RULED} select round(avg((label = prediction)::int), 10) as accuracy, count(*) as n from ruled")
def accuracy(spark, sf):
    return M.accuracy(cells(spark, sf)[1]).withColumn("accuracy", F.round("accuracy", 10))


@query("precision_by_label", f"with {RULED} select label, support, round(tp / called, 10) as precision from per")
def precision_by_label(spark, sf):
    return M.by_label(cells(spark, sf)[1]).select("label", "support", F.round("precision", 10).alias("precision"))


@query(
    "false_positive_rate_by_label",
    f"""with {RULED} select label, round((called - tp) / ((select sum(n)::bigint from cells) - support), 10) as false_positive_rate from per""",
)
def false_positive_rate_by_label(spark, sf):
    rates = M.by_label(cells(spark, sf)[1])
    return rates.select("label", F.round("false_positive_rate", 10).alias("false_positive_rate"))


@query("recall_by_label", f"with {RULED} select label, round(tp / support, 10) as recall from per")
def recall_by_label(spark, sf):
    return M.by_label(cells(spark, sf)[1]).select("label", F.round("recall", 10).alias("recall"))


@query(
    "f1_default_metric",
    f"with {RULED} select round(sum(2 * tp / (support + called) * support) / sum(support), 10) as f1 from per",
)
def f1_default_metric(spark, sf):
    return M.weighted_f1(cells(spark, sf)[1]).withColumn("f1", F.round("f1", 10))


@query(
    "precision_recall_by_threshold",
    """with s as (select l_extendedprice as score, count(*) as n, count(*) filter (l_returnflag = 'R') as pos from lineitem group by 1),
       c as (select score, sum(n) over w as called, sum(pos) over w as tp, sum(pos) over () as p from s window w as (order by score desc))
       select score as threshold, called::bigint as called, tp::bigint as tp, round(tp / called, 10) as precision, round(tp / p, 10) as recall from c""",
)
def precision_recall_by_threshold(spark, sf):
    items = table(spark, sf, "lineitem").select("l_extendedprice", "l_returnflag")
    curve = M.threshold_curve(items, "l_extendedprice", F.col("l_returnflag") == "R")
    return curve.withColumns({"precision": F.round("precision", 10), "recall": F.round("recall", 10)})


@query(
    "area_under_roc",
    """with r as (select l_returnflag = 'R' as y, rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0 as k from lineitem),
       s as (select sum(k) filter (y) as r, count(*) filter (y)::double as p, count(*) filter (not y)::double as q from r)
       select round((r - p * (p + 1) / 2) / (p * q), 10) as auc from s""",
)
def area_under_roc(spark, sf):
    items = table(spark, sf, "lineitem").select("l_extendedprice", "l_returnflag")
    auc = M.area_under_roc(items, "l_extendedprice", F.col("l_returnflag") == "R")
    return auc.withColumn("auc", F.round("auc", 10))


@query(
    "regression_metrics",
    """with p as (select l_returnflag, l_extendedprice as y, l_quantity * 2000 as f from lineitem)
       select l_returnflag, count(*) as n, round(avg(abs(y - f)), 4) as mae, round(avg((y - f) * (y - f)), 2) as mse,
              round(sqrt(avg((y - f) * (y - f))), 4) as rmse, round(1 - avg((y - f) * (y - f)) / var_pop(y), 8) as r2 from p group by 1""",
)
def regression_metrics(spark, sf):
    scored = table(spark, sf, "lineitem").withColumn("f", F.col("l_quantity") * 2000)
    m = M.regression_metrics(scored, "l_extendedprice", "f", ["l_returnflag"])
    places = {"mae": 4, "mse": 2, "rmse": 4, "r2": 8}
    return m.withColumns({c: F.round(c, d) for c, d in places.items()})


@query(
    "rating_agreement",
    """with r as (select substring(o_orderpriority, 1, 1)::int - least(1 + floor(o_totalprice / 100000), 5) as gap from orders)
       select round(100 * avg((gap = 0)::int), 8) as accuracy_pct, round(avg(gap * gap), 8) as mse, round(sqrt(avg(gap * gap)), 8) as rmse from r""",
)
def rating_agreement(spark, sf):
    rated = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("real"),
        F.least(F.lit(1) + F.floor(F.col("o_totalprice") / 100000), F.lit(5)).alias("scored"),
    )
    m = M.rating_agreement(rated, "real", "scored")
    return m.select(*[F.round(c, 8).alias(c) for c in m.columns])


ONE_PREDICTOR = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query(
    "compare_models",
    " union all ".join(
        f"""select model, round(avg(abs(e)), 3) as mae, round(sqrt(avg(e * e)), 3) as rmse, round(1 - avg(e * e) / var_pop(y), 8) as r2
            from (select '{x}' as model, l_extendedprice as y, l_extendedprice - (a + b * {x}) as e from lineitem,
                  (select regr_intercept(l_extendedprice, {x}) as a, regr_slope(l_extendedprice, {x}) as b from lineitem)) group by 1"""
        for x in ONE_PREDICTOR
    ),
)
def compare_models(spark, sf):
    items = table(spark, sf, "lineitem").select("l_extendedprice", *ONE_PREDICTOR)
    scored = {x: ols.predict(items, ols.fit(items, "l_extendedprice", [x]), [x]) for x in ONE_PREDICTOR}
    rows = M.compare_models(scored, "l_extendedprice")
    return rows.withColumns({"mae": F.round("mae", 3), "rmse": F.round("rmse", 3), "r2": F.round("r2", 8)})
