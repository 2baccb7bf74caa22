"""Tests and forecasts over daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import arma as A
from ..operators import daily as D
from ..operators import metrics as M
from ..operators import stationarity as S
from ..operators import var as V
from ..runtime import table
from .registry import query
from .windows import DAILY, EVENT_DAYS, event_days, order_days

# Percentage change, steadied by the signed cube root, for both value columns.
STEADY = (
    DAILY
    + """, raw as (select series_id, t, y, y2, lag(y) over w as py, lag(y2) over w as py2 from daily window w as (partition by series_id order by t)),
steady as (select series_id, t, cbrt(100 * (y / py - 1)) as y, cbrt(100 * (y2 / py2 - 1)) as y2,
                  row_number() over (partition by series_id order by t) as i, count(*) over (partition by series_id) as n from raw where py is not null)"""
)


def steady_days(spark, sf):
    days = order_days(spark, sf)
    before = {c: F.lag(c).over(D.along()) for c in ("y", "y2")}
    changed = days.select(
        "series_id",
        "t",
        F.row_number().over(D.along()).alias("_i"),
        *[F.cbrt(100 * (F.col(c) / before[c] - 1)).alias(c) for c in ("y", "y2")],
    )
    return changed.where("_i > 1").drop("_i")


@query(
    "daily_series",
    f"""with {EVENT_DAYS}, days as (select series_id, unnest(generate_series(min(t)::timestamp, max(t)::timestamp, interval 1 day))::date as t from evd group by 1)
        select series_id, t, coalesce(y, 0.0) as y, coalesce(y2, 0.0) as y2 from days left join evd using (series_id, t)
        union all select 'orders', cast(o_orderdate as date), count(*)::double, round(sum(o_totalprice), 2) from orders group by 2""",
    text=("t",),
)
def daily_series(spark, sf):
    orders = D.daily_series(
        table(spark, sf, "orders"),
        F.lit("orders"),
        F.col("o_orderdate"),
        y=F.count(F.lit(1)).cast("double"),
        y2=F.round(F.sum("o_totalprice"), 2),
    )
    return D.fill_calendar(event_days(spark, sf)).unionByName(orders)


ACF = """
lags as (select unnest(range(0, 11)) as lag),
c as (select series_id, row_number() over (partition by series_id order by t) as i, y - avg(y) over (partition by series_id) as d from {source}),
r as (select a.series_id, lag, sum(a.d * b.d) as s from c a, lags, c b where a.series_id = b.series_id and b.i = a.i - lag group by 1, 2),
acf as (select series_id, lag, s / max(s) filter (lag = 0) over (partition by series_id) as acf, (select count(*) from c where c.series_id = r.series_id) as n from r)
"""


@query("acf", f"with {DAILY}, {ACF.format(source='daily')} select series_id, lag::int as lag, round(acf, 8) + 0.0 as acf, n from acf")
def acf(spark, sf):
    return S.acf(order_days(spark, sf), "y", 10).withColumn("acf", F.round("acf", 8) + 0.0)


@query(
    "pacf",
    f"""with recursive {DAILY}, {ACF.format(source='daily')},
        rr as (select series_id, list(acf order by lag) as r from acf group by 1),
        dl as (select series_id, r, 1 as k, [r[2]] as phi, r[2] as last from rr
               union all
               select series_id, r, k + 1,
                      list_append(list_transform(range(1, k + 1), lambda j: phi[j] - nxt * phi[k + 1 - j]), nxt), nxt
               from (select *, (r[k + 2] - list_dot_product(phi, list_reverse(r[2 : k + 1]))) / (1 - list_dot_product(phi, r[2 : k + 1])) as nxt
                     from dl where k < 10))
        select series_id, 0 as lag, 1.0::double as pacf from rr
        union all select series_id, k::int, round(last, 8) + 0.0 from dl""",
)
def pacf(spark, sf):
    return S.pacf(order_days(spark, sf), "y", 10).withColumn("pacf", F.round("pacf", 8) + 0.0)


@query("adf_test")
def adf_test(spark, sf):
    return S.adf_test(order_days(spark, sf), "y", 5)


@query("adf_test_of_changes")
def adf_test_of_changes(spark, sf):
    return S.adf_test(steady_days(spark, sf), "y", 5)


KPSS = """
k as (select series_id, t, y - avg(y) over (partition by series_id) as r, row_number() over (partition by series_id order by t) as i,
             count(*) over (partition by series_id) as n from {source}),
eta as (select series_id, any_value(n) as n, sum(c * c) as eta from (select *, sum(r) over (partition by series_id order by t) as c from k) group by 1),
prod as (select a.series_id, lag, sum(a.r * b.r) as s from k a, (select unnest(range(0, 200)) as lag), k b
         where a.series_id = b.series_id and b.i = a.i - lag group by 1, 2),
few as (select series_id, any_value(n) as n, sum(s * case when lag = 0 then 1 else 2 end / n) as s0, sum(lag * 2 * s / n) as s1
        from prod join eta using (series_id) where lag <= floor(pow(n, 2 / 9.0::double)) group by 1),
band as (select series_id, n, floor(1.1447::double * pow(pow(s1 / s0, 2), 1 / 3.0::double) * pow(n, 1 / 3.0::double))::int as lags from few),
var as (select series_id, any_value(b.n) as n, any_value(lags) as lags, sum(case when lag = 0 then s else 2 * s * (1 - lag / (lags + 1.0::double)) end) / any_value(b.n) as v
        from prod join band b using (series_id) where lag <= lags group by 1),
kpss as (select series_id, var.n, lags, eta / (var.n * var.n) / v as statistic from var join eta using (series_id)),
kpss_p as (select *, case when statistic <= 0.347 then 0.10 when statistic < 0.463 then 0.10 + (statistic - 0.347) * (-0.05 / 0.116)
                          when statistic < 0.574 then 0.05 + (statistic - 0.463) * (-0.025 / 0.111)
                          when statistic < 0.739 then 0.025 + (statistic - 0.574) * (-0.015 / 0.165) else 0.01 end::double as p_value from kpss)
"""


@query(
    "kpss_test",
    f"with {STEADY}, {KPSS.format(source='daily')} select series_id, n, lags, round(statistic, 8) as statistic, round(p_value, 6) as p_value from kpss_p",
)
def kpss_test(spark, sf):
    k = S.kpss_test(order_days(spark, sf), "y")
    return k.withColumns({"statistic": F.round("statistic", 8), "p_value": F.round("p_value", 6)})


@query(
    "stationarity_decision",
    f"""with {STEADY}, {KPSS.format(source='steady')} select series_id, round(p_value, 6) as kpss_p,
        case when p_value < 0.05 then 'not stationary' else 'stationary' end as kpss from kpss_p""",
)
def stationarity_decision(spark, sf):
    decided = S.stationarity_decision(None, S.kpss_test(steady_days(spark, sf), "y"))
    return decided.withColumn("kpss_p", F.round("kpss_p", 6))


@query("stationarity_both_tests")
def stationarity_both_tests(spark, sf):
    days = order_days(spark, sf)
    return S.stationarity_decision(S.adf_test(days, "y"), S.kpss_test(days, "y"))


def train_part(daily):
    return D.chrono_split(daily, 0.8).where("part = 'train'").drop("part")


@query("arma_order_select")
def arma_order_select(spark, sf):
    return A.select_order(train_part(steady_days(spark, sf)), "y", 4, 4)


@query("arma_fit")
def arma_fit(spark, sf):
    return A.fit_arma(train_part(steady_days(spark, sf)), "y", [(2, 3), (0, 1)])


@query("arma_residual_checks")
def arma_residual_checks(spark, sf):
    rest = A.residuals(train_part(steady_days(spark, sf)), "y", 0, 1)
    white = S.ljung_box(rest, "residual", 10, 1).where("lag = 10").select("series_id", "lb_stat", "lb_p")
    steady = S.break_variance(rest, "residual").select("series_id", F.col("p_value").alias("break_p"))
    normal = S.jarque_bera(rest, "residual").select("series_id", F.col("p_value").alias("jb_p"))
    return white.join(steady, "series_id").join(normal, "series_id")


@query(
    "ljung_box",
    f"""with {STEADY}, {ACF.format(source='steady')} select series_id, lag::int as lag,
        round(n * (n + 2) * sum(acf * acf / (n - lag)) over (partition by series_id order by lag), 5) as lb_stat,
        round(n * sum(acf * acf) over (partition by series_id order by lag), 5) as bp_stat from acf where lag > 0""",
)
def ljung_box(spark, sf):
    q = S.ljung_box(steady_days(spark, sf), "y", 10, p_values=False)
    return q.withColumns({"lb_stat": F.round("lb_stat", 5), "bp_stat": F.round("bp_stat", 5)})


@query(
    "break_variance_test",
    f"""with {STEADY}, h as (select *, round_even(n * (1 / 3.0::double), 0) as h from steady)
        select series_id, max(h)::int as h, round(sum(y * y) filter (i > n - h) / sum(y * y) filter (i <= h), 8) as statistic from h group by 1""",
)
def break_variance_test(spark, sf):
    b = S.break_variance(steady_days(spark, sf), "y", p_values=False)
    return b.withColumn("statistic", F.round("statistic", 8))


@query(
    "jarque_bera",
    f"""with {STEADY}, d as (select series_id, y - avg(y) over (partition by series_id) as d from steady),
        m as (select series_id, count(*) as n, avg(d * d) as m2, avg(pow(d, 3)) as m3, avg(pow(d, 4)) as m4 from d group by 1),
        s as (select series_id, n, m3 / pow(m2, 1.5) as skew, m4 / (m2 * m2) as kurtosis from m),
        j as (select *, n / 6.0::double * (skew * skew + pow(kurtosis - 3, 2) / 4) as statistic from s)
        select series_id, n, round(skew, 8) + 0.0 as skew, round(kurtosis, 8) as kurtosis, round(statistic, 5) as statistic, round(exp(-statistic / 2), 8) as p_value from j""",
)
def jarque_bera(spark, sf):
    j = S.jarque_bera(steady_days(spark, sf), "y")
    places = {"skew": 8, "kurtosis": 8, "statistic": 5, "p_value": 8}
    return j.withColumns({c: F.round(c, d) + 0.0 for c, d in places.items()})


@query("rolling_forecast")
def rolling_forecast(spark, sf):
    rolled = A.rolling_forecast(steady_days(spark, sf), "y", 0, 1)
    return M.regression_metrics(rolled, "y", "forecast", ["series_id"]).drop("r2")


@query(
    "rolling_forecast_ar",
    f"""with {STEADY}, p as (select *, lag(y) over (partition by series_id order by t) as x from steady),
        r as (select *, regr_slope(y, x) over w as b, regr_intercept(y, x) over w as a from p
              window w as (partition by series_id order by t rows between unbounded preceding and 1 preceding)),
        e as (select series_id, y - (a + b * x) as e from r where i > round_even(0.8::double * n, 0))
        select series_id, count(*) as n, round(sqrt(avg(e * e)), 8) as rmse from e group by 1""",
)
def rolling_forecast_ar(spark, sf):
    days = steady_days(spark, sf)
    forecasts = D.expanding_ar1(days, "y").select("series_id", "t", "y", "forecast")
    test = D.chrono_split(forecasts, 0.8).where("part = 'test'")
    m = M.regression_metrics(test, "y", "forecast", ["series_id"])
    return m.select("series_id", "n", F.round("rmse", 8).alias("rmse"))


@query("var_select_order")
def var_select_order(spark, sf):
    return V.select_order(steady_days(spark, sf), 10)


# Two-predictor normal equations from co-moments.
VAR1 = """
lagged as (select *, lag(y) over (partition by series_id order by t) as a, lag(y2) over (partition by series_id order by t) as b from {source}),
long as (select series_id, 'y' as equation, y as z, a, b from lagged where {rows} a is not null
         union all select series_id, 'y2', y2, a, b from lagged where {rows} a is not null),
mom as (select series_id, equation, count(*) as n, avg(z) as mz, avg(a) as ma, avg(b) as mb, var_pop(a) as aa, var_pop(b) as bb,
               covar_pop(a, b) as ab, covar_pop(a, z) as az, covar_pop(b, z) as bz from long group by 1, 2),
var1 as (select *, (az * bb - bz * ab) / (aa * bb - ab * ab) as ca, (bz * aa - az * ab) / (aa * bb - ab * ab) as cb from mom)
"""


@query(
    "var_fit",
    f"""with {STEADY}, {VAR1.format(source='steady', rows='')} select series_id, equation, n, round(mz - ca * ma - cb * mb, 7) + 0.0 as const,
        round(ca, 7) + 0.0 as y_l1, round(cb, 7) + 0.0 as y2_l1 from var1""",
)
def var_fit(spark, sf):
    model = V.fit_var(steady_days(spark, sf), 1)
    named = [F.get("coef", F.lit(i)).alias(c) for i, c in enumerate(V.lag_names(1))]
    wide = model.select("series_id", "equation", "n", "const", *named)
    return wide.withColumns({c: F.round(c, 7) + 0.0 for c in ("const", "y_l1", "y2_l1")})


@query("var_fit_two_lags")
def var_fit_two_lags(spark, sf):
    return V.fit_var(steady_days(spark, sf), 2)


@query(
    "var_forecast_fixed",
    f"""with {STEADY}, cut as (select *, i > n - round_even(0.2::double * n, 0) as test from steady), {VAR1.format(source='cut', rows='not test and')},
        f as (select l.series_id, equation, case when equation = 'y' then l.y else l.y2 end - (mz + ca * (l.a - ma) + cb * (l.b - mb)) as e
              from lagged l join var1 using (series_id) where test)
        select series_id, round(sqrt(avg(e * e) filter (equation = 'y')), 7) as rmse_y, round(sqrt(avg(e * e) filter (equation = 'y2')), 7) as rmse_y2 from f group by 1""",
)
def var_forecast_fixed(spark, sf):
    fixed = V.rmse(V.forecast_fixed(steady_days(spark, sf), 1))
    return fixed.withColumns({"rmse_y": F.round("rmse_y", 7), "rmse_y2": F.round("rmse_y2", 7)})


@query("var_forecast_fixed_by_lags")
def var_forecast_fixed_by_lags(spark, sf):
    """Errors of both columns for one and two lags."""
    days = steady_days(spark, sf)
    tables = [V.rmse(V.forecast_fixed(days, p)).withColumn("lags", F.lit(p)) for p in (1, 2)]
    return tables[0].unionByName(tables[1])


@query("var_forecast_rolling")
def var_forecast_rolling(spark, sf):
    return V.rmse(V.forecast_rolling(steady_days(spark, sf), 2))
