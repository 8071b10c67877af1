"""Demand series, forecasts, and forecast and classification metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from shopgrain.operators import demand, evaluate
from shopgrain.operators.checkpoints import materialise
from shopgrain.plans.registry import query
from shopgrain.plans.views import Views


def _text_date(df, *cols: str):
    """Dates as ISO text, which both engines hand over alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols or ("date",)})


@query("daily_demand", "SELECT category, strftime(date, '%Y-%m-%d') AS date, demand FROM daily", ["daily"])
def _(v: Views):
    return _text_date(v.daily)


@query("date_spine", "SELECT category, strftime(date, '%Y-%m-%d') AS date, demand FROM spine", ["spine"])
def _(v: Views):
    return _text_date(v.spine)


@query("calendar_features", """
SELECT category, strftime(date, '%Y-%m-%d') AS date, (isodow(date) - 1)::INTEGER AS day_of_week,
 day(date)::INTEGER AS day_of_month, month(date)::INTEGER AS month, (isodow(date) >= 6)::INTEGER AS is_weekend
FROM daily""", ["daily"])
def _(v: Views):
    return _text_date(demand.calendar(v.daily.drop("demand")))


@query("trend_index", """
SELECT category, strftime(date, '%Y-%m-%d') AS date, round(regr_intercept(demand, x) OVER w
 + regr_slope(demand, x) OVER w * x, 4) AS trend
FROM (SELECT *, (date - DATE '1970-01-01')::DOUBLE AS x FROM spine) WINDOW w AS (PARTITION BY category)""", ["spine"])
def _(v: Views):
    fitted = demand.trend(v.spine).withColumn("trend", F.round("trend", 4))
    return _text_date(fitted.select("category", "date", "trend"))


@query("sort_by_date", """
SELECT category, strftime(date, '%Y-%m-%d') AS date, row_number() OVER (PARTITION BY category ORDER BY date)::INTEGER AS pos
FROM daily""", ["daily"])
def _(v: Views):
    return _text_date(demand.in_order(v.daily).select("category", "date", "pos"))


_SCALED = """
SELECT category, date, CASE WHEN hi = lo THEN 0 ELSE (demand - lo) / (hi - lo) END AS demand_scaled,
 (isodow(date) - 1) / 6 AS dow_scaled, (isodow(date) >= 6)::INTEGER::DOUBLE AS weekend, month(date) / 12 AS month_scaled
FROM spine JOIN (SELECT category, min(demand) AS lo, max(demand) AS hi FROM spine GROUP BY 1) USING (category)"""


@query("scaled_features", f"""
SELECT category, strftime(date, '%Y-%m-%d') AS date, round(demand_scaled, 6) AS demand_scaled,
 round(dow_scaled, 6) AS dow_scaled, weekend, round(month_scaled, 6) AS month_scaled FROM ({_SCALED})""", ["spine"])
def _(v: Views):
    rows = demand.scaled_features(v.spine)
    return _text_date(
        rows.select(
            "category", "date", F.round("demand_scaled", 6).alias("demand_scaled"),
            F.round("dow_scaled", 6).alias("dow_scaled"), "weekend",
            F.round("month_scaled", 6).alias("month_scaled"),
        )
    )


@query("top_categories", """
SELECT product_idx, brand FROM products SEMI JOIN (SELECT brand FROM products GROUP BY 1
 ORDER BY count(*) DESC, brand LIMIT 10) USING (brand)""", ["products"])
def _(v: Views):
    return demand.top_categories(v.products, 10, "brand").select("product_idx", "brand")


@query("demand_summary", """
SELECT category, floor(avg(demand))::BIGINT AS avg_daily_demand, max(demand) AS peak_demand,
 strftime(arg_max(date, demand * 1000000 - (date - DATE '1970-01-01')), '%Y-%m-%d') AS peak_day, sum(demand) AS total,
 CASE WHEN arg_max(demand, date) > arg_min(demand, date) THEN 'increasing' ELSE 'decreasing' END AS trend
FROM spine GROUP BY 1""", ["spine"])
def _(v: Views):
    return _text_date(demand.demand_summary(v.spine), "peak_day")


@query("argmax_day", """
SELECT category, demand AS peak_demand, strftime(date, '%Y-%m-%d') AS peak_day FROM event_demand
QUALIFY row_number() OVER (PARTITION BY category ORDER BY demand DESC, date) = 1""", ["event_demand"])
def _(v: Views):
    return _text_date(demand.argmax_day(v.event_demand), "peak_day")


@query("base_demand", """
SELECT category, greatest(1, floor(count(*) / 30))::BIGINT AS base_demand FROM products GROUP BY 1""", ["products"])
def _(v: Views):
    return demand.base_demand(v.products)


@query("sliding_sequences", f"""
WITH s AS ({_SCALED}), w AS (SELECT category, date,
 list([demand_scaled, dow_scaled, weekend, month_scaled]) OVER a AS x, list(demand_scaled) OVER b AS y FROM s
 WINDOW a AS (PARTITION BY category ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY category ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING))
SELECT category, strftime(date, '%Y-%m-%d') AS date, len(x)::BIGINT AS n_x, len(y)::BIGINT AS n_y,
 round(list_sum(list_transform(x, lambda r: r[1] + 2 * r[2] + 3 * r[3] + 4 * r[4])), 5) AS x_sum,
 round(x[1][1], 6) AS x_first, round(x[30][1], 6) AS x_last, round(y[1], 6) AS y_first, round(y[7], 6) AS y_last
FROM w WHERE len(x) = 30 AND len(y) = 7""", ["spine"])
def _(v: Views):
    cols = ["demand_scaled", "dow_scaled", "weekend", "month_scaled"]
    rows = demand.sequences(demand.scaled_features(v.spine), cols, "demand_scaled")
    flat = F.transform("x", lambda r: r[0] + 2 * r[1] + 3 * r[2] + 4 * r[3])
    return _text_date(
        rows.select(
            "category", "date",
            F.size("x").cast("bigint").alias("n_x"), F.size("y").cast("bigint").alias("n_y"),
            F.round(F.aggregate(flat, F.lit(0.0), lambda a, b: a + b), 5).alias("x_sum"),
            F.round(F.col("x")[0][0], 6).alias("x_first"), F.round(F.col("x")[29][0], 6).alias("x_last"),
            F.round(F.col("y")[0], 6).alias("y_first"), F.round(F.col("y")[6], 6).alias("y_last"),
        )
    )


@query("naive_forecast", f"""
WITH s AS ({_SCALED}) SELECT category, strftime(date, '%Y-%m-%d') AS date, step::INTEGER AS step,
 round(demand_scaled, 6) AS forecast FROM (SELECT *, unnest(range(1, 8)) AS step,
  row_number() OVER (PARTITION BY category ORDER BY date) AS rn, count(*) OVER (PARTITION BY category) AS n FROM s)
WHERE rn >= 30 AND rn <= n - 7""", ["spine"])
def _(v: Views):
    windows = demand.sequences(demand.scaled_features(v.spine), ["demand_scaled"], "demand_scaled")
    rows = demand.naive(windows).select("category", "date", F.posexplode("yhat").alias("step", "forecast"))
    return _text_date(
        rows.select("category", "date", (F.col("step") + 1).alias("step"), F.round("forecast", 6).alias("forecast"))
    )


@query("seasonal_naive", """
SELECT category, strftime(date, '%Y-%m-%d') AS date, demand, lag(demand, 7) OVER (PARTITION BY category ORDER BY date) AS forecast
FROM spine""", ["spine"])
def _(v: Views):
    return _text_date(demand.seasonal_naive(v.spine))


@query("moving_average_forecast", """
SELECT category, strftime(date, '%Y-%m-%d') AS date, demand, CASE WHEN row_number() OVER w > 7
 THEN round(avg(demand) OVER (PARTITION BY category ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) END AS forecast
FROM spine WINDOW w AS (PARTITION BY category ORDER BY date)""", ["spine"])
def _(v: Views):
    rows = demand.moving_average(v.spine)
    return _text_date(rows.withColumn("forecast", F.round("forecast", 6)))


# The normal equations of each step ahead, solved by elimination.
_REGRESSION = f"""
lagged AS (SELECT category, date, demand_scaled, dow_scaled, weekend, month_scaled,
 list(demand_scaled) OVER (PARTITION BY category ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS back,
 list(demand_scaled) OVER (PARTITION BY category ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS ahead
 FROM ({_SCALED})),
inputs AS (SELECT category, date, list_concat([1.0::DOUBLE], list_reverse(back), [dow_scaled, weekend, month_scaled]) AS u,
 ahead FROM lagged WHERE len(back) = 7),
cut AS (SELECT (DATE '1970-01-01' + floor(epoch(min(date)) / 86400 + (epoch(max(date)) - epoch(min(date))) / 86400 * 0.7)::INTEGER)
 AS day FROM inputs),
train AS (SELECT h, list_append(u, ahead[h]) AS e FROM (SELECT *, unnest(range(1, 8)) AS h FROM inputs, cut WHERE date <= day)
 WHERE ahead[h] IS NOT NULL),
gram AS (SELECT h, i, j, sum(e[i] * e[j]) + CASE WHEN i = j AND i > 1 THEN 1e-4 * count(*) ELSE 0 END AS v
 FROM train, (SELECT unnest(range(1, 12)) AS i), (SELECT unnest(range(1, 13)) AS j) GROUP BY h, i, j),
system AS (SELECT h, list(r ORDER BY i) AS m FROM (SELECT h, i, list(v ORDER BY j) AS r FROM gram GROUP BY ALL) GROUP BY 1),
solved AS (
 SELECT h, 1 AS k, m FROM system
 UNION ALL
 SELECT h, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
  ELSE list_transform(r, lambda x, j: x - r[k] / m[k][k] * m[k][j]) END) FROM solved WHERE k <= 11),
regressed AS (SELECT category, date, h AS step, ahead[h] AS actual,
 list_dot_product(u, list_transform(m, lambda r: r[12])) AS forecast
 FROM inputs, cut, solved WHERE k = 12 AND date > day AND ahead[h] IS NOT NULL)"""


@query("lag_regression_forecast", f"""
WITH RECURSIVE {_REGRESSION} SELECT category, strftime(date, '%Y-%m-%d') AS date, step::INTEGER AS step, round(actual, 6) AS actual,
 round(forecast, 6) AS forecast FROM regressed""", ["spine"])
def _(v: Views):
    rows = demand.lag_regression(demand.scaled_features(v.spine))
    return _text_date(rows.withColumn("actual", F.round("actual", 6)).withColumn("forecast", F.round("forecast", 6)))


def model_forecasts(v: Views):
    """Seven-day forecasts of three simple models and the regression, on the windows of its test days."""
    scaled = demand.scaled_features(v.spine)
    fitted = materialise(demand.whole_horizon(demand.lag_regression(scaled)), "regression")
    windows = demand.sequences(scaled, ["demand_scaled"], "demand_scaled")
    windows = windows.join(fitted.select("category", "date"), ["category", "date"], "left_semi")
    past = F.transform("x", lambda r: r[0])
    mean = F.aggregate(F.slice(past, -7, 7), F.lit(0.0), lambda a, b: a + b) / 7
    models = {
        "naive": demand.naive(windows).select("y", "yhat"),
        "seasonal": windows.select("y", F.slice(past, -7, 7).alias("yhat")),
        "mean": windows.select("y", F.array_repeat(mean, 7).alias("yhat")),
        "regression": fitted.join(windows.select("category", "date"), ["category", "date"], "left_semi").select("y", "yhat"),
    }
    parts = [df.withColumn("model", F.lit(name)) for name, df in models.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


_FORECASTS = f"""{_REGRESSION},
s AS ({_SCALED}), w AS (SELECT category, date, list(demand_scaled) OVER a AS x, list(demand_scaled) OVER b AS y FROM s
 WINDOW a AS (PARTITION BY category ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY category ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING)),
ok AS (SELECT w.* FROM w, cut WHERE len(x) = 30 AND len(y) = 7 AND date > day),
fitted AS (SELECT category, date, list(forecast ORDER BY step) AS yhat FROM regressed GROUP BY ALL),
f AS (SELECT 'naive' AS model, y, list_transform(y, lambda q: x[30]) AS yhat FROM ok
 UNION ALL SELECT 'seasonal', y, x[24:30] FROM ok
 UNION ALL SELECT 'mean', y, list_transform(y, lambda q: list_avg(x[24:30])) FROM ok
 UNION ALL SELECT 'regression', y, yhat FROM ok JOIN fitted USING (category, date)),
e AS (SELECT model, y[i] AS a, yhat[i] AS b, sign(y[7] - y[1]) = sign(yhat[7] - yhat[1]) AS dir
 FROM (SELECT *, unnest(range(1, 8)) AS i FROM f)),
metrics AS (SELECT model, avg(abs(a - b)) AS mae, sqrt(avg((a - b) * (a - b))) AS rmse,
 avg(abs((b - a) / (a + 1e-8))) * 100 AS mape,
 avg(CASE WHEN abs(a) + abs(b) = 0 THEN 0 ELSE 2 * abs(a - b) / (abs(a) + abs(b)) END) * 100 AS smape,
 sum(abs(a - b)) / sum(abs(a)) * 100 AS wape, avg(dir::INTEGER) AS dir_acc FROM e GROUP BY 1)"""


@query("forecast_metrics", f"""
WITH RECURSIVE {_FORECASTS} SELECT model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(mape, 2) AS mape,
 round(smape, 4) AS smape, round(wape, 4) AS wape, round(dir_acc, 6) AS dir_acc FROM metrics""", ["spine"])
def _(v: Views):
    m = evaluate.forecast_metrics(model_forecasts(v))
    digits = {"mae": 6, "rmse": 6, "mape": 2, "smape": 4, "wape": 4, "dir_acc": 6}
    return m.select("model", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query("best_model", f"""
WITH RECURSIVE {_FORECASTS}, base AS (SELECT mae AS baseline_mae FROM metrics WHERE model = 'naive')
SELECT model AS best_model, round(mae, 6) AS mae, round(baseline_mae, 6) AS baseline_mae,
 round((baseline_mae - mae) / baseline_mae * 100, 4) AS improvement_pct
FROM metrics, base WHERE model <> 'naive' ORDER BY metrics.mae LIMIT 1""", ["spine"])
def _(v: Views):
    best = evaluate.best_model(evaluate.forecast_metrics(model_forecasts(v)), "naive")
    return best.select(
        "best_model", F.round("mae", 6).alias("mae"), F.round("baseline_mae", 6).alias("baseline_mae"),
        F.round("improvement_pct", 4).alias("improvement_pct"),
    )


def judged(v: Views):
    """Recorded document quality against a rule on length, as class names."""
    rows = v.table("labels").join(v.table("documents").select("doc_id", "n_chars", "lang"), "doc_id")
    truth = F.when(F.col("quality") == 1, "good").otherwise("poor")
    said = F.when(F.col("n_chars") >= 900, "good").when(F.col("n_chars") < 150, "short").otherwise("poor")
    return rows.select("doc_id", truth.alias("truth"), said.alias("said"))


@query("classification_metrics", """
WITH j AS (SELECT CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS truth, CASE WHEN n_chars >= 900 THEN 'good'
  WHEN n_chars < 150 THEN 'short' ELSE 'poor' END AS said FROM labels JOIN documents USING (doc_id)),
c AS (SELECT class, (SELECT count(*) FROM j WHERE truth = class AND said = class) AS tp,
 (SELECT count(*) FROM j WHERE truth = class) AS t, (SELECT count(*) FROM j WHERE said = class) AS s
 FROM (SELECT truth AS class FROM j UNION SELECT said FROM j)),
f AS (SELECT *, coalesce(2 * tp / nullif(t + s, 0), 0) AS f1 FROM c)
SELECT 'f1' AS metric, class, round(f1, 6) AS value FROM f
UNION ALL SELECT 'accuracy', '', round(sum(tp) / sum(t), 6) FROM f
UNION ALL SELECT 'macro_f1', '', round(avg(f1), 6) FROM f
UNION ALL SELECT 'weighted_f1', '', round(sum(f1 * t) / sum(t), 6) FROM f""")
def _(v: Views):
    m = evaluate.classification_metrics(judged(v), "truth", "said")
    return m.withColumn("value", F.round("value", 6))


@query("label_index", """
SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS label_idx FROM (SELECT DISTINCT p_brand FROM part)""")
def _(v: Views):
    return evaluate.label_index(v.table("part"), "p_brand")
