"""Daily demand per category: aggregation, spine, features, windows and forecasts.

Facts are summed per category and day before anything else, so a series has at most
one row per calendar day and windows over a category stay small whatever the volume.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.operators.checkpoints import materialise
from shopgrain.operators.features import minmax


def _series(by: str, order: str = "date") -> Window:
    return Window.partitionBy(by).orderBy(order)


def daily_demand(facts: DataFrame, date: str, category: str, qty: str | Column) -> DataFrame:
    """Sum per category and day."""
    amount = F.col(qty) if isinstance(qty, str) else qty
    return facts.groupBy(
        F.col(category).alias("category"), F.to_date(F.col(date)).alias("date")
    ).agg(F.sum(amount).cast("double").alias("demand"))


def date_spine(df: DataFrame, value: str = "demand") -> DataFrame:
    """Every day of the whole range for every category, missing days as 0."""
    first, last = df.agg(F.min("date")).scalar(), df.agg(F.max("date")).scalar()
    days = df.select("category").distinct().select(
        "category", F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date")
    )
    return days.join(df, ["category", "date"], "left").withColumn(
        value, F.coalesce(value, F.lit(0.0))
    )


def calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Day of week (Monday 0), day of month, month, weekend flag."""
    d = F.col(date)
    return df.withColumns(
        {
            "day_of_week": F.weekday(d),
            "day_of_month": F.dayofmonth(d),
            "month": F.month(d),
            "is_weekend": (F.weekday(d) >= 5).cast("int"),
        }
    )


def trend(df: DataFrame, value: str = "demand") -> DataFrame:
    """Fitted straight line per category as a column."""
    day = F.unix_date("date").cast("double")
    fit = df.groupBy("category").agg(
        F.regr_slope(F.col(value), day).alias("_slope"),
        F.regr_intercept(F.col(value), day).alias("_intercept"),
    )
    return (
        df.join(fit, "category")
        .withColumn("trend", F.col("_intercept") + F.col("_slope") * day)
        .drop("_slope", "_intercept")
    )


def scaled_features(df: DataFrame) -> DataFrame:
    """Demand scaled per category, and calendar features in 0..1."""
    scaled = minmax(calendar(df), ["demand"], by="category")
    return scaled.withColumns(
        {
            "dow_scaled": F.col("day_of_week") / 6.0,
            "weekend": F.col("is_weekend").cast("double"),
            "month_scaled": F.col("month") / 12.0,
        }
    )


def top_categories(df: DataFrame, n: int = 10, col: str = "category") -> DataFrame:
    """Rows of the n most frequent categories."""
    best = df.groupBy(col).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), col).limit(n)
    return df.join(best.select(col), col, "left_semi")


def in_order(df: DataFrame) -> DataFrame:
    """Position of each row in its series, from 1."""
    return df.withColumn("pos", F.row_number().over(_series("category")))


def sequences(
    df: DataFrame, features: Sequence[str], target: str, seq_len: int = 30, horizon: int = 7
) -> DataFrame:
    """Sliding windows: the last ``seq_len`` rows of features, the next ``horizon`` targets.

    Series shorter than both together give no row.
    """
    w = _series("category")
    row = F.array(*[F.col(f).cast("double") for f in features])
    return (
        df.select(
            "category", "date",
            F.collect_list(row).over(w.rowsBetween(-(seq_len - 1), 0)).alias("x"),
            F.collect_list(F.col(target)).over(w.rowsBetween(1, horizon)).alias("y"),
        )
        .where((F.size("x") == seq_len) & (F.size("y") == horizon))
    )


def naive(windows: DataFrame, horizon: int = 7) -> DataFrame:
    """Last seen target (first feature) repeated over the horizon."""
    last = F.element_at(F.element_at("x", -1), 1)
    return windows.withColumn("yhat", F.array_repeat(last, horizon))


def seasonal_naive(df: DataFrame, value: str = "demand", period: int = 7) -> DataFrame:
    """Value one period earlier in the same series."""
    return df.withColumn("forecast", F.lag(value, period).over(_series("category")))


def moving_average(df: DataFrame, value: str = "demand", width: int = 7) -> DataFrame:
    """Mean of the ``width`` rows before the current one; null until there are enough."""
    w = _series("category").rowsBetween(-width, -1)
    enough = F.count(value).over(w) == width
    return df.withColumn("forecast", F.when(enough, F.avg(value).over(w)))


def demand_summary(df: DataFrame, value: str = "demand") -> DataFrame:
    """Mean, peak and its first day, total and direction per category."""
    v, day = F.col(value), F.col("date")
    peak = F.max(F.struct(v.alias("v"), (-F.unix_date(day)).alias("d")))
    return df.groupBy("category").agg(
        F.floor(F.avg(v)).cast("bigint").alias("avg_daily_demand"),
        F.max(v).alias("peak_demand"),
        F.date_from_unix_date(-peak["d"]).alias("peak_day"),
        F.sum(v).alias("total"),
        F.when(F.max_by(v, day) > F.min_by(v, day), "increasing").otherwise("decreasing").alias("trend"),
    )


def argmax_day(df: DataFrame, value: str = "demand") -> DataFrame:
    """Peak value and its first day per category."""
    return demand_summary(df, value).select("category", "peak_demand", "peak_day")


def base_demand(df: DataFrame, col: str = "category") -> DataFrame:
    """Rows per category over 30 days, at least 1."""
    n = F.count("*")
    return df.groupBy(col).agg(F.greatest(F.lit(1), F.floor(n / 30)).cast("bigint").alias("base_demand"))


#: Weight of the squared coefficients against a squared error, per training row.
RIDGE = 1e-4


def _normal_equations(rows: DataFrame, inputs: int, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """For each step ahead the sums of cross products of inputs ``u`` with inputs and target, and the rows.

    One pass: every task adds up its rows for all steps, and the sums of tasks are added by Spark; what
    reaches the driver is as large as the model. A step counts the rows that know its target.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((horizon, inputs, inputs + 1))
        n = np.zeros(horizon, np.int64)
        for batch in batches:
            u = np.array(batch.column(0).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, inputs)
            y = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, horizon)
            for h in range(horizon):
                known = ~np.isnan(y[:, h])
                x = u[known]
                total[h] += x.T @ np.column_stack((x, y[known, h]))
                n[h] += len(x)
        at = [(h, i) for h in range(horizon) for i in range(inputs)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _ in at], pa.int32()), pa.array([i for _, i in at], pa.int32()),
                pa.array([int(n[h]) for h, _ in at], pa.int64()),
                pa.array([total[h, i].tolist() for h, i in at], pa.list_(pa.float64())),
            ],
            ["h", "i", "n", "x"],
        )

    parts = rows.select("u", "y").mapInArrow(partial, "h int, i int, n long, x array<double>")
    sums = parts.groupBy("h", "i").agg(F.sum("n"), *(F.sum(F.col("x")[j]) for j in range(inputs + 1))).collect()
    total, n = np.zeros((horizon, inputs, inputs + 1)), np.zeros(horizon)
    for h, i, rows_, *x in sums:
        total[h, i], n[h] = x, rows_
    return total, n


def _coefficients(total: np.ndarray, n: np.ndarray) -> list[list[float]]:
    """Least squares with a small weight on all coefficients but the first, the constant."""
    weight = np.eye(total.shape[1])
    weight[0, 0] = 0
    return [
        np.linalg.lstsq(g[:, :-1] + RIDGE * rows * weight, g[:, -1], rcond=None)[0].tolist()
        for g, rows in zip(total, n, strict=True)
    ]


def lag_regression(
    df: DataFrame, value: str = "demand_scaled", lags: int = 7, horizon: int = 7,
    calendar_features: Sequence[str] = ("dow_scaled", "weekend", "month_scaled"),
    test_share: float = 0.3,
) -> DataFrame:
    """Direct linear forecasts from lags and calendar, one model per step ahead, all fitted in one pass.

    Trained on the early part of the calendar, returned for the late part:
    (category, date, step, actual, forecast). Rows without all lags or calendar features are left out.
    """
    w = _series("category")
    names = [f"lag{i}" for i in range(lags)]
    rows = df.withColumns({n: F.lag(value, i).over(w) for i, n in enumerate(names)})
    ahead = F.array(*(F.lead(value, h).over(w).cast("double") for h in range(1, horizon + 1)))
    inputs = [F.lit(1.0), *(F.col(c).cast("double") for c in (*names, *calendar_features))]
    rows = rows.withColumn("y", ahead).dropna(subset=[*names, *calendar_features])
    rows = materialise(rows.select("category", "date", F.array(*inputs).alias("u"), "y"), "lags")
    first, last = F.unix_date(F.min("date")), F.unix_date(F.max("date"))
    cut = rows.agg(F.date_from_unix_date((first + (last - first) * (1 - test_share)).cast("int")))
    late = F.col("date") > cut.scalar()
    found = _coefficients(*_normal_equations(rows.where(~late), len(inputs), horizon))
    models = F.array(*(F.array(*map(F.lit, c)) for c in found))
    forecast = F.aggregate(F.zip_with("u", "model", lambda x, c: x * c), F.lit(0.0), lambda a, b: a + b)
    steps = F.transform(models, lambda m, i: F.struct((i + 1).alias("step"), F.get("y", i).alias("actual"), m.alias("model")))
    return (
        rows.where(late).select("category", "date", "u", F.inline(steps)).where(F.col("actual").isNotNull())
        .select("category", "date", "step", "actual", forecast.alias("forecast"))
    )


def whole_horizon(forecasts: DataFrame, horizon: int = 7) -> DataFrame:
    """(category, date, y, yhat) of the days whose steps are all known."""
    steps = F.sort_array(F.collect_list(F.struct("step", "actual", "forecast")))  # ``horizon`` entries at most
    rows = forecasts.groupBy("category", "date").agg(steps.alias("s")).where(F.size("s") == horizon)
    return rows.select(
        "category", "date", F.transform("s", lambda s: s["actual"]).alias("y"), F.transform("s", lambda s: s["forecast"]).alias("yhat")
    )
