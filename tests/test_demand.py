"""Demand series, metrics and splits on small fixtures."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import demand, evaluate

START = datetime.date(2024, 1, 1)


def series(spark, lengths):
    rows = [
        (c, START + datetime.timedelta(days=i), float((i * 7) % 5 + i / 10))
        for c, n in lengths.items() for i in range(n)
    ]
    return spark.createDataFrame(rows, "category string, date date, demand double")


def test_number_of_windows(spark):
    df = series(spark, {"a": 36, "b": 37, "c": 90})
    got = {r["category"]: r["n"] for r in demand.sequences(df, ["demand"], "demand").groupBy("category").agg(F.count("*").alias("n")).collect()}
    assert got == {"b": 1, "c": 90 - 36}


def test_window_content(spark):
    df = series(spark, {"b": 37})
    row = demand.naive(demand.sequences(df, ["demand"], "demand")).first()
    values = [r["demand"] for r in df.orderBy("date").collect()]
    assert [x[0] for x in row["x"]] == values[:30]
    assert row["y"] == values[30:] and row["yhat"] == [values[29]] * 7


def test_spine_fills_gaps(spark):
    df = spark.createDataFrame(
        [("a", START, 1.0), ("a", START + datetime.timedelta(days=3), 2.0), ("b", START, 5.0)],
        "category string, date date, demand double",
    )
    got = demand.date_spine(df).orderBy("category", "date").collect()
    assert [r["demand"] for r in got] == [1.0, 0.0, 0.0, 2.0, 5.0, 0.0, 0.0, 0.0]


def test_calendar_monday_is_zero(spark):
    df = spark.createDataFrame([(START,), (START + datetime.timedelta(days=5),)], "date date")
    got = demand.calendar(df).orderBy("date").collect()
    assert [(r["day_of_week"], r["is_weekend"], r["month"]) for r in got] == [(0, 0, 1), (5, 1, 1)]


def test_scaled_features_of_a_constant_series(spark):
    df = spark.createDataFrame([("a", START, 4.0), ("a", START + datetime.timedelta(days=1), 4.0)], "category string, date date, demand double")
    assert {r["demand_scaled"] for r in demand.scaled_features(df).collect()} == {0.0}


def test_trend_of_a_line(spark):
    rows = [("a", START + datetime.timedelta(days=i), 3.0 + 2 * i) for i in range(10)]
    df = spark.createDataFrame(rows, "category string, date date, demand double")
    for r in demand.trend(df).collect():
        assert r["trend"] == pytest.approx(r["demand"])


def test_seasonal_and_moving_average(spark):
    df = series(spark, {"a": 9})
    v = [r["demand"] for r in df.orderBy("date").collect()]
    lagged = [r["forecast"] for r in demand.seasonal_naive(df).orderBy("date").collect()]
    assert lagged == [None] * 7 + v[:2]
    mean = [r["forecast"] for r in demand.moving_average(df, width=3).orderBy("date").collect()]
    assert mean[:3] == [None] * 3 and mean[3] == pytest.approx(sum(v[:3]) / 3)


def test_summary_takes_the_first_peak(spark):
    rows = [("a", START + datetime.timedelta(days=i), x) for i, x in enumerate([1.0, 9.0, 9.0, 2.0])]
    r = demand.demand_summary(spark.createDataFrame(rows, "category string, date date, demand double")).first()
    assert (r["avg_daily_demand"], r["peak_demand"], r["total"], r["trend"]) == (5, 9.0, 21.0, "increasing")
    assert r["peak_day"] == START + datetime.timedelta(days=1)


def test_regression_learns_a_lag(spark):
    rows = [("a", START + datetime.timedelta(days=i), float(i % 7)) for i in range(120)]
    df = demand.scaled_features(spark.createDataFrame(rows, "category string, date date, demand double"))
    out = demand.lag_regression(df, horizon=2)
    err = out.agg(F.avg(F.abs(F.col("actual") - F.col("forecast")))).first()[0]
    assert err < 0.05 and {r[0] for r in out.select("step").distinct().collect()} == {1, 2}


def test_forecast_metrics_by_hand(spark):
    rows = [("m", [1.0, 2.0], [2.0, 2.0]), ("m", [4.0, 2.0], [4.0, 1.0])]
    df = spark.createDataFrame(rows, "model string, y array<double>, yhat array<double>")
    r = evaluate.forecast_metrics(df).first()
    assert r["mae"] == pytest.approx(0.5) and r["rmse"] == pytest.approx(math.sqrt(0.5))
    assert r["mape"] == pytest.approx((1 + 0.5) / 4 * 100) and r["wape"] == pytest.approx(2 / 9 * 100)
    assert r["smape"] == pytest.approx((2 / 3 + 2 / 3) / 4 * 100) and r["dir_acc"] == 0.5


def test_best_model(spark):
    df = spark.createDataFrame([("naive", 2.0), ("a", 1.5), ("b", 1.0)], "model string, mae double")
    r = evaluate.best_model(df, "naive").first()
    assert (r["best_model"], r["improvement_pct"]) == ("b", 50.0)


def test_ranking_metrics_by_hand(spark):
    recs = spark.createDataFrame([(1, i, i) for i in (1, 2, 3)] + [(2, 9, 1)], "user_id int, item_id int, rank int")
    rel = spark.createDataFrame([(1, 2), (1, 7), (2, 5), (3, 1)], "user_id int, item_id int")
    r = evaluate.ranking_metrics(recs, rel, k=3).first()
    dcg, ideal = 1 / math.log2(3), 1 + 1 / math.log2(3)
    assert r["users"] == 3
    assert r["precision_at_k"] == pytest.approx(1 / 3 / 3) and r["recall_at_k"] == pytest.approx(0.5 / 3)
    assert r["ndcg_at_k"] == pytest.approx(dcg / ideal / 3)


def test_holdout_parts_are_disjoint_and_stable(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("item_id"))
    train, held = evaluate.holdout(df, 0.3)
    assert train.count() + held.count() == 2000 and 500 < held.count() < 700
    again = evaluate.holdout(df.repartition(7), 0.3)[1]
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, again.collect()))


def test_relevant_items_use_the_median_of_all_scores(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(1, 6)], "user_id int, item_id int, score double")
    rel = evaluate.relevant_items(df, df.where("item_id IN (2, 3, 5)"))
    assert sorted(r["item_id"] for r in rel.collect()) == [3, 5]


@pytest.mark.parametrize("total, floor", [(30, 5), (30, 50)])
def test_balanced_sample_quota(spark, total, floor):
    rows = [("big", i) for i in range(200)] + [("mid", 1000 + i) for i in range(20)] + [("few", 5000 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "c string, k int")
    got = {r["c"]: r["n"] for r in evaluate.balanced_sample(df, "c", "k", total, floor).groupBy("c").agg(F.count("*").alias("n")).collect()}
    quota = max(total // 3, floor)
    want, left = {}, total
    for c, n in (("big", 200), ("mid", 20), ("few", 3)):
        take = min(n, quota, left)
        left -= take
        if take:
            want[c] = take
    assert got == want


def test_split_shares(spark):
    got = evaluate.split(spark.range(20000), ["id"]).groupBy("part").agg(F.count("*").alias("n"))
    n = {r["part"]: r["n"] / 20000 for r in got.collect()}
    assert n == pytest.approx({"train": 0.70, "validation": 0.15, "test": 0.15}, abs=0.02)


def test_classification_by_hand(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "t string, p string")
    got = {(r["metric"], r["class"]): r["value"] for r in evaluate.classification_metrics(df, "t", "p").collect()}
    f = {"a": 2 / 3, "b": 0.5, "c": 0.0}
    assert {k[1]: v for k, v in got.items() if k[0] == "f1"} == pytest.approx(f)
    assert got[("accuracy", "")] == 0.5
    assert got[("macro_f1", "")] == pytest.approx(sum(f.values()) / 3)
    assert got[("weighted_f1", "")] == pytest.approx((2 * f["a"] + f["b"] + f["c"]) / 4)


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert {r["c"]: r["label_idx"] for r in evaluate.label_index(df, "c").collect()} == {"a": 0, "b": 1}
