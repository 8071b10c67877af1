"""Parsers, bins and scores on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from shopgrain.functions import numbers as N
from shopgrain.operators import features, ordering


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_parse_price(spark):
    got = column(
        spark, ["$1,234.50", "1,2", "nan", "", "Rs. 500", None, "inf", "12d", " 7 "], "string",
        N.parse_price("v"),
    )
    assert got == [1234.5, 12.0, None, None, None, None, None, None, 7.0]


def test_parse_price_loose(spark):
    got = column(spark, ["Rs. 500", "Rs. 1,234.50 only", "free", None, "2 for 3"], "string",
                 N.parse_price_loose("v"))
    assert got == [500.0, 1234.5, None, None, 2.0]


def test_parse_count(spark):
    got = column(spark, ["1,234", "12.9", "many", None], "string", N.parse_count("v"))
    assert got == [1234, 12, 0, 0]


def test_discount(spark):
    rows = [(0.0, 0.0), (5.0, 0.0), (12.0, 10.0), (None, 10.0), (5.0, None), (7.5, 10.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p double, l double")
    got = [r[0] for r in df.orderBy("i").select(N.discount_pct("p", "l")).collect()]
    assert got == [None, 0.0, 0.0, None, None, 25.0]


def test_discount_tier_edges(spark):
    got = column(spark, [-1.0, 0.0, 10.0, 10.1, 25.0, 50.0, 100.0, None], "double", N.discount_tier("v"))
    assert got == [None, "No Discount", "Low", "Medium", "Medium", "High", "Very High", "No Discount"]


def test_rating_tier_edges(spark):
    got = column(spark, [None, 0.0, 2.0, 2.1, 3.0, 4.0, 4.5, 5.0, 5.1], "double", N.rating_tier("v"))
    assert got == ["Below Average", None, "Poor", "Below Average", "Below Average", "Average", "Good",
                   "Excellent", None]


def test_round_even(spark):
    assert column(spark, [0.125, 0.375, 2.5], "double", N.round_even(F.col("v"), 2)) == [0.12, 0.38, 2.5]


def test_price_per_rating_of_zero_rating_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (None, None), (9.0, 4.0)], "p double, r double")
    got = [r[0] for r in df.select(N.price_per_rating("p", "r")).collect()]
    assert got == [None, 0.0, 2.25]


def test_compare_score_caps_reviews(spark):
    df = spark.createDataFrame([(4.0, 10.0, 600000)], "r double, f double, n bigint")
    got = df.select(N.compare_score(F.col("r"), F.col("f"), F.col("n"))).first()[0]
    assert got == pytest.approx(80 + 27 + 30)


def quantile(values, p):
    s = sorted(values)
    pos = (len(s) - 1) * p
    lo = math.floor(pos)
    return s[lo] + (s[math.ceil(pos)] - s[lo]) * (pos - lo)


@pytest.mark.parametrize("few", [100_000, 5])
@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_exact_quantile_with_a_hot_value(spark, few, p):
    values = [float((i * 37) % 101) for i in range(200)] + [50.0] * 100
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert ordering.exact_quantile(df, "v", p, ranges=8, few=few) == pytest.approx(quantile(values, p))


def test_exact_quantile_of_nothing(spark):
    assert ordering.exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None


def test_value_score_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 4.0, 10.0), (2, None, None), (3, 5.0, 0.0), (4, 2.0, 30.0)], "i int, rating double, price double"
    )
    got = {r["i"]: r["value_score"] for r in features.value_score(df).collect()}
    # Prices 0, 10, 30: median 10; filled 0, 10, 10, 30: median 10.
    def score(rating, price):
        return round(rating / 5 / (math.log1p(price) + 1) * 100, 2)
    assert got == {1: score(4, 10), 2: score(3, 10), 3: score(5, 10), 4: score(2, 30)}


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 1.0), ("b", 3.0)], "g string, x double")
    assert {r["x_scaled"] for r in features.minmax(df.where("g = 'a'"), ["x"]).collect()} == {0.0}
    norm = features.normalise_half(df, "x", "g").orderBy("g", "x").collect()
    assert [r["x_norm"] for r in norm] == [0.5, 0.5, 0.0, 1.0]


def test_index_is_dense_and_independent_of_partitions(spark):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "k").withColumn("k", F.col("k") * 7 % 1009)
    want = {k: i for i, k in enumerate(sorted(r["k"] for r in df.collect()))}
    for parts in (1, 16):
        got = ordering.with_index(df.repartition(parts), "k").collect()
        assert {r["k"]: r["product_idx"] for r in got} == want


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, o int")
    once = ordering.dedup_first(df, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 5)]
    assert sorted(map(tuple, ordering.dedup_first(once, ["k"], ["o"]).collect())) == [("a", 1), ("b", 5)]


def test_topk_beyond_the_group_limit_is_exact(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    got = ordering.topk(df, ["g"], [F.desc("v")], 1500)
    assert got.groupBy("g").agg(F.min("v"), F.count("*")).orderBy("g").collect() == [
        (0, 4998 - 2 * 1499, 1500), (1, 4999 - 2 * 1499, 1500)
    ]
