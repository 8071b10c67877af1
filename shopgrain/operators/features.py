"""Product features that need a statistic of the whole table.

Means and extremes are scalar subqueries: one aggregate, one value sent to the tasks.
Quantiles are computed first and enter the plan as numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import numbers as N
from shopgrain.functions.textual import title_length, word_count
from shopgrain.operators.ordering import exact_quantile


def with_stats(df: DataFrame, aggs: Sequence[Column], out: str = "_stats") -> DataFrame:
    """Attach named aggregates of the whole table to every row as one struct."""
    return df.withColumn(out, df.agg(*aggs).select(F.struct("*")).scalar())


def value_score(df: DataFrame, out: str = "value_score") -> DataFrame:
    """Rating against log price, 0..100; missing and zero prices take the median."""
    filled = F.coalesce("price", F.lit(exact_quantile(df, "price", 0.5)).cast("double"))
    # The second median is that of the filled column, as zeros are replaced after it.
    refill = exact_quantile(df.select(filled.alias("filled")), "filled", 0.5)
    price = F.when(filled == 0, F.lit(refill).cast("double")).otherwise(filled)
    score = (F.coalesce("rating", F.lit(3.0)) / 5.0) / (F.log1p(price) + 1)
    return df.withColumn(out, N.round_even(score * 100, 2))


def popularity_score(df: DataFrame, out: str = "popularity_score") -> DataFrame:
    """Review count against its 95th percentile, 0..100."""
    n = F.coalesce("review_count", F.lit(0)).cast("double")
    p95 = exact_quantile(df.select(n.alias("n")), "n", 0.95) or 0.0
    return df.withColumn(out, N.round_even(N.clip(n / (p95 + 1) * 100, 0.0, 100.0), 2))


def engineer_features(df: DataFrame) -> DataFrame:
    """All product features: scores, tiers, title statistics, price per rating point."""
    return popularity_score(value_score(df)).withColumns(
        {
            "discount_tier": N.discount_tier("discount_pct"),
            "rating_tier": N.rating_tier("rating"),
            "is_bestseller": N.flag("is_bestseller"),
            "title_length": title_length("product_name"),
            "title_word_count": word_count("product_name"),
            "price_per_rating": N.price_per_rating("price", "rating"),
        }
    )


def _scaled(x: Column, low: Column, high: Column, flat: float, eps: float) -> Column:
    spread = high - low
    return F.when(spread <= eps, F.lit(flat)).otherwise(F.try_divide(x - low, spread))


def minmax(
    df: DataFrame, cols: Sequence[str], by: str | None = None, suffix: str = "_scaled",
    flat: float = 0.0, eps: float = 0.0,
) -> DataFrame:
    """(x - min) / (max - min) over the table or per group; a constant column gives ``flat``."""
    aggs = [f(c).alias(f"{c}_{f.__name__}") for c in cols for f in (F.min, F.max)]
    if by is None:
        df = with_stats(df, aggs)
        ref = lambda name: F.col("_stats")[name]
        drop = ["_stats"]
    else:
        # Aggregate and join back: a hot group is never gathered in one window task.
        df = df.join(df.groupBy(by).agg(*aggs), by)
        ref = F.col
        drop = [f"{c}_{f}" for c in cols for f in ("min", "max")]
    out = {
        c + suffix: _scaled(F.col(c), ref(f"{c}_min"), ref(f"{c}_max"), flat, eps) for c in cols
    }
    return df.withColumns(out).drop(*drop)


def normalise_half(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Min-max where a range under 1e-8 gives 0.5."""
    return minmax(df, [col], by, suffix="_norm", flat=0.5, eps=1e-8)


def log_minmax(df: DataFrame, col: str) -> DataFrame:
    logged = df.withColumn(f"{col}_log", F.log1p(F.coalesce(F.col(col), F.lit(0)).cast("double")))
    return minmax(logged, [f"{col}_log"])


def quality_score(df: DataFrame) -> DataFrame:
    """Weighted product quality from rating, popularity, value, sentiment, authenticity.

    ``sentiment_compound`` and ``fake_review_score`` are optional columns.
    """
    have = set(df.columns)
    prepared = df.withColumns(
        {
            "_rating": N.clip(F.coalesce("rating", F.lit(3.0)), 1.0, 5.0),
            "_popularity": F.log1p(F.coalesce("review_count", F.lit(0)).cast("double")),
            "_value": F.coalesce("value_score", F.lit(50.0)),
        }
    )
    scaled = minmax(prepared, ["_rating", "_popularity", "_value"])
    sentiment = (
        (F.coalesce("sentiment_compound", F.lit(0.0)) + 1) / 2
        if "sentiment_compound" in have else F.lit(0.5)
    )
    authentic = (
        1 - F.coalesce(F.col("fake_review_score").cast("double"), F.lit(0.0)) / 100
        if "fake_review_score" in have else F.lit(1.0)
    )
    scored = scaled.withColumns(
        {
            "rating_score": F.col("_rating_scaled"),
            "popularity_part": F.col("_popularity_scaled"),
            "value_part": F.col("_value_scaled"),
            "sentiment_score": sentiment,
            "authenticity_score": authentic,
        }
    ).drop("_rating", "_popularity", "_value", "_rating_scaled", "_popularity_scaled", "_value_scaled")
    # The five weights.
    return scored.withColumn(
        "quality_score",
        F.col("rating_score") * 0.35
        + F.col("popularity_part") * 0.20
        + F.col("value_part") * 0.20
        + F.col("sentiment_score") * 0.15
        + F.col("authenticity_score") * 0.10,
    )
