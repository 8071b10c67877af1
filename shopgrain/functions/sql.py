"""The row functions for SQL users: temporary SQL functions, which Spark inlines into its plans like built-in ones.

``register(spark)`` defines them for a session; their names start with ``shop_``. Bins and limits come from the
constants of the Column functions, so both forms give the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from shopgrain.functions import numbers as N


def _bins(value: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    cases = " ".join(
        f"WHEN {value} > {low} AND {value} <= {high} THEN '{label}'"
        for low, high, label in zip(edges, edges[1:], labels, strict=False)
    )
    return f"CASE {cases} END"


def _even(value: str, digits: int) -> str:
    return f"rint(({value}) * {10**digits}) / {10**digits}"


#: Name and arguments, type, and body of each function; a body may use the functions before it.
FUNCTIONS: list[tuple[str, str, str]] = [
    ("shop_parse_number(s STRING)", "DOUBLE", f"CASE WHEN s RLIKE r'{N._NUMBER}' THEN try_cast(trim(s) AS DOUBLE) END"),
    ("shop_parse_price(s STRING)", "DOUBLE", "shop_parse_number(regexp_replace(s, '[$,]', ''))"),
    ("shop_parse_price_loose(s STRING)", "DOUBLE", r"shop_parse_number(replace(regexp_extract(s, r'(\d[\d,]*(?:\.\d+)?)', 1), ',', ''))"),
    ("shop_parse_count(s STRING)", "BIGINT", "CAST(coalesce(shop_parse_number(replace(s, ',', '')), 0D) AS BIGINT)"),
    ("shop_discount_pct(price DOUBLE, list_price DOUBLE)", "DOUBLE", _even(
        "CASE WHEN list_price = 0 AND price > 0 THEN 0D WHEN try_divide(list_price - price, list_price) IS NOT NULL"
        " THEN least(greatest(try_divide(list_price - price, list_price) * 100, 0D), 100D) END", 1)),
    ("shop_discount_tier(pct DOUBLE)", "STRING", _bins("coalesce(pct, 0D)", N.DISCOUNT_EDGES, N.DISCOUNT_LABELS)),
    ("shop_rating_tier(rating DOUBLE)", "STRING", _bins("coalesce(rating, 3D)", N.RATING_EDGES, N.RATING_LABELS)),
    ("shop_price_per_rating(price DOUBLE, rating DOUBLE)", "DOUBLE", _even("try_divide(coalesce(price, 0D), coalesce(rating, 3D))", 2)),
    ("shop_clean_text(s STRING)", "STRING", (
        r"coalesce(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(s), r'<[^>]+>', ''),"
        r" r'http\S+|www\S+', ''), r'[^a-z0-9.,!?]', ' '), r'  +', ' ')), '')")),
    ("shop_combine_text(a STRING, b STRING)", "STRING", "trim(concat(a, ' ', b))"),
    ("shop_word_count(s STRING)", "BIGINT", r"CAST(coalesce(size(filter(split(s, r'\s+'), w -> w <> '')), 0) AS BIGINT)"),
    ("shop_first_price(s STRING)", "DOUBLE", r"shop_parse_number(replace(regexp_extract(s, r'\$([\d,]+\.?\d*)', 1), ',', ''))"),
    ("shop_sentiment_label(compound DOUBLE)", "STRING", "CASE WHEN compound >= 0.05 THEN 'Positive' WHEN compound <= -0.05 THEN 'Negative' ELSE 'Neutral' END"),
    ("shop_nlp_quality(compound DOUBLE, features BIGINT, words BIGINT)", "DOUBLE", _even(
        "(coalesce(compound, 0D) + 1) * 25 + least(greatest(coalesce(CAST(features AS DOUBLE), 0D), 0D), 5D) * 5"
        " + least(greatest(coalesce(CAST(words AS DOUBLE), 0D), 0D), 100D) / 100 * 25", 2)),
    ("shop_risk_points(fake DOUBLE, compound DOUBLE, rating DOUBLE)", "INT", (
        "CASE WHEN fake > 60 THEN 40 WHEN fake > 30 THEN 20 ELSE 0 END + CASE WHEN compound < -0.2 THEN 30 ELSE 0 END"
        " + CASE WHEN nullif(rating, 0D) < 2.5 THEN 30 ELSE 0 END")),
    ("shop_risk_tier(fake DOUBLE, compound DOUBLE, rating DOUBLE)", "STRING", (
        "CASE WHEN shop_risk_points(fake, compound, rating) >= 60 THEN 'High Risk'"
        " WHEN shop_risk_points(fake, compound, rating) >= 30 THEN 'Medium Risk' ELSE 'Low Risk' END")),
]


def register(spark: SparkSession) -> list[str]:
    """Define all functions for this session, again if they are there; returns their names."""
    for head, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    return [head.split("(")[0] for head, *_ in FUNCTIONS]
