"""The row functions as SQL users call them, one query per family through ``spark.sql``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from shopgrain.functions import sql
from shopgrain.plans.registry import query
from shopgrain.plans.views import Views


def ask(v: Views, rows: DataFrame, select: str) -> DataFrame:
    """``select`` over rows under a name of their own, with the functions registered."""
    sql.register(v.spark)
    name = f"shop_rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(name)
    return v.spark.sql(f"SELECT {select} FROM {name}")


@query("sql_number_functions", """
SELECT asin, CASE WHEN price <> 'nan' THEN replace(replace(price, '$', ''), ',', '')::DOUBLE END AS price,
 replace(substr("listPrice", 5), ',', '')::DOUBLE AS list_price,
 CASE WHEN reviews = 'many' THEN 0 ELSE replace(reviews, ',', '')::BIGINT END AS review_count,
 try_cast(stars AS DOUBLE) AS rating FROM raw_catalogue""", ["raw_catalogue"])
def _(v: Views):
    return ask(v, v.raw_catalogue, """asin, shop_parse_price(price) AS price, shop_parse_price_loose(listPrice) AS list_price,
 shop_parse_count(reviews) AS review_count, shop_parse_number(stars) AS rating""")


@query("sql_tier_functions", """
SELECT product_idx, discount_pct, discount_tier, rating_tier, price_per_rating FROM features""", ["features"])
def _(v: Views):
    return ask(v, v.products, """product_idx, shop_discount_pct(price, list_price) AS discount_pct,
 shop_discount_tier(shop_discount_pct(price, list_price)) AS discount_tier, shop_rating_tier(rating) AS rating_tier,
 shop_price_per_rating(price, rating) AS price_per_rating""")


@query("sql_text_functions", """
SELECT c.product_id, c.combined_text, word_count, price_mentioned
FROM cleaned c JOIN facts f ON c.product_id = f.product_id""", ["cleaned", "facts"])
def _(v: Views):
    both = "shop_combine_text(shop_clean_text(product_name), shop_clean_text(review_text))"
    return ask(v, v.reviews, f"""product_id, {both} AS combined_text, shop_word_count({both}) AS word_count,
 shop_first_price(review_text) AS price_mentioned""")


@query("sql_trust_functions", """
SELECT product_id, sentiment_label, nlp_quality_score, product_risk_tier FROM enriched""", ["enriched"])
def _(v: Views):
    return ask(v, v.enriched, """product_id, shop_sentiment_label(sentiment_compound) AS sentiment_label,
 shop_nlp_quality(sentiment_compound, feature_count, word_count) AS nlp_quality_score,
 shop_risk_tier(fake_review_score, sentiment_compound, rating) AS product_risk_tier""")
