"""Counts, profiles and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopgrain.functions import dictionaries as D
from shopgrain.operators import reports
from shopgrain.operators.checkpoints import new_path
from shopgrain.plans.registry import query
from shopgrain.plans.views import Views
from shopgrain.sources import files


@query("value_counts", """
SELECT rating_tier, count(*) AS n FROM features GROUP BY 1 ORDER BY n DESC, rating_tier NULLS FIRST LIMIT 10""",
       ["features"])
def _(v: Views):
    return reports.value_counts(v.features, "rating_tier", 10)


@query("value_share", """
SELECT discount_tier, count(*) AS n, round(count(*) / (SELECT count(*) FROM features) * 100, 1) AS pct
FROM features GROUP BY 1""", ["features"])
def _(v: Views):
    return reports.value_share(v.features, "discount_tier")


@query("null_profile", """
SELECT "column", n_null, round(n_null * 100 / total, 1) AS pct_null FROM (
 SELECT unnest(['price', 'discount_pct', 'rating', 'image_url', 'rating_tier', 'price_per_rating', 'product_id']) AS "column",
  unnest([count(*) - count(price), count(*) - count(discount_pct), count(*) - count(rating),
   count(*) - count(image_url), count(*) - count(rating_tier), count(*) - count(price_per_rating),
   count(*) - count(product_id)]) AS n_null, count(*) AS total FROM features)
WHERE n_null > 0""", ["features"])
def _(v: Views):
    return reports.null_profile(v.features)


@query("numeric_profile", """
SELECT 'price' AS "column", round(avg(price), 2) AS mean, round(min(price), 2) AS min, round(max(price), 2) AS max FROM features
UNION ALL SELECT 'rating', round(avg(rating), 2), min(rating), max(rating) FROM features
UNION ALL SELECT 'review_count', round(avg(review_count), 2), min(review_count)::DOUBLE, max(review_count)::DOUBLE FROM features
UNION ALL SELECT 'discount_pct', round(avg(discount_pct), 2), min(discount_pct), max(discount_pct) FROM features
UNION ALL SELECT 'value_score', round(avg(value_score), 2), min(value_score), max(value_score) FROM features""",
       ["features"])
def _(v: Views):
    return reports.numeric_profile(
        v.features, ["price", "rating", "review_count", "discount_pct", "value_score"]
    )


@query("catalogue_summary", """
SELECT 'sources' AS metric, source AS key, count(*)::DOUBLE AS value FROM products GROUP BY ALL
UNION ALL SELECT 'total_records', '', count(*)::DOUBLE FROM products
UNION ALL SELECT 'avg_rating', '', round(avg(rating), 2) FROM products
UNION ALL SELECT 'avg_price', '', round(avg(price), 2) FROM products
UNION ALL SELECT 'n_columns', '', 13.0::DOUBLE""", ["products"])
def _(v: Views):
    return reports.catalogue_summary(v.products)


@query("pipeline_summary", """
SELECT 'sources' AS metric, source AS key, count(*)::DOUBLE AS value FROM products GROUP BY ALL
UNION ALL SELECT 'total_records', '', count(*)::DOUBLE FROM products
UNION ALL SELECT 'avg_rating', '', round(avg(rating), 2) FROM products
UNION ALL SELECT 'avg_price', '', round(avg(price), 2) FROM products
UNION ALL SELECT 'n_columns', '', 13.0::DOUBLE
UNION ALL SELECT 'columns', unnest(['product_idx', 'product_id', 'product_name', 'category', 'brand', 'source', 'list_price',
 'price', 'rating', 'review_count', 'is_bestseller', 'image_url', 'discount_pct']), unnest(range(13))::DOUBLE""", ["products"])
def _(v: Views):
    return reports.pipeline_summary(v.products)


@query("nlp_summary", """
WITH counts AS (
 SELECT 'sentiment_distribution' AS metric, sentiment_label AS key, count(*)::DOUBLE AS value FROM enriched GROUP BY ALL
 UNION ALL SELECT 'category_distribution', predicted_category, count(*)::DOUBLE FROM enriched GROUP BY ALL
 UNION ALL SELECT 'top_brands', brand_extracted, count(*)::DOUBLE FROM enriched GROUP BY ALL
 UNION ALL SELECT 'risk_distribution', product_risk_tier, count(*)::DOUBLE FROM enriched GROUP BY ALL)
SELECT metric, key, value FROM counts
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY value DESC, key) <= 10
UNION ALL SELECT 'total_records', '', count(*)::DOUBLE FROM enriched
UNION ALL SELECT 'fake_reviews_flagged', '', count(*) FILTER (fake_review_flag)::DOUBLE FROM enriched
UNION ALL SELECT 'fake_review_pct', '', round(count(*) FILTER (fake_review_flag) / count(*) * 100, 2) FROM enriched
UNION ALL SELECT 'avg_nlp_quality', '', round(avg(nlp_quality_score), 2) FROM enriched""", ["enriched"])
def _(v: Views):
    return reports.nlp_summary(v.enriched)


@query("nlp_evaluation", """
SELECT count(*) AS total_records, count(*) FILTER (has_review) AS with_review,
 count(*) FILTER (sentiment_label = 'Positive') AS positive, count(*) FILTER (sentiment_label = 'Negative') AS negative,
 count(*) FILTER (sentiment_label = 'Neutral') AS neutral, round(avg(sentiment_compound), 4) AS avg_compound,
 count(DISTINCT predicted_category) AS categories,
 round(count(*) FILTER (predicted_category <> 'Other') / count(*) * 100, 1) AS category_coverage,
 count(*) FILTER (brand_extracted <> 'Unknown') AS brands_identified,
 round(count(*) FILTER (brand_extracted <> 'Unknown') / count(*) * 100, 1) AS brand_coverage,
 round(avg(feature_count), 1) AS avg_features, count(*) FILTER (fake_review_flag) AS flagged,
 round(count(*) FILTER (fake_review_flag) / count(*) * 100, 1) AS flagged_pct,
 round(avg(fake_review_score), 1) AS avg_fake_score,
 count(*) FILTER (product_risk_tier = 'High Risk') AS high_risk,
 count(*) FILTER (product_risk_tier = 'Medium Risk') AS medium_risk,
 count(*) FILTER (product_risk_tier = 'Low Risk') AS low_risk FROM enriched""", ["enriched"])
def _(v: Views):
    return reports.nlp_evaluation(v.enriched)


@query("aspect_coverage", " UNION ALL ".join(
    f"SELECT '{a}' AS aspect, count(*) FILTER (contains(combined_text, '{a}')) AS n_rows FROM cleaned"
    for a in D.ASPECT_KEYWORDS), ["cleaned"])
def _(v: Views):
    return reports.aspect_coverage(v.cleaned, "combined_text", list(D.ASPECT_KEYWORDS))


@query("aspect_keyword_coverage", """
SELECT aspect, polarity, count(*) AS n_rows FROM aspect_rows GROUP BY ALL""", ["aspect_rows"])
def _(v: Views):
    return reports.aspect_keyword_coverage(v.dictionary_stage)


@query("headline_metrics", """
SELECT count(*) AS total_products, round(avg(rating), 2) AS avg_rating,
 round(avg(fake_review_score), 2) AS avg_fake_score FROM enriched""", ["enriched"])
def _(v: Views):
    return reports.headline(v.enriched)


@query("platform_stats", """
SELECT count(*) AS total_products, count(DISTINCT category) AS categories,
 (SELECT count(*) FROM embeddings) AS indexed_products FROM products""", ["products"])
def _(v: Views):
    return reports.platform_stats(v.products, v.vectors)


@query("interaction_stats", """
SELECT count(*) AS interactions, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
 round(count(*) / count(DISTINCT user_id), 1) AS per_user,
 round((1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id))) * 100, 1) AS sparsity_pct
FROM interactions""", ["interactions"])
def _(v: Views):
    return reports.interaction_stats(v.stored_interactions)


@query("category_rollup", """
SELECT predicted_category, sentiment_label, count(*) AS n, grouping(predicted_category, sentiment_label)::BIGINT AS level
FROM enriched GROUP BY ROLLUP (predicted_category, sentiment_label)""", ["enriched"])
def _(v: Views):
    return reports.category_rollup(v.enriched, "predicted_category", "sentiment_label")


@query("category_risk_rollup", """
SELECT predicted_category, product_risk_tier, count(*) AS n, grouping(predicted_category, product_risk_tier)::BIGINT AS level
FROM enriched GROUP BY ROLLUP (predicted_category, product_risk_tier)""", ["enriched"])
def _(v: Views):
    return reports.category_rollup(v.enriched, "predicted_category", "product_risk_tier")


@query("price_stats_by_category", """
SELECT category, count(*) AS n, round(avg(price), 2) AS avg_price, min(price) AS min_price, max(price) AS max_price
FROM products GROUP BY 1""", ["products"])
def _(v: Views):
    return reports.price_stats(v.products)


@query("write_high_risk", """
SELECT product_id, sentiment_label, product_risk_tier FROM enriched WHERE product_risk_tier = 'High Risk'""", ["enriched"])
def _(v: Views):
    """The enriched table is published by risk tier; reading the high-risk slice opens its folder alone."""
    path = new_path(v.spark, "enriched")
    files.publish(v.enriched, path, ["product_risk_tier"])
    slice_ = files.published(v.spark, path, v.enriched.schema).where(F.col("product_risk_tier") == "High Risk")
    return slice_.select("product_id", "sentiment_label", "product_risk_tier")
