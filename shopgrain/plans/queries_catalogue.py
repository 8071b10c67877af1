"""Sources, cleaning, filters, features, ordering and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopgrain.functions import numbers as N
from shopgrain.functions import textual as X
from shopgrain.operators import cleaning, evaluate, features, ordering
from shopgrain.operators.checkpoints import new_path
from shopgrain.plans.registry import query
from shopgrain.plans.views import Views
from shopgrain.sources import files


@query("sample_head", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 300""")
def _(v: Views):
    return ordering.take_first(
        v.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), 300, "o_orderkey"
    )


@query("write_product_index", """
SELECT product_idx, product_id, product_name, category, price, rating FROM products""", ["products"])
def _(v: Views):
    path = new_path(v.spark, "product-index")
    index = cleaning.product_index(v.products)
    files.publish(index, path)
    return files.published(v.spark, path, index.schema)


@query("standardise_columns", """
SELECT asin AS product_id, title AS product_name, stars AS rating, reviews AS review_count, price,
 "listPrice" AS list_price, "isBestSeller" AS is_bestseller, category_id AS category, "imgUrl" AS image_url,
 'catalogue' AS source FROM raw_catalogue""", ["raw_catalogue"])
def _(v: Views):
    return cleaning.standardise(v.raw_catalogue, cleaning.CATALOGUE_COLUMNS, "catalogue")


@query("keep_columns", """SELECT asin, title, price FROM raw_catalogue""", ["raw_catalogue"])
def _(v: Views):
    return cleaning.keep(v.raw_catalogue, ["asin", "title", "brand", "price", "reviews.text"])


@query("parse_price", """
SELECT asin, CASE WHEN price <> 'nan' THEN replace(replace(price, '$', ''), ',', '')::DOUBLE END AS price
FROM raw_catalogue""", ["raw_catalogue"])
def _(v: Views):
    return v.raw_catalogue.select("asin", N.parse_price("price").alias("price"))


@query("parse_price_loose", """
SELECT asin, replace(substr("listPrice", 5), ',', '')::DOUBLE AS list_price FROM raw_catalogue""",
       ["raw_catalogue"])
def _(v: Views):
    return v.raw_catalogue.select("asin", N.parse_price_loose("listPrice").alias("list_price"))


@query("parse_count", """
SELECT asin, CASE WHEN reviews = 'many' THEN 0 ELSE replace(reviews, ',', '')::BIGINT END AS review_count
FROM raw_catalogue""", ["raw_catalogue"])
def _(v: Views):
    return v.raw_catalogue.select("asin", N.parse_count("reviews").alias("review_count"))


@query("parse_rating", """SELECT asin, try_cast(stars AS DOUBLE) AS rating FROM raw_catalogue""",
       ["raw_catalogue"])
def _(v: Views):
    return v.raw_catalogue.select("asin", N.parse_number("stars").alias("rating"))


@query("discount_pct", """SELECT product_idx, discount_pct FROM products""", ["products"])
def _(v: Views):
    return v.products.select("product_idx", "discount_pct")


@query("drop_bad_names", """
SELECT asin, title FROM raw_catalogue WHERE title IS NOT NULL AND length(title) > 3""", ["raw_catalogue"])
def _(v: Views):
    return cleaning.valid_name(v.raw_catalogue, "title").select("asin", "title")


@query("dedup_first", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def _(v: Views):
    first = ordering.dedup_first(v.table("events"), ["user_id"], ["ts", "event_id"])
    return first.select("user_id", "event_id", "event_type", "value")


@query("surrogate_id", """
SELECT p_partkey, 'FK_' || (row_number() OVER (ORDER BY p_partkey) - 1) AS product_id
FROM part""")
def _(v: Views):
    return ordering.surrogate_id(v.table("part").select("p_partkey"), "FK_", "p_partkey")


@query("positional_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS product_idx
FROM orders""")
def _(v: Views):
    return ordering.with_index(v.table("orders").select("o_orderkey"), "o_orderkey")


@query("align_to_schema", """
SELECT product_id, product_name, source, category, price, list_price, discount_pct, rating, review_count,
 is_bestseller, image_url, NULL::VARCHAR AS review_text, NULL::DOUBLE AS value_score,
 NULL::DOUBLE AS popularity_score, NULL::VARCHAR AS discount_tier, NULL::VARCHAR AS rating_tier,
 NULL::BIGINT AS title_length, NULL::BIGINT AS title_word_count, NULL::DOUBLE AS price_per_rating
FROM products""", ["products"])
def _(v: Views):
    return cleaning.conform(v.products)


@query("stamp_processed", """
SELECT product_idx, '2024-05-01 12:30:00' AS processed_at FROM products""", ["products"])
def _(v: Views):
    stamped = cleaning.stamp(v.products, "2024-05-01 12:30:00")
    return stamped.select(
        "product_idx", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at")
    )


@query("filter_has_text", """
SELECT product_id, length(product_name)::BIGINT AS n FROM reviews WHERE product_name IS NOT NULL""",
       ["reviews"])
def _(v: Views):
    named = v.reviews.where(F.col("product_name").isNotNull())
    return named.select("product_id", F.length("product_name").cast("bigint").alias("n"))


@query("filter_valid_url", """
SELECT page_id, url FROM pages WHERE url IS NOT NULL AND url LIKE 'http%'""")
def _(v: Views):
    return cleaning.valid_url(v.table("pages"), "url").select("page_id", "url")


@query("filter_min_rating", """
SELECT product_idx, rating FROM products WHERE coalesce(rating, 0) >= 3""", ["products"])
def _(v: Views):
    return cleaning.min_rating(v.products, 3.0).select("product_idx", "rating")


@query("filter_max_price", """
SELECT product_idx, price FROM products WHERE coalesce(price, 0) <= 700""", ["products"])
def _(v: Views):
    return cleaning.max_price(v.products, 700.0).select("product_idx", "price")


@query("filter_category_or_all", """
SELECT 'PROMO' AS asked, product_idx, category FROM products WHERE category = 'PROMO'
UNION ALL SELECT 'missing', product_idx, category FROM products""", ["products"])
def _(v: Views):
    cols = ["asked", "product_idx", "category"]
    found = cleaning.category_or_all(v.products, "PROMO").withColumn("asked", F.lit("PROMO"))
    missing = cleaning.category_or_all(v.products, "no such").withColumn("asked", F.lit("missing"))
    return found.select(cols).unionByName(missing.select(cols))


@query("lookup_by_index", """
SELECT product_idx, product_id, product_name, category, coalesce(price, 0) AS price, list_price,
 coalesce(discount_pct, 0) AS discount_pct, coalesce(rating, 0) AS rating, review_count, brand,
 sentiment_label AS sentiment, fake_review_score::DOUBLE AS fake_score, product_risk_tier AS risk_tier,
 coalesce(image_url, '') AS image_url, coalesce(value_score, 0) AS value_score
FROM features JOIN product_scores USING (product_idx) WHERE product_idx = 39""", ["features", "product_scores"])
def _(v: Views):
    return cleaning.product_detail(v.features.join(v.product_scores, "product_idx"), 39)


@query("contains_search", """
SELECT product_idx, product_name, coalesce(rating, 0) * review_count AS score FROM products
WHERE contains(lower(product_name), 'ring') ORDER BY score DESC, product_idx LIMIT 8""", ["products"])
def _(v: Views):
    return cleaning.contains_search(v.products, "Ring", 8).select("product_idx", "product_name", "score")


for _name in ("value_score", "popularity_score", "discount_tier", "rating_tier", "price_per_rating"):

    @query(_name, f"SELECT product_idx, {_name} FROM features", ["features"])
    def _(v: Views, name=_name):
        source = {
            "value_score": lambda: features.value_score(v.stored_products),
            "popularity_score": lambda: features.popularity_score(v.stored_products),
            "discount_tier": lambda: v.products.withColumn(name, N.discount_tier("discount_pct")),
            "rating_tier": lambda: v.products.withColumn(name, N.rating_tier("rating")),
            "price_per_rating": lambda: v.products.withColumn(
                name, N.price_per_rating("price", "rating")
            ),
        }[name]()
        return source.select("product_idx", name)


@query("title_features", """
SELECT asin, coalesce(length(title), 0)::BIGINT AS title_length,
 CASE WHEN title IS NULL THEN 0 ELSE len(string_split(title, ' ')) END::BIGINT AS title_word_count
FROM raw_catalogue""", ["raw_catalogue"])
def _(v: Views):
    return v.raw_catalogue.select(
        "asin", X.title_length("title").alias("title_length"),
        X.word_count("title").alias("title_word_count"),
    )


@query("bestseller_flag", """
SELECT asin, coalesce("isBestSeller" = 'true', false) AS is_bestseller FROM raw_catalogue""",
       ["raw_catalogue"])
def _(v: Views):
    return v.raw_catalogue.select("asin", N.flag("isBestSeller").alias("is_bestseller"))


@query("popularity_rank_score", """
SELECT product_idx, coalesce(rating, 0) * review_count AS score FROM products""", ["products"])
def _(v: Views):
    return v.products.select("product_idx", N.rank_score("rating", "review_count").alias("score"))


@query("minmax_scale", """
SELECT product_idx, round((price - lo) / (hi - lo), 6) AS price_scaled
FROM products, (SELECT min(price) AS lo, max(price) AS hi FROM products)""", ["products"])
def _(v: Views):
    scaled = features.minmax(v.stored_products, ["price"])
    return scaled.select("product_idx", F.round("price_scaled", 6).alias("price_scaled"))


@query("minmax_normalise_half", """
SELECT product_idx, CASE WHEN hi - lo < 1e-8 THEN 0.5 ELSE round((rating - lo) / (hi - lo), 6) END AS rating_norm
FROM products JOIN (SELECT category, min(rating) AS lo, max(rating) AS hi FROM products GROUP BY 1) USING (category)
""", ["products"])
def _(v: Views):
    scaled = features.normalise_half(v.stored_products, "rating", by="category")
    return scaled.select("product_idx", F.round("rating_norm", 6).alias("rating_norm"))


@query("log_scale", """
SELECT product_idx, round((ln(1 + review_count) - lo) / (hi - lo), 6) AS scaled
FROM products, (SELECT min(ln(1 + review_count)) AS lo, max(ln(1 + review_count)) AS hi FROM products)""",
       ["products"])
def _(v: Views):
    scaled = features.log_minmax(v.stored_products, "review_count")
    return scaled.select("product_idx", F.round("review_count_log_scaled", 6).alias("scaled"))


@query("broadcast_stats_join", """
SELECT product_idx, round(price - avg_price, 4) AS above_mean, max_reviews
FROM products, (SELECT avg(price) AS avg_price, max(review_count) AS max_reviews FROM products)""",
       ["products"])
def _(v: Views):
    stats = [F.avg("price").alias("avg_price"), F.max("review_count").alias("max_reviews")]
    return features.with_stats(v.stored_products, stats).select(
        "product_idx", F.round(F.col("price") - F.col("_stats.avg_price"), 4).alias("above_mean"),
        "_stats.max_reviews",
    )


@query("quality_score", """
SELECT product_idx, round(rating_score, 6) AS rating_score, round(popularity_part, 6) AS popularity_part,
 round(value_part, 6) AS value_part, round(quality_score, 6) AS quality_score FROM quality""", ["quality"])
def _(v: Views):
    parts = ["rating_score", "popularity_part", "value_part", "quality_score"]
    return v.quality.select("product_idx", *[F.round(c, 6).alias(c) for c in parts])


@query("attach_feature_scores", """
SELECT product_idx, product_name, round(quality_score, 6) AS quality_score FROM products
JOIN (SELECT product_idx, quality_score FROM quality) USING (product_idx)""", ["products", "quality"])
def _(v: Views):
    scores = v.quality.select("product_idx", F.round("quality_score", 6).alias("quality_score"))
    return v.products.select("product_idx", "product_name").join(scores, "product_idx")


@query("rank_number", """
SELECT product_idx, row_number() OVER (ORDER BY list_price DESC, product_idx)::INTEGER AS rank
FROM products ORDER BY list_price DESC, product_idx LIMIT 50""", ["products"])
def _(v: Views):
    best = ordering.ranked_top(v.products, [F.desc("list_price"), F.asc("product_idx")], 50)
    return best.select("product_idx", "rank")


@query("topk_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank
FROM orders QUALIFY rank <= 3""")
def _(v: Views):
    rows = v.table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ordering.topk(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("top_products", """
SELECT product_idx, product_name, price, rating, review_count, category,
 coalesce(rating, 0) * review_count AS score
FROM products ORDER BY score DESC, product_idx LIMIT 10""", ["products"])
def _(v: Views):
    scored = v.products.withColumn("score", N.rank_score("rating", "review_count"))
    cols = ["product_idx", "product_name", "price", "rating", "review_count", "category", "score"]
    return ordering.take_first(scored.select(cols), 10, F.desc("score"), "product_idx")


@query("union_sources", """
SELECT product_id, product_name, source, category, price, rating FROM (
 SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY no) AS rn FROM (
  SELECT 0 AS no, product_id, product_name, source, category, price, rating FROM features
   WHERE source = 'catalogue'
  UNION ALL SELECT 1, product_id, product_name, 'marketplace', category, price, NULL FROM products
  UNION ALL SELECT 2, product_id, product_name, 'reviews', NULL, NULL, rating FROM reviews)
 WHERE length(product_name) > 3) WHERE rn = 1""", ["products", "features", "reviews"])
def _(v: Views):
    first = v.features.where("source = 'catalogue'")
    second = v.products.withColumns({"source": F.lit("marketplace"), "rating": F.lit(None)})
    third = v.reviews.withColumn("source", F.lit("reviews"))
    rows = cleaning.combine([first, second, third], ["product_name"])
    return rows.select("product_id", "product_name", "source", "category", "price", "rating")


@query("unpivot_trends", """
SELECT strftime(date, '%Y-%m-%d') AS date, category AS keyword, search_interest FROM (
 SELECT d.date, k.category, sum(demand) FILTER (e.category = k.category) AS search_interest
 FROM (SELECT DISTINCT date FROM event_demand) d CROSS JOIN (SELECT DISTINCT category FROM event_demand) k
 JOIN event_demand e ON e.date = d.date GROUP BY ALL)""", ["event_demand"])
def _(v: Views):
    wide = (
        v.event_demand.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        .groupBy("date").pivot("category").agg(F.sum("demand"))
        .withColumn("isPartial", F.lit(False))
    )
    return files.unpivot_trends(wide)


@query("set_overlap", """
SELECT doc_id, len(list_intersect(a, b))::BIGINT AS shared,
 len(list_distinct(list_concat(a, b)))::BIGINT AS combined
FROM (SELECT doc_id, list_distinct(list_filter(string_split_regex(lower(text), '[ \\t\\n\\r\\f]+'), lambda w: w <> '')) AS a,
 ['the', 'of', 'and', 'der', 'die', 'la', 'le', 'el'] AS b FROM documents)""")
def _(v: Views):
    common = F.array(*[F.lit(w) for w in ("the", "of", "and", "der", "die", "la", "le", "el")])
    shared, combined = X.overlap(X.words(F.lower("text")), common)
    return v.table("documents").select("doc_id", shared.alias("shared"), combined.alias("combined"))


_CUT = {0.7: evaluate.share_cut(0.7), 0.85: evaluate.share_cut(0.7 + 0.15)}


@query("split_70_15_15", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN h < '{_CUT[0.7]}' THEN 'train' WHEN h < '{_CUT[0.85]}' THEN 'validation'
 ELSE 'test' END AS part
FROM (SELECT *, substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 8) AS h FROM lineitem)""")
def _(v: Views):
    rows = v.table("lineitem").select("l_orderkey", "l_linenumber")
    return evaluate.split(rows, ["l_orderkey", "l_linenumber"])


@query("balanced_sample", """
SELECT category, product_idx FROM (
 SELECT *, row_number() OVER (PARTITION BY category ORDER BY h, product_idx) AS rn,
  count(*) OVER (PARTITION BY category) AS size
 FROM (SELECT category, product_idx, md5('42|' || product_idx) AS h FROM products))
WHERE rn <= (SELECT greatest(floor(400 / count(DISTINCT category)), 50) FROM products)
ORDER BY size DESC, category, h, product_idx LIMIT 400""", ["products"])
def _(v: Views):
    rows = v.products.select("category", "product_idx")
    return evaluate.balanced_sample(rows, "category", "product_idx", 400)
