"""Search, similarity and recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.functions import dictionaries as D
from shopgrain.functions import numbers as N
from shopgrain.functions import textual as X
from shopgrain.operators import evaluate, factors, ordering, recommend, search, tfidf, vector_index, vectors
from shopgrain.operators.checkpoints import materialise, new_path
from shopgrain.plans import ctes
from shopgrain.plans.registry import query
from shopgrain.plans.views import Views
from shopgrain.sources.files import local_table

COSINE = "list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


@query("keyword_search", """
SELECT row_number() OVER (ORDER BY round(raw, 6) DESC, product_idx)::INTEGER AS rank, product_id,
 product_name, category, coalesce(price, 0) AS price, coalesce(rating, 0) AS rating, round(raw, 4) AS score,
 sentiment_label AS sentiment, coalesce(image_url, '') AS image_url
FROM (SELECT *, len(list_intersect(list_distinct(string_split(lower(product_name), ' ')), ['best', 'red', 'ring']))
  / 4 * 0.7 + coalesce(nullif(rating, 0), 3) / 5 * 0.3 AS raw
 FROM enriched_products WHERE coalesce(rating, 0) >= 1 AND coalesce(price, 0) <= 900)
WHERE raw > 0 ORDER BY round(raw, 6) DESC, product_idx LIMIT 25""", ["enriched_products"])
def _(v: Views):
    return search.keyword_search(
        v.labelled_products, "Best red ring", k=25, category="no such", min_rating=1.0, max_price=900.0
    )


def label_centroids(v: Views):
    """One query per label: the mean vector of all items that carry it."""
    members = v.vectors.select(F.col("category").alias("query_id"), "item_id", F.lit(1).alias("n"))
    return vectors.mean_vectors(members, v.vectors.select("item_id", "vector"), "query_id")


_CENTROIDS = """
centroid AS (SELECT query_id, list(x ORDER BY pos) AS q FROM (
 SELECT category AS query_id, pos, avg(vector[pos]) AS x
 FROM (SELECT *, unnest(range(1, len(vector) + 1)) AS pos FROM vectors) GROUP BY ALL) GROUP BY 1)"""


def _nearest(raw: str, source: str = "vectors", k: int | None = 5, digits: int = 4) -> str:
    cut = "" if k is None else f"\nQUALIFY rank <= {k}"
    return f"""
WITH {_CENTROIDS}
SELECT query_id, item_id, round(raw, {digits}) AS score,
 row_number() OVER (PARTITION BY query_id ORDER BY round(raw, 6) DESC, item_id)::INTEGER AS rank
FROM (SELECT query_id, item_id, {raw} AS raw FROM centroid, {source}){cut}"""


_COS = COSINE.format(a="q", b="vector")


@query("vector_search", _nearest(_COS), ["vectors"])
def _(v: Views):
    return vectors.vector_search(label_centroids(v), v.vectors.select("item_id", "vector"), 5)


@query("query_x_item_scores", _nearest("list_dot_product(q, vector)", k=None), ["vectors"])
def _(v: Views):
    items = v.vectors.select("item_id", "vector")
    return vectors.vector_search(label_centroids(v), items, None, metric="dot")


@query("filtered_vector_search", f"""
WITH {_CENTROIDS}, ask AS (SELECT *, CASE WHEN query_id = 'C0' THEN 'no such' WHEN query_id <> 'C1'
  THEN 'C' || (substr(query_id, 2)::INTEGER + 1) % 10 END AS wanted FROM centroid),
pool AS (SELECT * FROM vectors WHERE rating >= 1 AND price <= 80),
pairs AS (SELECT query_id, item_id, {_COS} AS raw FROM ask, pool
 WHERE wanted IS NULL OR category = wanted OR wanted NOT IN (SELECT category FROM pool))
SELECT query_id, item_id, round(raw, 3) AS score,
 row_number() OVER (PARTITION BY query_id ORDER BY round(raw, 6) DESC, item_id)::INTEGER AS rank
FROM pairs QUALIFY rank <= 5""", ["vectors"])
def _(v: Views):
    number = F.substring("query_id", 2, 9).cast("int")
    wanted = F.when(number == 0, "no such").when(
        number != 1, F.concat(F.lit("C"), ((number + 1) % 10).cast("string"))
    )
    pool = v.vectors.where("rating >= 1 AND price <= 80").select("item_id", "vector", "category")
    return vectors.vector_search(
        label_centroids(v).withColumn("category", wanted), pool, 5, other_category=None, digits=3
    )


@query("approx_vector_search")
def _(v: Views):
    """Through a stored index: cells are trained, vectors filed by cell, and only probed cells read."""
    asked, path = materialise(label_centroids(v), "centroids"), new_path(v.spark, "vector-index")
    index = vector_index.build(v.vectors.select("item_id", "vector"), path, k=5, asked=asked)
    return vector_index.search(v.spark, index, asked, 5)


# Terms of the published index, and components of its content and its user vectors.
INDEX_TERMS, CONTENT_RANK, USER_RANK = 8000, 150, 50

_TERMS = f"""
term_tokens AS (SELECT doc_id AS key, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
  lambda w: length(w) > 1 AND w NOT IN {ctes.words_in(D.STOP_WORDS)}) AS t FROM documents),
term_rows AS (SELECT key, unnest(t) AS term FROM term_tokens
 UNION ALL SELECT key, t[i] || ' ' || t[i + 1] FROM (SELECT key, t, unnest(range(1, len(t))) AS i
  FROM term_tokens WHERE len(t) > 1)),
term_n AS (SELECT key, term, count(*) AS tf FROM term_rows GROUP BY ALL),
vocab AS (SELECT term, count(*) AS df, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
 FROM term_n GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 8000),
term_w AS (SELECT key, term, (1 + ln(tf)) * idf AS w FROM term_n JOIN vocab USING (term)),
weights AS (SELECT key, term, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS weight FROM term_w)"""


@query("tfidf_vectors", f"WITH {_TERMS} SELECT key AS doc_id, term, round(weight, 6) AS weight FROM weights")
def _(v: Views):
    weights, _ = tfidf.tfidf(v.documents, "doc_id", "text", INDEX_TERMS)
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def product_content(v: Views):
    """Names, categories, brands, reviews and mentioned features of products as content text."""
    columns = ("product_name", "category", "brand", "clean_review", "features_mentioned")
    rows = v.stored_products.join(v.product_scores, "product_idx")
    return rows.select("product_idx", X.content_text(*map(F.col, columns)).alias("content"))


_CONTENT = f"""
ptok AS (SELECT product_idx AS key, list_filter(string_split_regex(lower(concat_ws(' ', product_name, product_name,
  category, brand, CASE WHEN length(clean_review) > 10 THEN clean_review END,
  CASE WHEN features_mentioned <> 'none' THEN replace(features_mentioned, ',', ' ') END)), '[^\\p{{L}}\\p{{N}}_]+'),
  lambda w: length(w) > 1 AND w NOT IN {ctes.words_in(D.STOP_WORDS)}) AS t FROM enriched_products),
prow AS (SELECT key, unnest(t) AS term FROM ptok UNION ALL SELECT key, t[i] || ' ' || t[i + 1]
 FROM (SELECT key, t, unnest(range(1, len(t))) AS i FROM ptok WHERE len(t) > 1)),
pn AS (SELECT key, term, count(*) AS tf FROM prow GROUP BY ALL),
pvocab AS (SELECT term, ln((1 + (SELECT count(*) FROM products)) / (1 + count(*))) + 1 AS idf
 FROM pn GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 8000),
pw AS (SELECT key, term, (1 + ln(tf)) * idf AS w FROM pn JOIN pvocab USING (term)),
pweights AS (SELECT key, term, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS weight FROM pw)"""


def category_leaders(v: Views):
    """The product with most reviews of each category."""
    rows = v.stored_products.select("category", "product_idx", "review_count")
    return ordering.topk(rows, ["category"], [F.desc("review_count"), F.asc("product_idx")], 1)


_LEADERS = """
leaders AS (SELECT product_idx AS anchor FROM products
 QUALIFY row_number() OVER (PARTITION BY category ORDER BY review_count DESC, product_idx) = 1)"""


@query("similar_items", f"""
WITH {_CONTENT}, {_LEADERS},
near AS (SELECT anchor, b.key AS product_idx, sum(a.weight * b.weight) AS cosine FROM leaders
 JOIN pweights a ON a.key = anchor JOIN pweights b USING (term) GROUP BY ALL),
pairs AS (SELECT anchor, q.product_idx, 0.45 * coalesce(cosine, 0) + 0.25 * quality_score AS raw
 FROM leaders CROSS JOIN quality q LEFT JOIN near n USING (anchor, product_idx) WHERE q.product_idx <> anchor
 UNION ALL SELECT -1, product_idx, quality_score FROM quality)
SELECT anchor AS query_id, product_idx, round(raw, 4) AS score,
 row_number() OVER (PARTITION BY anchor ORDER BY round(raw, 6) DESC, product_idx)::INTEGER AS rank
FROM pairs QUALIFY rank <= 10""", ["products", "quality", "enriched_products"])
def _(v: Views):
    weights, _ = tfidf.tfidf(product_content(v), "product_idx", "content", INDEX_TERMS)
    # Read for the anchors and again for all items.
    weights = materialise(weights, "weights")
    anchors = category_leaders(v).select(F.col("product_idx").alias("query_id"))
    unknown = v.spark.range(1).select(F.lit(-1).cast("bigint").alias("query_id"))
    return recommend.similar_items(anchors.unionByName(unknown), weights, v.stored_quality, 10)


REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)
REQUESTS = [
    (1, "shiny red ring for a small gear", "PROMO"),
    (2, "old cold anvil", "no such"),
    (3, "large hot bolt economy", None),
    (4, "nothing in common", "STANDARD"),
]


@query("query_items", f"""
WITH {_CONTENT}, ask(query_id, text, wanted) AS (VALUES (1::BIGINT, 'shiny red ring for a small gear', 'PROMO'),
 (2, 'old cold anvil', 'no such'), (3, 'large hot bolt economy', NULL), (4, 'nothing in common', 'STANDARD')),
qt AS (SELECT query_id, list_filter(string_split(text, ' '), lambda w: length(w) > 1
  AND w NOT IN {ctes.words_in(D.STOP_WORDS)}) AS t FROM ask),
qr AS (SELECT query_id, unnest(t) AS term FROM qt UNION ALL
 SELECT query_id, t[i] || ' ' || t[i + 1] FROM (SELECT query_id, t, unnest(range(1, len(t))) AS i FROM qt)),
qw AS (SELECT query_id, term, (1 + ln(count(*))) * any_value(idf) AS w FROM qr JOIN pvocab USING (term) GROUP BY ALL),
qn AS (SELECT query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS qweight FROM qw),
near AS (SELECT query_id, key AS product_idx, sum(qweight * weight) AS cosine FROM qn JOIN pweights USING (term) GROUP BY ALL),
pairs AS (SELECT query_id, product_idx, (0.45 * coalesce(cosine, 0) + 0.25 * quality_score)
  * CASE WHEN wanted IS NULL OR category = wanted THEN 1 ELSE 0.3 END AS raw
 FROM ask CROSS JOIN quality LEFT JOIN near USING (query_id, product_idx))
SELECT query_id, product_idx, round(raw, 4) AS score,
 row_number() OVER (PARTITION BY query_id ORDER BY round(raw, 6) DESC, product_idx)::INTEGER AS rank
FROM pairs QUALIFY rank <= 10""", ["products", "quality", "enriched_products"])
def _(v: Views):
    weights, vocab = tfidf.tfidf(product_content(v), "product_idx", "content", INDEX_TERMS)
    asks = local_table(v.spark, REQUESTS, REQUEST_SCHEMA)
    return recommend.query_items(asks, vocab, weights, v.stored_quality, 10)


@query("reduce_vectors")
def _(v: Views):
    weights, _ = tfidf.tfidf(product_content(v), "product_idx", "content", INDEX_TERMS)
    return factors.truncated_svd(weights, "product_idx", "term", "weight", rank=CONTENT_RANK).rows


@query("explained_variance")
def _(v: Views):
    weights, _ = tfidf.tfidf(product_content(v), "product_idx", "content", INDEX_TERMS)
    svd = factors.truncated_svd(weights, "product_idx", "term", "weight", rank=CONTENT_RANK)
    rows = [(i + 1, s, e) for i, (s, e) in enumerate(zip(svd.singular_values, svd.explained_variance))]
    return v.spark.createDataFrame(rows, "component int, singular_value double, variance_share double")


@query("l2_row_normalise", """
SELECT user_id, item_id, round(score / sqrt(sum(score * score) OVER (PARTITION BY user_id)), 6) AS value
FROM interactions""", ["interactions"])
def _(v: Views):
    unit = recommend.l2_normalise(v.stored_interactions, "user_id", "score")
    return unit.select("user_id", "item_id", F.round("value", 6).alias("value"))


@query("cooccurrence_scores", f"""
WITH {_LEADERS}, norms AS (SELECT item_id, sqrt(sum(score * score)) AS norm FROM interactions GROUP BY 1),
raw AS (SELECT anchor, b.item_id, sum(a.score * b.score) AS dot FROM leaders JOIN interactions a ON a.item_id = anchor
 JOIN interactions b USING (user_id) WHERE b.item_id <> anchor GROUP BY ALL),
cos AS (SELECT anchor, r.item_id, dot / (x.norm * y.norm) AS raw FROM raw r JOIN norms x USING (item_id)
 JOIN norms y ON y.item_id = anchor)
SELECT anchor, item_id, round(raw, 4) AS score,
 row_number() OVER (PARTITION BY anchor ORDER BY round(raw, 6) DESC, item_id)::INTEGER AS rank
FROM cos QUALIFY rank <= 10""", ["products", "interactions"])
def _(v: Views):
    anchors = category_leaders(v).select(F.col("product_idx").alias("item_id"))
    return recommend.cooccurrence(v.stored_interactions, anchors, 10)


def segment_leaders(v: Views):
    """The customer with most items of each market segment."""
    sizes = v.stored_interactions.groupBy("user_id").agg(F.count("*").alias("n"))
    people = v.table("customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    rows = people.join(sizes, "user_id")
    best = ordering.topk(rows, ["c_mktsegment"], [F.desc("n"), F.asc("user_id")], 1)
    return best.select("user_id")


@query("collaborative_scores")
def _(v: Views):
    return recommend.collaborative(v.stored_interactions, rank=USER_RANK).rows


@query("user_x_item_scores")
def _(v: Views):
    model = recommend.collaborative(v.stored_interactions, rank=USER_RANK)
    asked = recommend.user_vectors(segment_leaders(v), model.rows).withColumnRenamed("user_id", "query_id")
    return vectors.vector_search(asked, model.cols, 10, metric="dot")


@query("recommend_user")
def _(v: Views):
    model = recommend.collaborative(v.stored_interactions, rank=USER_RANK)
    new = v.spark.range(1).select(F.lit(-1).cast("bigint").alias("user_id"))
    users = segment_leaders(v).unionByName(new)
    quality = v.stored_quality.select(F.col("product_idx").alias("item_id"), "quality_score")
    return recommend.recommend_users(users, model, quality, v.stored_interactions, 10)


@query("recommend_from_profile", """
WITH ev AS (SELECT user_id, event_type, json_extract_string(props, '$.k')::BIGINT AS item_id FROM events),
pick AS (SELECT user_id, event_type FROM (SELECT user_id, event_type, count(*) AS n FROM ev GROUP BY ALL)
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) = 1),
prof AS (SELECT query_id, list(x ORDER BY pos) AS q FROM (SELECT event_type AS query_id, pos, avg(vector[pos]) AS x FROM (
  SELECT p.event_type, vector, unnest(range(1, len(vector) + 1)) AS pos FROM pick p JOIN ev USING (user_id)
  JOIN vectors USING (item_id)) GROUP BY ALL) GROUP BY 1),
pairs AS (SELECT query_id, item_id, (0.6 * """ + _COS + """ + 0.4 * rating / 5)
  * CASE WHEN query_id = 'view' OR category = CASE query_id WHEN 'click' THEN 'C3' ELSE 'C7' END THEN 1 ELSE 0.1 END AS raw
 FROM prof, vectors)
SELECT query_id, item_id, round(raw, 4) AS score,
 row_number() OVER (PARTITION BY query_id ORDER BY round(raw, 6) DESC, item_id)::INTEGER AS rank
FROM pairs QUALIFY rank <= 10""", ["vectors"])
def _(v: Views):
    seen = v.table("events").select(
        "user_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("item_id")
    )
    # The most active user of each event type, then all items of that user.
    sizes = seen.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    picked = ordering.topk(sizes, ["event_type"], [F.desc("n"), F.asc("user_id")], 1)
    members = (
        seen.drop("event_type").join(picked.select("event_type", "user_id"), "user_id")
        .groupBy(F.col("event_type").alias("query_id"), "item_id").agg(F.count("*").alias("n"))
    )
    profiles = vectors.mean_vectors(members, v.vectors.select("item_id", "vector"), "query_id")
    kind = F.col("query_id")
    wanted = F.when(kind == "click", "C3").when(kind != "view", "C7")
    return recommend.recommend_profiles(profiles.withColumn("category", wanted), v.vectors, 10)


@query("popular_items", """
SELECT product_idx, round(quality_score, 6) AS score,
 row_number() OVER (ORDER BY round(quality_score, 6) DESC, product_idx)::INTEGER AS rank
FROM quality QUALIFY rank <= 20""", ["quality"])
def _(v: Views):
    return recommend.popular(v.quality, 20).select("product_idx", F.round("score", 6).alias("score"), "rank")


@query("top_rated", """
SELECT product_idx, rating, coalesce(rating, 0) / 5 AS score,
 row_number() OVER (ORDER BY rating DESC NULLS LAST, product_idx)::INTEGER AS rank FROM products QUALIFY rank <= 20""",
       ["products"])
def _(v: Views):
    return recommend.top_rated(v.products, 20).select("product_idx", "rating", "score", "rank")


@query("format_recommendations", """
SELECT row_number() OVER (ORDER BY rating DESC NULLS LAST, product_idx)::INTEGER AS rank, product_idx,
 left(product_name, 70) AS product_name, category, coalesce(price, 0) AS price, coalesce(rating, 0) AS rating,
 round(coalesce(rating, 0) / 5, 4) AS score, sentiment_label AS sentiment
FROM enriched_products QUALIFY rank <= 10""", ["enriched_products"])
def _(v: Views):
    return recommend.format_recs(recommend.top_rated(v.labelled_products, 10))


@query("compare_products", """
WITH s AS (SELECT category, product_idx, round(coalesce(rating, 0) * 20 + (100 - fake_review_score) * 0.3
 + least(review_count, 300000) / 300000 * 30, 6) AS score,
 row_number() OVER (PARTITION BY category ORDER BY review_count DESC, product_idx) AS rk FROM enriched_products)
SELECT a.category, a.product_idx AS a, b.product_idx AS b, a.score AS score_a, b.score AS score_b,
 CASE WHEN a.score >= b.score THEN a.product_idx ELSE b.product_idx END AS winner
FROM s a JOIN s b ON a.category = b.category AND a.rk = 1 AND b.rk = 2""", ["enriched_products"])
def _(v: Views):
    rows = v.enriched_products.select("category", "product_idx", "rating", "review_count", "fake_review_score")
    best = ordering.topk(rows, ["category"], [F.desc("review_count"), F.asc("product_idx")], 2)
    scored = best.withColumn(
        "score", F.round(N.compare_score(F.col("rating"), F.col("fake_review_score"), F.col("review_count")), 6)
    )
    return recommend.compare_pairs(scored.where("rank = 1"), scored.where("rank = 2"), "category")


@query("semi_relevant_hits", """
SELECT user_id, item_id FROM (SELECT o_custkey AS user_id, l_partkey AS item_id FROM orders JOIN lineitem
 ON o_orderkey = l_orderkey WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
JOIN (SELECT user_id, item_id FROM interactions WHERE score >= 3) USING (user_id, item_id)""", ["interactions"])
def _(v: Views):
    urgent = v.table("orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")
    recs = urgent.join(v.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    )
    return recommend.hits(recs.distinct(), v.stored_interactions.where("score >= 3"))


@query("anti_seen_items", """
SELECT user_id, item_id, score FROM interactions ANTI JOIN (
 SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey
 WHERE o_orderpriority = '1-URGENT') USING (user_id, item_id)""", ["interactions"])
def _(v: Views):
    urgent = v.table("orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")
    seen = urgent.join(v.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    )
    return recommend.exclude_seen(v.stored_interactions, seen)


_HELD = f"substr(md5('42|' || user_id || '|' || item_id), 1, 8) < '{evaluate.share_cut(0.3)}'"


@query("holdout_by_user", f"""
SELECT user_id, item_id, CASE WHEN {_HELD} THEN 'held out' ELSE 'train' END AS part FROM interactions""",
       ["interactions"])
def _(v: Views):
    train, held = evaluate.holdout(v.stored_interactions)
    return (
        train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("held out")))
        .select("user_id", "item_id", "part")
    )


def segment_recommendations(v: Views, train, k: int):
    """From each market segment's most used items the first k that the user has not met.

    A user with n items has met n of the first k + n of any list at most, so these are all that is looked at.
    """
    met = train.groupBy("user_id").agg(F.count("*").alias("met"))
    most = met.agg(F.max("met")).first()[0] or 0
    people = v.table("customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    uses = train.join(people, "user_id").groupBy("c_mktsegment", "item_id").agg(F.count("*").alias("n"))
    listed = ordering.topk(uses, ["c_mktsegment"], [F.desc("n"), F.asc("item_id")], k + most, "place")
    listed = materialise(listed, "segment-lists")
    reach = F.col("place") <= k + F.coalesce("met", F.lit(0))
    offered = people.join(met, "user_id", "left").join(listed, "c_mktsegment").where(reach)
    open_items = recommend.exclude_seen(offered.select("user_id", "item_id", "place"), train)
    return ordering.topk(open_items, ["user_id"], [F.asc("place")], k).select("user_id", "item_id", "rank")


@query("ranking_metrics", f"""
WITH held AS (SELECT * FROM interactions WHERE {_HELD}), train AS (SELECT * FROM interactions WHERE NOT ({_HELD})),
rel AS (SELECT user_id, item_id FROM held JOIN (SELECT user_id, median(score) AS m FROM interactions GROUP BY 1)
 USING (user_id) WHERE score >= m),
uses AS (SELECT c_mktsegment, item_id, count(*) AS n FROM train JOIN customer ON c_custkey = user_id GROUP BY ALL),
listed AS (SELECT c_mktsegment, item_id, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, item_id) AS place
 FROM uses),
recs AS (SELECT c_custkey AS user_id, item_id, row_number() OVER (PARTITION BY c_custkey ORDER BY place) AS rank
 FROM customer JOIN listed USING (c_mktsegment)
 ANTI JOIN train ON train.user_id = c_custkey AND train.item_id = listed.item_id QUALIFY rank <= 10),
hit AS (SELECT user_id, count(*) AS h, sum(1 / log2(rank + 1)) AS dcg FROM recs JOIN rel USING (user_id, item_id) GROUP BY 1),
per AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY 1),
ideal AS (SELECT k, sum(1 / log2(k + 1)) OVER (ORDER BY k) AS idcg FROM range(1, 11) t(k)),
m AS (SELECT count(*) AS users, avg(coalesce(h, 0) / 10) AS p, avg(coalesce(h, 0) / n_rel) AS r,
 avg(coalesce(dcg, 0) / idcg) AS n FROM per LEFT JOIN hit USING (user_id) JOIN ideal ON k = least(n_rel, 10))
SELECT users, round(p, 6) AS precision_at_k, round(r, 6) AS recall_at_k, round(n, 6) AS ndcg_at_k,
 round(2 * p * r / (p + r + 1e-8), 6) AS f1_at_k FROM m""", ["interactions"])
def _(v: Views):
    train, held = evaluate.holdout(v.stored_interactions)
    recs = segment_recommendations(v, train, 10)
    out = evaluate.ranking_metrics(recs, evaluate.relevant_items(v.stored_interactions, held), 10)
    return out.select("users", *[F.round(c, 6).alias(c) for c in out.columns if c != "users"])


def keyword_hits(v: Views, k: int = 5):
    """Hits of each request text by its TF-IDF query, with product details."""
    weights, vocab = tfidf.tfidf(product_content(v), "product_idx", "content", INDEX_TERMS)
    asks = local_table(v.spark, REQUESTS, REQUEST_SCHEMA)
    near = tfidf.sparse_cosine(
        tfidf.project(asks, "query_id", "text", vocab), weights, "query_id", "product_idx"
    )
    best = ordering.topk(near, ["query_id"], [F.desc(F.round("cosine", 6)), F.asc("product_idx")], k)
    hits = best.join(v.stored_products, "product_idx").withColumn("score", F.round("cosine", 3))
    return asks, hits


_HITS = f"""
{_CONTENT}, ask(query_id, text) AS (VALUES (1::BIGINT, 'shiny red ring for a small gear'),
 (2, 'old cold anvil'), (3, 'large hot bolt economy'), (4, 'nothing in common')),
qt AS (SELECT query_id, list_filter(string_split(text, ' '), lambda w: length(w) > 1
  AND w NOT IN {ctes.words_in(D.STOP_WORDS)}) AS t FROM ask),
qr AS (SELECT query_id, unnest(t) AS term FROM qt UNION ALL
 SELECT query_id, t[i] || ' ' || t[i + 1] FROM (SELECT query_id, t, unnest(range(1, len(t))) AS i FROM qt)),
qw AS (SELECT query_id, term, (1 + ln(count(*))) * any_value(idf) AS w FROM qr JOIN pvocab USING (term) GROUP BY ALL),
qn AS (SELECT query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS qweight FROM qw),
near AS (SELECT query_id, key AS product_idx, sum(qweight * weight) AS cosine FROM qn JOIN pweights USING (term) GROUP BY ALL),
hits AS (SELECT query_id, product_idx, round(cosine, 3) AS score,
 row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 6) DESC, product_idx) AS rank,
 product_name, category, coalesce(price, 0.0) AS price, coalesce(rating, 0.0) AS rating
 FROM near JOIN products USING (product_idx) QUALIFY rank <= 5)"""

_CONTEXT = """
context AS (SELECT query_id, string_agg('\nProduct ' || rank || ': ' || left(product_name, 60) || ' | $'
 || printf('%.2f', round(price, 2)) || ' | Rating: ' || printf('%.1f', round(rating, 1)) || '/5 | Category: '
 || category || '\n', '' ORDER BY rank) AS context FROM hits GROUP BY 1)"""


def _filled(hits):
    return hits.withColumns(
        {"price": F.coalesce("price", F.lit(0.0)), "rating": F.coalesce("rating", F.lit(0.0))}
    )


@query("build_context", f"WITH {_HITS}, {_CONTEXT} SELECT query_id, context FROM context", ["products", "enriched_products"])
def _(v: Views):
    return search.build_context(_filled(keyword_hits(v)[1]), style="line")


@query("chat_last_turns", """
SELECT conv_id, string_agg('User: ' || ask || '\nAssistant: ' || reply || '\n\n', '' ORDER BY turn) AS history
FROM (SELECT a.conv_id, a.turn, a.text AS ask, b.text AS reply FROM conversations a JOIN conversations b
  ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant'
 QUALIFY row_number() OVER (PARTITION BY a.conv_id ORDER BY a.turn DESC) <= 3) GROUP BY 1""")
def _(v: Views):
    return search.last_turns(v.table("conversations"))


def _sql_text(value: str) -> str:
    return ctes.text(value)


@query("build_prompt", f"""
WITH {_HITS}, {_CONTEXT},
pairs AS (SELECT a.conv_id, a.turn, a.text AS ask, b.text AS reply FROM conversations a JOIN conversations b
 ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant'),
history AS (SELECT conv_id, string_agg('User: ' || ask || '\nAssistant: ' || reply || '\n\n', '' ORDER BY turn) AS history
 FROM (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3) GROUP BY 1)
SELECT query_id, {_sql_text(search.PROMPT_HEAD)} || coalesce(context, '') || '\n\nHISTORY:\n' || coalesce(history, '')
 || '\n\nQUESTION: ' || text || '\n' || {_sql_text(search.PROMPT_TAIL)} AS prompt
FROM ask LEFT JOIN context USING (query_id) LEFT JOIN history ON conv_id = query_id""", ["products", "enriched_products"])
def _(v: Views):
    asks, hits = keyword_hits(v)
    history = search.last_turns(v.table("conversations")).withColumnRenamed("conv_id", "query_id")
    rows = (
        asks.select("query_id", F.col("text").alias("question"))
        .join(search.build_context(_filled(hits), style="line"), "query_id", "left")
        .join(history, "query_id", "left")
    )
    return search.build_prompt(rows).select("query_id", "prompt")


@query("fallback_answer", f"""
WITH {_HITS}
SELECT query_id, coalesce(n, 0) AS n_sources, CASE WHEN n IS NULL THEN 'I couldn''t find relevant products for your query.'
 ELSE 'Based on our database, I found ' || n || ' relevant products. Top match: ' || left(product_name, 50) || ' at $'
 || printf('%.2f', round(price, 2)) || ' with ' || printf('%.1f', round(rating, 1)) || '/5 rating.' END AS answer
FROM ask LEFT JOIN (SELECT query_id, count(*) AS n FROM hits GROUP BY 1) USING (query_id)
LEFT JOIN (SELECT * FROM hits WHERE rank = 1) USING (query_id)""", ["products", "enriched_products"])
def _(v: Views):
    asks, hits = keyword_hits(v)
    return search.fallback_answer(asks.select("query_id"), hits)


@query("batch_queries", f"""
WITH {_HITS}
SELECT query_id, text, coalesce(n, 0) AS n_retrieved, coalesce(product_name, '') AS top_product
FROM ask LEFT JOIN (SELECT query_id, count(*) AS n FROM hits GROUP BY 1) USING (query_id)
LEFT JOIN (SELECT query_id, product_name FROM hits WHERE rank = 1) USING (query_id)""", ["products", "enriched_products"])
def _(v: Views):
    asks, hits = keyword_hits(v)
    return search.batch_queries(asks.select("query_id", "text"), hits)
