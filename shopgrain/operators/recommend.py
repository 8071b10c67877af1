"""Hybrid recommendation: content, collaborative and quality scores.

A request names items, users or texts. Scores that need a shared term or a common
user come from joins; all other items can only rank by quality, so the best by
quality complete the list and no request meets every item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.operators.checkpoints import materialise
from shopgrain.operators.factors import Factors, truncated_svd
from shopgrain.operators.ordering import ranked_top, topk
from shopgrain.operators.tfidf import project, sparse_cosine
from shopgrain.operators.vectors import similarity_range, vector_search

# Weights of the hybrid score.
COLLAB_WEIGHT, CONTENT_WEIGHT, QUALITY_WEIGHT = 0.30, 0.45, 0.25
OTHER_CATEGORY_QUERY, OTHER_CATEGORY_PROFILE = 0.3, 0.1


def l2_normalise(df: DataFrame, by: str, col: str, out: str = "value") -> DataFrame:
    """Divide by the group's Euclidean norm; a norm of 0 counts as 1."""
    norms = df.groupBy(by).agg(F.sqrt(F.sum(F.col(col) * F.col(col))).alias("_norm"))
    norm = F.when(F.col("_norm") == 0, F.lit(1.0)).otherwise(F.col("_norm"))
    return df.join(norms, by).withColumn(out, F.col(col) / norm).drop("_norm")


def collaborative(interactions: DataFrame, rank: int = 50, **options) -> Factors:
    """User and item factors of the row-normalised interactions."""
    unit = l2_normalise(interactions, "user_id", "score")
    return truncated_svd(unit, "user_id", "item_id", "value", rank, **options)


def hits(recs: DataFrame, relevant: DataFrame) -> DataFrame:
    """Recommended pairs that are relevant."""
    return recs.join(relevant.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")


def exclude_seen(scores: DataFrame, seen: DataFrame) -> DataFrame:
    """Pairs the user has not seen yet."""
    return scores.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def cooccurrence(interactions: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """Items used by the same users as each anchor item, by cosine of their columns.

    Only users of an anchor are followed, so each interaction is met at most once per
    anchor its user has, and no user's items are paired with each other.
    """
    norms = interactions.groupBy("item_id").agg(
        F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("norm")
    )
    asked = materialise(anchors.select("item_id"), "anchors")
    mine = interactions.join(asked, "item_id").select(
        F.col("item_id").alias("anchor"), "user_id", F.col("score").alias("_a")
    )
    dots = (
        mine.join(interactions, "user_id").where("item_id <> anchor")
        .groupBy("anchor", "item_id").agg(F.sum(F.col("_a") * F.col("score")).alias("dot"))
    )
    anchor_norms = norms.select(F.col("item_id").alias("anchor"), F.col("norm").alias("_an"))
    raw = (
        dots.join(norms, "item_id").join(anchor_norms, "anchor")
        .select("anchor", "item_id", (F.col("dot") / (F.col("norm") * F.col("_an"))).alias("_raw"))
    )
    best = topk(raw, ["anchor"], [F.desc(F.round("_raw", 6)), F.asc("item_id")], k)
    return best.select("anchor", "item_id", F.round("_raw", 4).alias("score"), "rank")


def popular(df: DataFrame, n: int) -> DataFrame:
    """n best by quality score."""
    best = ranked_top(df, [F.desc(F.round("quality_score", 6)), F.asc("product_idx")], n)
    return best.withColumn("score", F.col("quality_score"))


def top_rated(df: DataFrame, n: int) -> DataFrame:
    """n largest ratings, the list shown when nothing else is available."""
    best = ranked_top(df, [F.desc_nulls_last("rating"), F.asc("product_idx")], n)
    return best.withColumn("score", F.coalesce("rating", F.lit(0.0)) / 5.0)


def format_recs(df: DataFrame, name_chars: int = 70) -> DataFrame:
    sentiment = F.col("sentiment_label") if "sentiment_label" in df.columns else F.lit(None)
    return df.select(
        "rank", "product_idx",
        F.left(F.coalesce("product_name", F.lit("")), F.lit(name_chars)).alias("product_name"),
        F.coalesce("category", F.lit("Other")).alias("category"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
        F.round("score", 4).alias("score"),
        F.coalesce(sentiment, F.lit("N/A")).alias("sentiment"),
    )


def _listed(best: DataFrame) -> Column:
    """A short ranked table as one array, for attaching to each request."""
    row = F.struct("product_idx", "category", "quality_score")
    return best.agg(F.collect_list(row)).scalar()


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    """The larger score of a pair that came from both sides, then the k best per request."""
    pairs = scored.groupBy("query_id", "product_idx").agg(F.max("raw").alias("raw"))
    best = topk(pairs, ["query_id"], [F.desc(F.round("raw", 6)), F.asc("product_idx")], k)
    return best.select("query_id", "product_idx", F.round("raw", 4).alias("score"), "rank")


def similar_items(anchors: DataFrame, weights: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """k items like each anchor: content cosine and quality, the anchor itself left out.

    anchors: ``query_id`` (an item id). weights: ``product_idx, term, weight``.
    items: ``product_idx, category, quality_score``. An unknown anchor gets the most
    popular items by quality alone.
    """
    anchors = materialise(anchors.select("query_id"), "anchors")
    mine = weights.withColumnRenamed("product_idx", "query_id").join(anchors, "query_id")
    near = sparse_cosine(materialise(mine, "terms"), weights, "query_id", "product_idx")
    quality = items.select("product_idx", "quality_score")
    shared = near.join(quality, "product_idx").select(
        "query_id", "product_idx",
        (CONTENT_WEIGHT * F.col("cosine") + QUALITY_WEIGHT * F.col("quality_score")).alias("raw"),
    )
    # Without a shared term the score is quality alone: the k+1 best cover every case.
    known = items.select(F.col("product_idx").alias("query_id"), F.lit(True).alias("_known"))
    requests = anchors.join(known, "query_id", "left")
    listed = _listed(popular(items, k + 1))
    rest = requests.select("query_id", "_known", F.inline(listed)).select(
        "query_id", "product_idx",
        (F.when(F.col("_known"), QUALITY_WEIGHT).otherwise(1.0) * F.col("quality_score")).alias("raw"),
    )
    return _ranked(shared.unionByName(rest).where("product_idx <> query_id"), k)


def query_items(
    queries: DataFrame, vocab: DataFrame, weights: DataFrame, items: DataFrame, k: int,
    other_category: float = OTHER_CATEGORY_QUERY,
) -> DataFrame:
    """k items for each text: content cosine and quality, other categories scaled down.

    queries: ``query_id, text, category`` (category may be null).
    """
    projected = project(queries, "query_id", "text", vocab)
    near = sparse_cosine(materialise(projected, "terms"), weights, "query_id", "product_idx")
    wanted = queries.select("query_id", F.col("category").alias("_wanted"))
    factor = F.when(
        F.col("_wanted").isNull() | F.col("category").eqNullSafe(F.col("_wanted")), 1.0
    ).otherwise(other_category)
    shared = (
        near.join(items.select("product_idx", "category", "quality_score"), "product_idx")
        .join(wanted, "query_id")
        .select(
            "query_id", "product_idx",
            ((CONTENT_WEIGHT * F.col("cosine") + QUALITY_WEIGHT * F.col("quality_score")) * factor)
            .alias("raw"),
        )
    )
    # Items without a shared term rank by quality within a category: k of each suffice.
    best = topk(
        items.select("product_idx", "category", "quality_score"), ["category"],
        [F.desc(F.round("quality_score", 6)), F.asc("product_idx")], k, "_rk",
    )
    rest = wanted.select("query_id", "_wanted", F.inline(_listed(best))).select(
        "query_id", "product_idx", (QUALITY_WEIGHT * F.col("quality_score") * factor).alias("raw")
    )
    return _ranked(shared.unionByName(rest), k)


def hidden_from(interactions: DataFrame, users: DataFrame) -> DataFrame:
    """(item_id, users of the request that have seen it): at most the request's size per item."""
    wanted = materialise(users.select("user_id").distinct(), "users")
    asked = interactions.join(wanted, "user_id", "left_semi")
    return asked.groupBy("item_id").agg(F.collect_set("user_id").alias("hidden_from"))


def user_vectors(users: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Users beside their dense rows of the factors.

    Spark takes these rows, which tasks read from blocks, for as small as the list of blocks, and would send all of
    them through the driver. A semi join sends the users at most, and what it finds is written, so its size is known.
    """
    asked = materialise(users.select("user_id"), "users")
    found = materialise(rows.join(asked, "user_id", "left_semi"), "user-vectors")
    return asked.join(found, "user_id", how)


def recommend_users(
    users: DataFrame, factors: Factors, quality: DataFrame, seen: DataFrame, k: int
) -> DataFrame:
    """k unseen items per requested user: scaled collaborative score and quality.

    A user without factors is ranked by quality only. quality: ``item_id,
    quality_score``. Items that no factor describes have a collaborative product of 0.
    """
    size = len(factors.singular_values)
    zeros = F.array_repeat(F.lit(0.0), size)
    wanted = user_vectors(users, factors.rows, "left").select(F.col("user_id").alias("query_id"), "vector")
    # All dense rows of items are needed: they are shuffled, as their size is not known (see user_vectors).
    items = (
        quality.join(factors.cols.hint("merge"), "item_id", "left")
        .join(hidden_from(seen, users), "item_id", "left")
        .select(
            "item_id", F.coalesce("vector", zeros).alias("vector"), "quality_score", "hidden_from"
        )
    )
    # Counted and read by each of the searches below.
    items = materialise(items, "items")
    known = wanted.where(F.col("vector").isNotNull())
    scaled = materialise(similarity_range(known, items), "scaled")
    hybrid = vector_search(
        scaled, items.withColumn("bonus", QUALITY_WEIGHT * F.col("quality_score")).drop("quality_score"),
        k, metric="dot", sim_weight=COLLAB_WEIGHT,
    )
    new = wanted.where(F.col("vector").isNull()).withColumn("vector", zeros)
    plain = vector_search(
        new, items.withColumnRenamed("quality_score", "bonus"), k, metric="dot", sim_weight=0.0
    )
    return hybrid.unionByName(plain)


def recommend_profiles(
    profiles: DataFrame, items: DataFrame, k: int, other_category: float = OTHER_CATEGORY_PROFILE
) -> DataFrame:
    """k items near each profile vector: 0.6 cosine, 0.4 rating; other categories scaled down.

    profiles: ``query_id, vector`` and optionally ``category``. items: ``item_id,
    vector, category, rating``; a missing rating counts as 3.
    """
    bonus = F.coalesce("rating", F.lit(3.0)) / 5.0 * 0.4
    return vector_search(
        profiles, items.select("item_id", "vector", "category", bonus.alias("bonus")), k,
        sim_weight=0.6, other_category=other_category,
    )


def compare_pairs(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Head-to-head per key from (on, product_idx, score); the first wins ties."""
    left = a.select(on, F.col("product_idx").alias("a"), F.col("score").alias("score_a"))
    right = b.select(on, F.col("product_idx").alias("b"), F.col("score").alias("score_b"))
    return left.join(right, on).withColumn(
        "winner", F.when(F.col("score_a") >= F.col("score_b"), F.col("a")).otherwise(F.col("b"))
    )
