"""Text functions, sentiment, review trust and risk."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopgrain.functions import dictionaries as D
from shopgrain.functions import textual as X
from shopgrain.functions import trust
from shopgrain.operators import reports, search, sentiment
from shopgrain.operators.checkpoints import materialise, new_path
from shopgrain.plans import ctes
from shopgrain.plans.registry import query
from shopgrain.plans.views import MATCHER, Views
from shopgrain.sources import files


@query("clean_text", f"""
SELECT 'p' || page_id AS id, {ctes.clean('html')} AS clean FROM pages
UNION ALL SELECT 'd' || doc_id, {ctes.clean('text')} FROM documents""")
def _(v: Views):
    pages = files.spread(v.table("pages")).select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), X.clean_text("html").alias("clean")
    )
    docs = v.documents.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), X.clean_text("text").alias("clean")
    )
    return pages.unionByName(docs)


@query("combine_text", "SELECT product_id, combined_text FROM cleaned", ["cleaned"])
def _(v: Views):
    return v.cleaned.select("product_id", "combined_text")


@query("text_stats", "SELECT product_id, text_length, word_count, has_review FROM facts", ["facts"])
def _(v: Views):
    return v.cleaned.select(
        "product_id",
        F.length("combined_text").cast("bigint").alias("text_length"),
        X.word_count("combined_text").alias("word_count"),
        (F.length("clean_review") > 10).alias("has_review"),
    )


@query("category_by_keywords", "SELECT product_id, predicted_category FROM facts", ["facts"])
def _(v: Views):
    label = X.classify(MATCHER.found("hits"), D.CATEGORY_KEYWORDS)
    return v.matched.select("product_id", label.alias("predicted_category"))


@query("category_weighted", f"""
SELECT product_id, coalesce(best, 'Other') AS category_fixed FROM cleaned LEFT JOIN (
 SELECT product_id, arg_max(name, score * 1000 - ord) AS best FROM (
  SELECT product_id, ord, name, sum(CASE WHEN length(kw) > 4 THEN 2 ELSE 1 END) AS score FROM cleaned
  JOIN (VALUES {ctes.keyword_rows(D.RECOMMENDER_KEYWORDS)}) k(ord, name, kw) ON contains(combined_text, kw)
  GROUP BY ALL) GROUP BY 1) USING (product_id)""", ["cleaned"])
def _(v: Views):
    label = X.classify(MATCHER.found("hits"), D.RECOMMENDER_KEYWORDS, X.long_word_weight)
    return v.matched.select("product_id", label.alias("category_fixed"))


@query("brand_first_match", "SELECT product_id, brand_extracted FROM facts", ["facts"])
def _(v: Views):
    brand = X.extract_brand(MATCHER.found("hits"), D.BRANDS)
    return v.matched.select("product_id", brand.alias("brand_extracted"))


@query("extract_price_mention", "SELECT product_id, price_mentioned FROM facts", ["facts"])
def _(v: Views):
    return v.reviews.select("product_id", X.first_price("review_text").alias("price_mentioned"))


@query("feature_mentions", "SELECT product_id, features_mentioned FROM facts", ["facts"])
def _(v: Views):
    names = X.mentions(MATCHER.found("hits"), D.FEATURE_KEYWORDS)
    return v.matched.withColumn("names", names).select(
        "product_id", X.mention_list("names").alias("features_mentioned")
    )


@query("feature_count", "SELECT product_id, feature_count FROM facts", ["facts"])
def _(v: Views):
    names = X.mentions(MATCHER.found("hits"), D.FEATURE_KEYWORDS)
    return v.matched.select("product_id", F.size(names).cast("bigint").alias("feature_count"))


@query("aspect_sentiment", """
SELECT product_id, coalesce(string_agg(aspect || '=' || polarity, ',' ORDER BY aspect), '') AS aspects
FROM cleaned LEFT JOIN aspect_rows USING (product_id) GROUP BY 1""", ["cleaned", "aspect_rows"])
def _(v: Views):
    entries = F.array_sort(F.map_entries("aspect_sentiments"))
    return v.dictionary_stage.select(
        "product_id",
        F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
        .alias("aspects"),
    )


@query("explode_aspects", "SELECT product_id, aspect, polarity FROM aspect_rows", ["aspect_rows"])
def _(v: Views):
    return reports.explode_aspects(v.dictionary_stage, "product_id")


@query("lexicon_join", """
SELECT product_id, pos::INTEGER - 1 AS pos, round(v, 6) AS valence FROM senti_hits""", ["senti_hits"])
def _(v: Views):
    hits = sentiment.token_valences(v.cleaned, "product_id", "combined_text", v.lexicon)
    return hits.select("product_id", "pos", F.round("valence", 6).alias("valence"))


@query("sentiment_score", """
SELECT product_id, sentiment_positive, sentiment_negative, sentiment_neutral, sentiment_compound
FROM sentiment""", ["sentiment"])
def _(v: Views):
    return v.sentiment.drop("sentiment_label")


@query("sentiment_lexicon", """
SELECT product_id, coalesce(CASE WHEN ok THEN round(c / sqrt(c * c + 15), 4) END, 0.0)::DOUBLE AS sentiment_compound,
 coalesce(CASE WHEN ok THEN round((size - n) / (ps + ng + size - n
  + CASE WHEN ps <> ng THEN bang ELSE 0 END), 4) END, 1.0)::DOUBLE AS sentiment_neutral
FROM (SELECT product_id, length(trim(combined_text)) >= 3 AND s IS NOT NULL AS ok, bang, ps, ng, n, len(t) AS size,
  s + CASE WHEN s > 0 THEN bang WHEN s < 0 THEN -bang ELSE 0 END AS c
 FROM (SELECT *, least(length(combined_text) - length(replace(combined_text, '!', '')), 4) * 0.292 AS bang
  FROM senti_words)
 LEFT JOIN (SELECT product_id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS ps,
   sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS ng, coalesce(sum(n) FILTER (v <> 0), 0) AS n
  FROM lexicon_hits GROUP BY 1) USING (product_id))""", ["senti_words", "lexicon_hits"])
def _(v: Views):
    """Sentiment by a lexicon file of thousands of entries, some of two and three words."""
    t = F.col("t")
    # Read for the lexicon and again for the scores.
    cleaned = materialise(v.cleaned.select("product_id", "combined_text"), "cleaned")
    texts = cleaned.select(sentiment.token_lists(F.col("combined_text")).alias("t"))
    t, n, pos, word = (F.col(c) for c in ("t", "n", "pos", "word"))

    def phrase(first: int, size: int, least: int):
        found = F.array(F.array_join(F.slice(t, first, size), " "))
        return F.when(n >= least, found).otherwise(F.array().cast("array<string>"))

    # All words of a text, and behind them a pair and a triple.
    spots = texts.select("t", F.size("t").alias("n"), F.length(F.get(t, F.lit(2))).alias("middle"))
    spots = spots.select("n", "middle", F.posexplode(F.concat(t, phrase(1, 2, 2), phrase(2, 3, 4))).alias("pos", "word"))
    spots = spots.where((pos >= n) | ((F.length(word) * 7 + F.ascii(word)) % 11 < 2))
    valence = F.when(pos < n, ((F.length(word) * 5 + F.ascii(word)) % 9 - 4).cast("double"))
    valence = valence.when(pos == n, (F.length(word) - 1) % 9 - 4.5).otherwise(F.col("middle") % 7 - 3.5)
    entries = spots.select(word, valence.alias("valence"))
    path = new_path(v.spark, "lexicon")
    entries.distinct().write.option("sep", "\t").csv(path)
    lexicon = materialise(sentiment.scan_lexicon(v.spark, path), "lexicon")
    scores = sentiment.sentiment(cleaned, "product_id", "combined_text", lexicon)
    return scores.select("product_id", "sentiment_compound", "sentiment_neutral")


@query("sentiment_label", "SELECT product_id, sentiment_label FROM labelled", ["labelled"])
def _(v: Views):
    return v.sentiment.select("product_id", "sentiment_label")


@query("sentiment_confidence", """
SELECT product_id, 'This text is ' || lower(sentiment_label) || ' (confidence: '
 || printf('%.1f', round(abs(sentiment_compound) * 100, 1)) || '%)' AS summary FROM labelled""", ["labelled"])
def _(v: Views):
    return v.sentiment.select(
        "product_id", X.sentiment_summary("sentiment_label", "sentiment_compound").alias("summary")
    )


@query("attach_scores", """
SELECT product_id, product_name, sentiment_compound, sentiment_label
FROM reviews JOIN labelled USING (product_id)""", ["reviews", "labelled"])
def _(v: Views):
    scored = sentiment.sentiment(v.cleaned, "product_id", "combined_text", v.lexicon, carry=["product_name"])
    return scored.select("product_id", "product_name", "sentiment_compound", "sentiment_label")


@query("content_text", """
SELECT product_id, trim(concat_ws(' ', product_name, product_name,
 CASE WHEN predicted_category <> 'Other' THEN predicted_category END,
 CASE WHEN brand_extracted <> 'Unknown' THEN brand_extracted END,
 CASE WHEN length(clean_review) > 10 THEN clean_review END,
 CASE WHEN features_mentioned <> 'none' THEN replace(features_mentioned, ',', ' ') END)) AS content_text
FROM facts""", ["facts"])
def _(v: Views):
    text = X.content_text(
        F.col("product_name"), F.col("predicted_category"), F.col("brand_extracted"),
        F.col("clean_review"), F.col("features_mentioned"),
    )
    return v.dictionary_stage.select("product_id", text.alias("content_text"))


@query("product_document", """
SELECT product_id, 'Product: ' || product_name || '\nCategory: ' || predicted_category || '\nBrand: '
 || brand_extracted || '\nPrice: $' || printf('%.2f', round(coalesce(price_mentioned, 0.0), 2)) || '\nRating: '
 || printf('%.1f', round(coalesce(rating, 0.0), 1)) || '/5.0\nReviews: ' || word_count || ' customer reviews\nSentiment: '
 || sentiment_label || '\nFeatures: ' || CASE WHEN features_mentioned = 'none' THEN 'General product'
  ELSE features_mentioned END || '\nReview excerpt: ' || CASE WHEN length(clean_review) > 5
  THEN clean_review ELSE 'No review available' END AS document
FROM facts JOIN labelled USING (product_id)""", ["facts", "labelled"])
def _(v: Views):
    base = v.dictionary_stage.select(
        "product_id", "product_name", F.col("predicted_category").alias("category"),
        F.col("brand_extracted").alias("brand"), F.col("price_mentioned").alias("price"), "rating",
        F.col("word_count").alias("review_count"), F.col("features_mentioned").alias("features"),
        F.col("clean_review").alias("review_text"), "combined_text",
    )
    carry = [c for c in base.columns if c not in ("product_id", "combined_text")]
    rows = sentiment.sentiment(base, "product_id", "combined_text", v.lexicon, carry)
    return search.product_document(rows).select("product_id", "document")


@query("document_metadata", """
SELECT 'prod_' || product_idx AS id, left(product_name, 100) AS product_name, category,
 coalesce(price, 0) AS price, coalesce(rating, 0) AS rating, brand, sentiment_label AS sentiment, product_idx
FROM enriched_products""", ["enriched_products"])
def _(v: Views):
    return search.document_metadata(v.labelled_products).select("id", "metadata.*")


@query("truncate_display", """
SELECT doc_id, left(text, 60) AS short, left(text, 70) AS name, left(text, 100) AS title, left(text, 200) AS body
FROM documents""")
def _(v: Views):
    return v.table("documents").select(
        "doc_id",
        *[F.left("text", F.lit(n)).alias(c)
          for c, n in (("short", 60), ("name", 70), ("title", 100), ("body", 200))],
    )


@query("fake_score_batch", "SELECT product_id, fake_review_score FROM fake_batch", ["fake_batch"])
def _(v: Views):
    return v.scored.select("product_id", "fake_review_score")


@query("fake_flag", "SELECT product_id, fake_review_flag FROM fake_batch", ["fake_batch"])
def _(v: Views):
    return v.scored.select("product_id", "fake_review_flag")


_API = f"""
SELECT *, least(100, CASE WHEN s1 THEN 25 ELSE 0 END + CASE WHEN s2 THEN 20 ELSE 0 END
 + CASE WHEN s3 THEN 15 ELSE 0 END + CASE WHEN s5 THEN 20 ELSE 0 END + CASE WHEN s6 THEN 15 ELSE 0 END)::BIGINT AS score
FROM (SELECT product_id, rating, t, w, length(t) < 20 AS s1,
 coalesce(rating = 5, false) AND length(t) < 30 AS s2,
 length(t) - length(replace(t, '!', '')) AS bangs, bangs > 3 AS s3,
 len(w) > 5 AND len(list_distinct(w)) / len(w) < 0.5 AS s5,
 len(w) > 0 AND len(list_filter(w, lambda x: x IN {ctes.words_in(D.GENERIC_API)})) / len(w) > 0.35 AS s6
FROM (SELECT product_id, rating, t, {ctes.tokens('t')} AS w
 FROM (SELECT product_id, rating, trim(lower(coalesce(review_text, ''))) AS t FROM reviews)))"""


@query("fake_score_interactive", f"""
SELECT product_id, score AS fake_probability, score >= 50 AS is_suspicious,
 CASE WHEN score >= 70 THEN 'High' WHEN score >= 40 THEN 'Medium' ELSE 'Low' END AS risk_level,
 concat_ws('; ', CASE WHEN s1 THEN 'Very short review' END, CASE WHEN s2 THEN '5-star with minimal text' END,
  CASE WHEN s3 THEN 'Excessive exclamation marks (' || bangs || ')' END,
  CASE WHEN s5 THEN 'High word repetition' END, CASE WHEN s6 THEN 'Generic positive words only' END) AS flags,
 length(t)::BIGINT AS review_length, len(w)::BIGINT AS word_count FROM ({_API})""", ["reviews"])
def _(v: Views):
    report = v.reviews.select("product_id", trust.fake_report("review_text", "rating").alias("r"))
    return report.select(
        "product_id", "r.fake_probability", "r.is_suspicious", "r.risk_level",
        F.array_join("r.flags", "; ").alias("flags"), "r.review_length", "r.word_count",
    )


@query("fake_score_dashboard", f"""
SELECT product_id, least(100, CASE WHEN length(t) < 30 THEN 25 ELSE 0 END
 + CASE WHEN rating = 5 AND length(t) < 40 THEN 20 ELSE 0 END
 + CASE WHEN length(t) - length(replace(t, '!', '')) > 3 THEN 20 ELSE 0 END
 + CASE WHEN len(list_filter(string_split_regex(t, '[^\\p{{L}}\\p{{N}}_]+'),
   lambda x: regexp_full_match(x, '[A-Z]{{2,}}'))) > 2 THEN 15 ELSE 0 END
 + CASE WHEN len(w) > 0 AND len(list_filter(w, lambda x: x IN {ctes.words_in(D.GENERIC_RAW)})) / len(w) > 0.3
  THEN 20 ELSE 0 END)::BIGINT AS score
FROM (SELECT product_id, rating, t, {ctes.tokens('lower(t)')} AS w
 FROM (SELECT product_id, rating, coalesce(review_text, '') AS t FROM reviews))""", ["reviews"])
def _(v: Views):
    return v.reviews.select("product_id", trust.fake_score("review_text", "rating", "raw").alias("score"))


@query("review_recommendation", f"""
SELECT product_id, CASE WHEN score >= 50 THEN 'Flag for manual review' ELSE 'Appears genuine' END AS recommendation
FROM ({_API}) WHERE length(t) >= 3""", ["reviews"])
def _(v: Views):
    return trust.review_verdict(v.reviews).select("product_id", "recommendation")


@query("nlp_quality", "SELECT product_id, nlp_quality_score FROM enriched", ["enriched"])
def _(v: Views):
    return v.enriched.select("product_id", "nlp_quality_score")


@query("risk_tier", "SELECT product_id, product_risk_tier FROM enriched", ["enriched"])
def _(v: Views):
    return v.enriched.select("product_id", "product_risk_tier")
