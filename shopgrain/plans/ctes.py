"""The views of ``views`` as SQL, written from the same formulas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from shopgrain.functions import dictionaries as D


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rows(values: Iterable[Sequence]) -> str:
    """VALUES list of strings and numbers."""
    return ", ".join(
        "(" + ", ".join(text(v) if isinstance(v, str) else repr(v) for v in r) + ")" for r in values
    )


def keyword_rows(dictionary: Mapping[str, Sequence[str]]) -> str:
    return rows((i, name, kw) for i, (name, kws) in enumerate(dictionary.items()) for kw in kws)


def words_in(values: Sequence[str]) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def clean(expr: str) -> str:
    return (
        "coalesce(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
        f"lower({expr}), '<[^>]+>', '', 'g'), 'http\\S+|www\\S+', '', 'g'), "
        "'[^a-zA-Z0-9\\s.,!?]', ' ', 'g'), '\\s+', ' ', 'g')), '')"
    )


def tokens(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '\\s+'), lambda w: w <> '')"


def half_even(expr: str, digits: int) -> str:
    """Rounding with halves to the even neighbour."""
    x = f"(({expr}) * {10**digits})"
    return (
        f"(CASE WHEN {x} - floor({x}) = 0.5 AND floor({x}) % 2 = 0 THEN floor({x}) ELSE round({x}) END"
        f" / {10**digits})"
    )


_SUFFIX = """CASE doc_id % 9
 WHEN 0 THEN ' Great camera, great battery life and the best screen. I love it!'
 WHEN 1 THEN ' The delivery was terrible and the box arrived broken. Not good.'
 WHEN 2 THEN ' Paid $1,299.99 for this Samsung laptop, see https://shop.example/x?id=1 now'
 WHEN 4 THEN ' Very bad plastic build, waste of money!!!!'
 WHEN 5 THEN ' WORST AWFUL CHEAP speaker ever'
 WHEN 6 THEN ' <b>Nice</b> sony headphone with bluetooth and usb, price $49.50 or $39.00'
 WHEN 7 THEN ' yoga gym shoes, never disappointed, but extremely expensive'
 ELSE '' END"""

# Name -> (views it reads, body).
# A valence after degree words and negations among the three words before it.
_MOVES = f"""
h1 AS (SELECT *, (v0 + sign(v0) * CASE WHEN w1 IN {words_in(D.INTENSIFIERS)} THEN 0.293
   WHEN w1 IN {words_in(D.DAMPENERS)} THEN -0.293 ELSE 0 END)
  * CASE WHEN w1 IN {words_in(D.NEGATIONS)} THEN -0.74 ELSE 1 END AS v1 FROM hit),
h2 AS (SELECT *, (v1 + sign(v0) * CASE WHEN w2 IN {words_in(D.INTENSIFIERS)} THEN 0.293 * 0.95
   WHEN w2 IN {words_in(D.DAMPENERS)} THEN -0.293 * 0.95 ELSE 0 END)
  * CASE WHEN w2 IN {words_in(D.NEGATIONS)} THEN -0.74 ELSE 1 END AS v2 FROM h1),
h3 AS (SELECT *, (v2 + sign(v0) * CASE WHEN w3 IN {words_in(D.INTENSIFIERS)} THEN 0.293 * 0.9
   WHEN w3 IN {words_in(D.DAMPENERS)} THEN -0.293 * 0.9 ELSE 0 END)
  * CASE WHEN w3 IN {words_in(D.NEGATIONS)} THEN -0.74 ELSE 1 END AS v3 FROM h2)
"""

VIEWS: dict[str, tuple[Sequence[str], str]] = {
    "products0": ((), """
SELECT p_partkey AS product_idx, 'P' || p_partkey AS product_id, p_name AS product_name,
 p_type AS category, p_brand AS brand,
 CASE p_partkey % 3 WHEN 0 THEN 'catalogue' WHEN 1 THEN 'marketplace' ELSE 'reviews' END AS source,
 p_retailprice AS list_price,
 CASE WHEN p_partkey % 17 = 5 THEN NULL WHEN p_partkey % 23 = 7 THEN 0.0
  ELSE floor(p_retailprice * (100 - p_size)) / 100.0 END::DOUBLE AS price,
 CASE WHEN p_partkey % 13 <> 0 THEN ((p_partkey * 7) % 51) / 10.0 END::DOUBLE AS rating,
 coalesce(n, 0) AS review_count,
 CASE p_partkey % 10 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS is_bestseller,
 CASE p_partkey % 4 WHEN 0 THEN 'http://img/' || p_partkey WHEN 1 THEN 'https://img/' || p_partkey
  WHEN 2 THEN 'ftp://img/' || p_partkey END AS image_url
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) c
 ON p_partkey = l_partkey"""),
    "products": (("products0",), f"""
SELECT *, CASE WHEN list_price = 0 THEN CASE WHEN price > 0 THEN 0.0 END
 WHEN price IS NULL THEN NULL
 ELSE {half_even('greatest(0, least(100, (list_price - price) / list_price * 100))', 1)} END AS discount_pct
FROM products0"""),
    "raw_catalogue": (("products",), """
SELECT product_id AS asin,
 CASE WHEN product_idx % 19 = 0 THEN NULL WHEN product_idx % 19 = 1 THEN 'abc' ELSE product_name END AS title,
 coalesce(rating::VARCHAR, 'n/a') AS stars,
 CASE WHEN product_idx % 29 = 3 THEN 'many' ELSE format('{:,}', review_count * 37) END AS reviews,
 CASE WHEN price IS NULL THEN 'nan' ELSE '$' || format('{:,.2f}', price) END AS price,
 'Rs. ' || format('{:,.2f}', list_price) AS "listPrice",
 CASE WHEN is_bestseller THEN 'true' WHEN NOT is_bestseller THEN 'false' END AS "isBestSeller",
 category AS category_id, image_url AS "imgUrl"
FROM products"""),
    "features0": (("products",), """
SELECT *, coalesce(price, (SELECT median(price) FROM products)) AS filled FROM products"""),
    "features": (("features0",), f"""
SELECT * EXCLUDE (is_bestseller, filled),
 coalesce(is_bestseller, false) AS is_bestseller,
 {half_even("""coalesce(rating, 3.0) / 5.0 /
  (ln(1 + CASE WHEN filled = 0 THEN (SELECT median(filled) FROM features0) ELSE filled END) + 1) * 100""", 2)}
  AS value_score,
 {half_even("""least(100, review_count /
  ((SELECT quantile_cont(review_count::DOUBLE, 0.95) FROM features0) + 1) * 100)""", 2)} AS popularity_score,
 CASE WHEN coalesce(discount_pct, 0) <= 0 THEN 'No Discount' WHEN discount_pct <= 10 THEN 'Low'
  WHEN discount_pct <= 25 THEN 'Medium' WHEN discount_pct <= 50 THEN 'High'
  ELSE 'Very High' END AS discount_tier,
 CASE WHEN coalesce(rating, 3.0) <= 0 OR rating > 5 THEN NULL WHEN coalesce(rating, 3.0) <= 2 THEN 'Poor'
  WHEN coalesce(rating, 3.0) <= 3 THEN 'Below Average' WHEN rating <= 4 THEN 'Average'
  WHEN rating <= 4.5 THEN 'Good' ELSE 'Excellent' END AS rating_tier,
 coalesce(length(product_name), 0)::BIGINT AS title_length,
 coalesce(len(list_filter(string_split_regex(product_name, '\\s+'), lambda w: w <> '')), 0)::BIGINT
  AS title_word_count,
 CASE WHEN coalesce(rating, 3.0) = 0 THEN NULL
  ELSE {half_even('coalesce(price, 0) / coalesce(rating, 3.0)', 2)} END AS price_per_rating
FROM features0"""),
    "product_scores": (("enriched",), """
SELECT substr(product_id, 2)::BIGINT AS product_idx, sentiment_compound, sentiment_label, fake_review_score, product_risk_tier,
 features_mentioned, clean_review FROM enriched WHERE product_id LIKE 'S%'"""),
    "enriched_products": (("products", "product_scores"), """
SELECT * FROM products JOIN product_scores USING (product_idx)"""),
    "quality0": (("features", "product_scores"), """
SELECT *, greatest(1, least(5, coalesce(rating, 3.0))) AS qr, ln(1 + review_count) AS qp,
 coalesce(value_score, 50.0) AS qv FROM features JOIN product_scores USING (product_idx)"""),
    "quality": (("quality0",), """
SELECT *, 0.35 * rating_score + 0.20 * popularity_part + 0.20 * value_part
 + 0.15 * ((sentiment_compound + 1) / 2) + 0.10 * (1 - fake_review_score / 100) AS quality_score
FROM (SELECT * EXCLUDE (qr, qp, qv),
  CASE WHEN max(qr) OVER () = min(qr) OVER () THEN 0
   ELSE (qr - min(qr) OVER ()) / (max(qr) OVER () - min(qr) OVER ()) END AS rating_score,
  CASE WHEN max(qp) OVER () = min(qp) OVER () THEN 0
   ELSE (qp - min(qp) OVER ()) / (max(qp) OVER () - min(qp) OVER ()) END AS popularity_part,
  CASE WHEN max(qv) OVER () = min(qv) OVER () THEN 0
   ELSE (qv - min(qv) OVER ()) / (max(qv) OVER () - min(qv) OVER ()) END AS value_part
 FROM quality0)"""),
    "reviews": ((), f"""
SELECT 'R' || doc_id AS product_id, p_name AS product_name, text || {_SUFFIX} AS review_text,
 CASE WHEN doc_id % 12 <> 0 THEN doc_id % 6 END::DOUBLE AS rating
FROM documents LEFT JOIN part ON p_partkey = doc_id % (SELECT count(*) FROM part)
UNION ALL
SELECT 'S' || p_partkey, p_name, CASE p_partkey % 8 WHEN 0 THEN 'best best love !!!!' WHEN 1 THEN 'ok'
 WHEN 2 THEN 'Great!!!! Perfect!!!!' WHEN 3 THEN 'buy buy buy buy buy buy buy now'
 WHEN 4 THEN NULL WHEN 5 THEN '   ' WHEN 6 THEN 'BAD BAD AWFUL product'
 ELSE 'Nice ' || p_name || ' for the kitchen' END,
 CASE WHEN p_partkey % 11 <> 0 THEN (p_partkey // 8) % 6 END::DOUBLE FROM part"""),
    "cleaned": (("reviews",), f"""
SELECT *, trim(clean_title || ' ' || clean_review) AS combined_text FROM (
 SELECT *, {clean('product_name')} AS clean_title, {clean('review_text')} AS clean_review FROM reviews)"""),
    "category_hits": (("cleaned",), f"""
SELECT product_id, arg_max(name, score * 1000 - ord) AS predicted_category FROM (
 SELECT product_id, ord, name, count(*) AS score FROM cleaned
 JOIN (VALUES {keyword_rows(D.CATEGORY_KEYWORDS)}) k(ord, name, kw) ON contains(combined_text, kw)
 GROUP BY ALL) GROUP BY 1"""),
    "brand_hits": (("cleaned",), f"""
SELECT product_id, arg_min(title, ord) AS brand_extracted FROM cleaned
JOIN (VALUES {rows((i, b, b.title()) for i, b in enumerate(D.BRANDS))}) k(ord, brand, title)
 ON contains(combined_text, brand) GROUP BY 1"""),
    "feature_hits": (("cleaned",), f"""
SELECT product_id, string_agg(name, ',' ORDER BY ord) AS features_mentioned, count(*) AS feature_count
FROM (SELECT DISTINCT product_id, ord, name FROM cleaned
 JOIN (VALUES {keyword_rows(D.FEATURE_KEYWORDS)}) k(ord, name, kw) ON contains(combined_text, kw))
GROUP BY 1"""),
    "aspect_rows": (("cleaned",), f"""
SELECT product_id, name AS aspect, CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative'
 ELSE 'neutral' END AS polarity
FROM (SELECT DISTINCT product_id, name FROM cleaned
 JOIN (VALUES {keyword_rows(D.ASPECT_KEYWORDS)}) k(ord, name, kw) ON contains(combined_text, kw)
 WHERE length(combined_text) >= 5)
JOIN (SELECT product_id,
  count(DISTINCT w) FILTER (w IN {words_in(D.POSITIVE_WORDS)}) AS pos,
  count(DISTINCT w) FILTER (w IN {words_in(D.NEGATIVE_WORDS)}) AS neg
 FROM (SELECT product_id, unnest(string_split_regex(regexp_replace(combined_text, '[.,!?]', ' ', 'g'), '\\s+')) AS w
  FROM cleaned) GROUP BY 1) USING (product_id)"""),
    "facts": (("cleaned", "category_hits", "brand_hits", "feature_hits"), f"""
SELECT product_id, product_name, review_text, clean_title, clean_review, combined_text, rating,
 length(combined_text)::BIGINT AS text_length,
 len({tokens('combined_text')})::BIGINT AS word_count,
 length(clean_review) > 10 AS has_review,
 coalesce(predicted_category, 'Other') AS predicted_category,
 coalesce(brand_extracted, 'Unknown') AS brand_extracted,
 try_cast(replace(regexp_extract(review_text, '\\$([\\d,]+\\.?\\d*)', 1), ',', '') AS DOUBLE) AS price_mentioned,
 coalesce(features_mentioned, 'none') AS features_mentioned, coalesce(feature_count, 0) AS feature_count
FROM cleaned LEFT JOIN category_hits USING (product_id) LEFT JOIN brand_hits USING (product_id)
LEFT JOIN feature_hits USING (product_id)"""),
    "senti_words": (("cleaned",), """
SELECT product_id, combined_text, list_filter(list_transform(string_split(combined_text, ' '),
 lambda w: regexp_replace(w, '^[.,!?]+|[.,!?]+$', '', 'g')), lambda w: length(w) > 1) AS t FROM cleaned"""),
    "senti_hits": (("senti_words",), f"""
WITH spots AS (SELECT product_id, t, coalesce(list_position(t, 'but'), 0) AS but,
  unnest(range(1, len(t) + 1)) AS i FROM senti_words WHERE len(t) > 0),
hit AS (SELECT product_id, but, i, valence AS v0, CASE WHEN i > 1 THEN t[i - 1] END AS w1,
  CASE WHEN i > 2 THEN t[i - 2] END AS w2, CASE WHEN i > 3 THEN t[i - 3] END AS w3
 FROM spots JOIN (VALUES {rows(D.SEED_LEXICON.items())}) x(word, valence) ON t[i] = word),
{_MOVES}SELECT product_id, i AS pos, (v3 * CASE WHEN but > 0 AND i < but THEN 0.5 WHEN but > 0 AND i > but THEN 1.5
 ELSE 1 END)::DOUBLE AS v FROM h3"""),
    "sentiment": (("senti_words", "senti_hits"), """
SELECT product_id,
 coalesce(CASE WHEN ok THEN round(p / (p + g + u), 4) END, 0.0)::DOUBLE AS sentiment_positive,
 coalesce(CASE WHEN ok THEN round(g / (p + g + u), 4) END, 0.0)::DOUBLE AS sentiment_negative,
 coalesce(CASE WHEN ok THEN round(u / (p + g + u), 4) END, 1.0)::DOUBLE AS sentiment_neutral,
 coalesce(CASE WHEN ok THEN round(c / sqrt(c * c + 15), 4) END, 0.0)::DOUBLE AS sentiment_compound
FROM (SELECT product_id, length(trim(combined_text)) >= 3 AND n IS NOT NULL AS ok,
  s + CASE WHEN s > 0 THEN bang WHEN s < 0 THEN -bang ELSE 0 END AS c,
  ps + CASE WHEN ps > ng THEN bang ELSE 0 END AS p, ng + CASE WHEN ng > ps THEN bang ELSE 0 END AS g,
  (len(t) - n)::DOUBLE AS u
 FROM (SELECT *, least(length(combined_text) - length(replace(combined_text, '!', '')), 4) * 0.292 AS bang
  FROM senti_words)
 LEFT JOIN (SELECT product_id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS ps,
   sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS ng, count(*) FILTER (v <> 0) AS n
  FROM senti_hits GROUP BY 1) USING (product_id))"""),
    "lexicon_entries": (("senti_words",), """
SELECT DISTINCT w AS word, ((length(w) * 5 + ascii(w)) % 9 - 4)::DOUBLE AS valence
FROM (SELECT unnest(t) AS w FROM senti_words) WHERE (length(w) * 7 + ascii(w)) % 11 < 2
UNION SELECT t[1] || ' ' || t[2], (length(t[1] || t[2]) % 9 - 4.5)::DOUBLE FROM senti_words WHERE len(t) >= 2
UNION SELECT t[2] || ' ' || t[3] || ' ' || t[4], (length(t[3]) % 7 - 3.5)::DOUBLE FROM senti_words WHERE len(t) >= 4"""),
    "lexicon_hits": (("senti_words", "lexicon_entries"), f"""
WITH spots AS (SELECT product_id, t, coalesce(list_position(t, 'but'), 0) AS but,
  unnest(range(1, len(t) + 1)) AS i FROM senti_words WHERE len(t) > 0),
parts AS (SELECT product_id, but, i, n, array_to_string(t[i:i + n - 1], ' ') AS word, CASE WHEN i > 1 THEN t[i - 1] END AS w1,
  CASE WHEN i > 2 THEN t[i - 2] END AS w2, CASE WHEN i > 3 THEN t[i - 3] END AS w3
 FROM spots, (VALUES (1), (2), (3)) l(n) WHERE i + n - 1 <= len(t)),
hit AS (SELECT *, valence AS v0 FROM (SELECT *, max(n) OVER (PARTITION BY product_id, i) AS most,
  max(i + n) OVER (PARTITION BY product_id ORDER BY i RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM parts JOIN lexicon_entries USING (word)) WHERE n = most AND coalesce(reach, 0) <= i),
{_MOVES}SELECT product_id, n, (v3 * CASE WHEN but > 0 AND i < but THEN 0.5 WHEN but > 0 AND i > but THEN 1.5
 ELSE 1 END)::DOUBLE AS v FROM h3"""),
    "labelled": (("sentiment",), """
SELECT *, CASE WHEN sentiment_compound >= 0.05 THEN 'Positive' WHEN sentiment_compound <= -0.05
 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label FROM sentiment"""),
    "fake_batch": (("facts",), f"""
SELECT *, fake_review_score >= 50 AS fake_review_flag FROM (
SELECT *, least(100, CASE WHEN length(clean_review) < 20 AND rating = 5 THEN 30 ELSE 0 END
 + CASE WHEN length(clean_review) - length(replace(clean_review, '!', '')) > 3 THEN 15 ELSE 0 END
 + CASE WHEN len(w) > 5 AND len(list_distinct(w)) / len(w) < 0.5 THEN 25 ELSE 0 END
 + CASE WHEN len(w) > 0 AND len(list_filter(w, lambda x: x IN {words_in(D.GENERIC_BATCH)})) / len(w) > 0.4
  THEN 20 ELSE 0 END
 + CASE WHEN length(clean_review) > 0 AND length(clean_review) < 50 AND feature_count = 0 THEN 10 ELSE 0 END
 )::BIGINT AS fake_review_score
FROM (SELECT *, {tokens('clean_review')} AS w FROM facts))"""),
    "enriched": (("fake_batch", "labelled"), f"""
SELECT *, {half_even("""(sentiment_compound + 1) * 25 + least(feature_count, 5) * 5
  + least(word_count, 100) / 100 * 25""", 2)} AS nlp_quality_score,
 CASE WHEN risk >= 60 THEN 'High Risk' WHEN risk >= 30 THEN 'Medium Risk' ELSE 'Low Risk' END AS product_risk_tier
FROM (SELECT *, CASE WHEN fake_review_score > 60 THEN 40 WHEN fake_review_score > 30 THEN 20 ELSE 0 END
  + CASE WHEN sentiment_compound < -0.2 THEN 30 ELSE 0 END
  + CASE WHEN rating <> 0 AND rating < 2.5 THEN 30 ELSE 0 END AS risk
 FROM fake_batch JOIN labelled USING (product_id))"""),
    "interactions": ((), """
SELECT o_custkey AS user_id, l_partkey AS item_id, round(1 + avg(l_quantity) * 4 / 50, 1) AS score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""),
    "daily": ((), """
SELECT p_type AS category, l_shipdate::DATE AS date, sum(l_quantity) AS demand
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""),
    "spine": (("daily",), """
SELECT category, date, coalesce(demand, 0)::DOUBLE AS demand
FROM (SELECT category, unnest(generate_series((SELECT min(date) FROM daily)::TIMESTAMP,
  (SELECT max(date) FROM daily)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date
 FROM (SELECT DISTINCT category FROM daily))
LEFT JOIN daily USING (category, date)"""),
    "event_demand": ((), """
SELECT event_type AS category, ts::DATE AS date, count(*)::DOUBLE AS demand FROM events GROUP BY ALL"""),
    "vectors": ((), """
SELECT vec_id AS item_id, embedding::DOUBLE[] AS vector, 'C' || label AS category,
 ((vec_id * 7) % 51) / 10.0 AS rating, (vec_id % 100)::DOUBLE AS price FROM embeddings"""),
}


def with_views(needs: Sequence[str], body: str) -> str:
    """Body with the views it needs, and theirs, in front."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in VIEWS[name][0]:
                visit(other)
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in order)
    # A body with its own WITH continues the list.
    stripped = body.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if stripped.upper().startswith(start):
            return start + parts + ",\n" + stripped[len(start):]
    return "WITH " + parts + "\n" + stripped
