"""Keyword search, product documents, prompts and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions.textual import words
from shopgrain.operators import cleaning
from shopgrain.operators.ordering import ranked_top, topk


def keyword_search(
    df: DataFrame, query: str, k: int = 10, category: str | None = None,
    min_rating: float = 0.0, max_price: float = 99999.0,
) -> DataFrame:
    """Filters, then word overlap with the query (0.7) and rating (0.3); the k best above 0.

    A rating that is missing or 0 counts as 3.
    """
    wanted = sorted(set(query.lower().split()))
    rows = cleaning.max_price(cleaning.min_rating(df, min_rating), max_price)
    if category:
        rows = cleaning.category_or_all(rows, category)
    have = F.array_distinct(words(F.lower(F.coalesce("product_name", F.lit("")))))
    hits = F.size(F.filter(have, lambda w: w.isin(wanted))) if wanted else F.lit(0)
    rating = F.coalesce(F.nullif(F.col("rating"), F.lit(0.0)), F.lit(3.0))
    raw = hits / F.lit(float(len(wanted) + 1)) * 0.7 + rating / 5.0 * 0.3
    scored = rows.withColumn("_raw", raw).where("_raw > 0")
    best = ranked_top(scored, [F.desc(F.round("_raw", 6)), F.asc("product_idx")], k)
    return best.select(
        "rank", "product_id",
        F.left(F.coalesce("product_name", F.lit("")), F.lit(100)).alias("product_name"),
        F.coalesce("category", F.lit("Other")).alias("category"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
        F.round("_raw", 4).alias("score"),
        _text(df, "sentiment_label", "N/A").alias("sentiment"), _text(df, "image_url", "").alias("image_url"),
    )


def _text(df: DataFrame, name: str, default: str):
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def _money(c):
    """Two digits, rounded before formatting so that halves go up."""
    return F.format_string("%.2f", F.round(c, 2))


def _one_digit(c):
    return F.format_string("%.1f", F.round(c, 1))


def _first(text: Column, chars: int | None) -> Column:
    return text if chars is None else F.left(text, F.lit(chars))


def product_document(df: DataFrame, name_chars: int | None = None, review_chars: int | None = None) -> DataFrame:
    """Product description of nine lines, the text that gets embedded; names and reviews are cut if asked."""
    price = F.coalesce("price", F.lit(0.0))
    rating = F.coalesce("rating", F.lit(0.0))
    features = _text(df, "features", "")
    review = _first(_text(df, "review_text", ""), review_chars)
    lines = [
        F.concat(F.lit("Product: "), _first(_text(df, "product_name", ""), name_chars)),
        F.concat(F.lit("Category: "), _text(df, "category", "General")),
        F.concat(F.lit("Brand: "), _text(df, "brand", "Unknown")),
        F.concat(F.lit("Price: $"), _money(price)),
        F.concat(F.lit("Rating: "), _one_digit(rating), F.lit("/5.0")),
        F.concat(
            F.lit("Reviews: "), F.coalesce("review_count", F.lit(0)).cast("string"),
            F.lit(" customer reviews"),
        ),
        F.concat(F.lit("Sentiment: "), _text(df, "sentiment_label", "Neutral")),
        F.concat(
            F.lit("Features: "),
            F.when(features == "none", F.lit("General product")).otherwise(features),
        ),
        F.concat(
            F.lit("Review excerpt: "),
            F.when(F.length(review) > 5, review).otherwise(F.lit("No review available")),
        ),
    ]
    return df.withColumn("document", F.concat_ws("\n", *lines))


def document_metadata(df: DataFrame) -> DataFrame:
    """Struct stored beside a document, and its id."""
    meta = F.struct(
        F.left(_text(df, "product_name", ""), F.lit(100)).alias("product_name"),
        _text(df, "category", "General").alias("category"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
        _text(df, "brand", "Unknown").alias("brand"),
        _text(df, "sentiment_label", "Neutral").alias("sentiment"),
        F.col("product_idx"),
    )
    return df.withColumn("metadata", meta).withColumn(
        "id", F.concat(F.lit("prod_"), F.col("product_idx").cast("string"))
    )


def build_context(hits: DataFrame, style: str = "document") -> DataFrame:
    """One context text per query from its ranked hits (k of them, so the list is short)."""
    if style == "document":
        block = F.concat(
            F.lit("\nProduct "), F.col("rank").cast("string"), F.lit(" (Similarity: "),
            F.format_string("%.2f", F.round("score", 2)), F.lit("):\n"),
            F.col("document"), F.lit("\n"), F.repeat(F.lit("-"), F.lit(40)), F.lit("\n"),
        )
    else:
        block = F.concat(
            F.lit("\nProduct "), F.col("rank").cast("string"), F.lit(": "),
            F.left("product_name", F.lit(60)), F.lit(" | $"), _money(F.col("price")),
            F.lit(" | Rating: "), _one_digit(F.col("rating")), F.lit("/5 | Category: "),
            F.col("category"), F.lit("\n"),
        )
    packed = hits.select("query_id", F.struct("rank", block.alias("b")).alias("e"))
    listed = packed.groupBy("query_id").agg(F.sort_array(F.collect_list("e")).alias("l"))
    return listed.select(
        "query_id", F.array_join(F.transform("l", lambda e: e["b"]), "").alias("context")
    )


def last_turns(df: DataFrame, n: int = 3) -> DataFrame:
    """The last n question-answer pairs of each conversation as text.

    A pair is a user turn and the assistant turn right after it, found by an equi-join
    on (conversation, turn), so a very long conversation is spread over tasks.
    """
    ask = df.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("ask"))
    reply = df.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    last = topk(ask.join(reply, ["conv_id", "turn"]), ["conv_id"], [F.desc("turn")], n, "_back")
    line = F.concat(
        F.lit("User: "), F.col("ask"), F.lit("\nAssistant: "), F.col("reply"), F.lit("\n\n")
    )
    packed = last.select("conv_id", F.struct("turn", line.alias("t")).alias("e"))
    listed = packed.groupBy("conv_id").agg(F.sort_array(F.collect_list("e")).alias("l"))
    return listed.select(
        "conv_id", F.array_join(F.transform("l", lambda e: e["t"]), "").alias("history")
    )


PROMPT_HEAD = "You are a shopping assistant. Answer from the products listed below.\n\nPRODUCTS:\n"
PROMPT_TAIL = (
    "\nName products with their price and rating, mention low ratings, and say so when no "
    "product fits.\n\nANSWER:"
)


def build_prompt(df: DataFrame) -> DataFrame:
    """Context, history and question in one text; no model is called."""
    none = F.lit("")
    return df.withColumn(
        "prompt",
        F.concat(
            F.lit(PROMPT_HEAD), F.coalesce("context", none),
            F.lit("\n\nHISTORY:\n"), F.coalesce("history", none),
            F.lit("\n\nQUESTION: "), F.col("question"), F.lit("\n"), F.lit(PROMPT_TAIL),
        ),
    )


# Fixed value: the answer without hits.
NO_ANSWER = "I couldn't find relevant products for your query."


def fallback_answer(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Template answer from the best hit and the number of hits, one per query."""
    top = F.struct(
        "rank", "product_name",
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
    )
    found = hits.groupBy("query_id").agg(F.count("*").alias("n_sources"), F.min(top).alias("top"))
    text = F.concat(
        F.lit("Based on our database, I found "), F.col("n_sources").cast("string"),
        F.lit(" relevant products. Top match: "), F.left("top.product_name", F.lit(50)),
        F.lit(" at $"), _money(F.col("top.price")),
        F.lit(" with "), _one_digit(F.col("top.rating")), F.lit("/5 rating."),
    )
    return queries.join(found, "query_id", "left").select(
        *queries.columns,
        F.coalesce("n_sources", F.lit(0)).alias("n_sources"),
        F.coalesce(text, F.lit(NO_ANSWER)).alias("answer"),
    )


def batch_queries(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Per query: how many were retrieved and the best product's name."""
    found = hits.groupBy("query_id").agg(
        F.count("*").alias("n_retrieved"), F.min(F.struct("rank", "product_name")).alias("top")
    )
    return queries.join(found, "query_id", "left").select(
        *queries.columns,
        F.coalesce("n_retrieved", F.lit(0)).alias("n_retrieved"),
        F.coalesce("top.product_name", F.lit("")).alias("top_product"),
    )
