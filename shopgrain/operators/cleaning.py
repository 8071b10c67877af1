"""Aligning product sources to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.operators.ordering import dedup_first

# The standard columns and their order.
STANDARD_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("list_price", T.DoubleType()),
        T.StructField("discount_pct", T.DoubleType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("is_bestseller", T.BooleanType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("value_score", T.DoubleType()),
        T.StructField("popularity_score", T.DoubleType()),
        T.StructField("discount_tier", T.StringType()),
        T.StructField("rating_tier", T.StringType()),
        T.StructField("title_length", T.LongType()),
        T.StructField("title_word_count", T.LongType()),
        T.StructField("price_per_rating", T.DoubleType()),
    ]
)

# Raw header -> standard column, per kind of source.
CATALOGUE_COLUMNS = {
    "title": "product_name",
    "stars": "rating",
    "reviews": "review_count",
    "price": "price",
    "listPrice": "list_price",
    "isBestSeller": "is_bestseller",
    "boughtInLastMonth": "bought_last_month",
    "category_id": "category",
    "imgUrl": "image_url",
    "productURL": "product_url",
    "asin": "product_id",
}
MARKETPLACE_COLUMNS = {
    "Name": "product_name",
    "Price": "price",
    "Actual Price": "list_price",
    "Discount (%)": "discount_pct",
    "Type": "category",
}
REVIEW_COLUMNS = {
    "name": "product_name",
    "brand": "brand",
    "categories": "category",
    "reviews.text": "review_text",
    "reviews.rating": "rating",
    "reviews.title": "review_title",
    "reviews.doRecommend": "recommended",
    "reviews.numHelpful": "helpful_votes",
}


def standardise(df: DataFrame, col_map: Mapping[str, str], source: str) -> DataFrame:
    """Rename the columns that are present and tag the source."""
    return df.withColumnsRenamed(dict(col_map)).withColumn("source", F.lit(source))


def keep(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[F.col(f"`{c}`") for c in cols if c in df.columns])


def valid_name(df: DataFrame, col: str = "product_name", min_len: int = 4) -> DataFrame:
    """Drop missing and short names."""
    return df.where(F.length(F.col(col)) >= min_len)


def conform(df: DataFrame, schema: T.StructType = STANDARD_SCHEMA) -> DataFrame:
    """Exactly the columns of the schema, missing ones as typed nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def stamp(df: DataFrame, at) -> DataFrame:
    """Processing time as an argument, so a rerun gives the same table."""
    return df.withColumn("processed_at", F.lit(at).cast("timestamp"))


def combine(
    sources: Sequence[DataFrame], order: Sequence[str | Column], schema: T.StructType = STANDARD_SCHEMA
) -> DataFrame:
    """Stack the sources, clean names, keep the first row per product id.

    Earlier sources win; inside a source the given order decides.
    """
    parts = [
        conform(df, schema).withColumn("_source_no", F.lit(i)) for i, df in enumerate(sources)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    first = dedup_first(valid_name(stacked), ["product_id"], ["_source_no", *order])
    return first.drop("_source_no")


def valid_url(df: DataFrame, col: str = "image_url") -> DataFrame:
    return df.where(F.col(col).isNotNull() & F.col(col).startswith("http"))


def min_rating(df: DataFrame, r: float) -> DataFrame:
    return df.where(F.coalesce("rating", F.lit(0.0)) >= r)


def max_price(df: DataFrame, p: float) -> DataFrame:
    return df.where(F.coalesce("price", F.lit(0.0)) <= p)


def matching_or_all(df: DataFrame, test: Column) -> DataFrame:
    """Rows that pass the test, or every row when none passes.

    The fallback reads one flag: a subquery that stops at the first match.
    """
    found = df.where(test).limit(1).agg(F.count("*")).scalar()
    return df.where(F.coalesce(test, F.lit(False)) | (found == 0))


def category_or_all(df: DataFrame, category: str, col: str = "category") -> DataFrame:
    return matching_or_all(df, F.col(col) == category)


def contains_search(df: DataFrame, query: str, n: int = 8) -> DataFrame:
    """Names containing the query, best ``rating * review_count`` first."""
    hit = F.lower(F.coalesce("product_name", F.lit(""))).contains(query.lower())
    scored = matching_or_all(df, hit).withColumn(
        "score", F.coalesce("rating", F.lit(0.0)) * F.coalesce("review_count", F.lit(0))
    )
    return scored.orderBy(F.desc("score"), "product_idx").limit(n)


def product_detail(df: DataFrame, idx: int) -> DataFrame:
    """One product with null-safe defaults; no row when the index is unknown."""
    zero = F.lit(0.0)

    def have(c, default):
        return F.coalesce(F.col(c), default) if c in df.columns else default

    return df.where(F.col("product_idx") == idx).select(
        "product_idx", "product_id",
        have("product_name", F.lit("")).alias("product_name"),
        have("category", F.lit("Other")).alias("category"),
        have("price", zero).alias("price"),
        have("list_price", zero).alias("list_price"),
        have("discount_pct", zero).alias("discount_pct"),
        have("rating", zero).alias("rating"),
        have("review_count", F.lit(0)).cast("bigint").alias("review_count"),
        have("brand", F.lit("Unknown")).alias("brand"),
        have("sentiment_label", F.lit("N/A")).alias("sentiment"),
        have("fake_review_score", zero).cast("double").alias("fake_score"),
        have("product_risk_tier", F.lit("N/A")).alias("risk_tier"),
        have("image_url", F.lit("")).alias("image_url"),
        have("value_score", zero).alias("value_score"),
    )


def product_index(df: DataFrame) -> DataFrame:
    """The narrow side table that search results are shown from."""
    return df.select("product_idx", "product_id", "product_name", "category", "price", "rating")
