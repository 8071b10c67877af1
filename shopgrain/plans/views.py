"""Product, review, interaction and demand views derived from the test tables.

The tables hold no shop catalogue, so formulas on their keys derive one that reaches
every branch of the operators. ``ctes`` states the same formulas in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions import dictionaries as D
from shopgrain.functions import numbers as N
from shopgrain.functions import textual as X
from shopgrain.functions import trust
from shopgrain.functions.matching import Matcher, words_of
from shopgrain.operators import demand, features, sentiment
from shopgrain.operators.checkpoints import materialise
from shopgrain.sources.files import spread

# Sentences added to documents, which are invented prose, by doc_id % 9.
SUFFIXES = [
    " Great camera, great battery life and the best screen. I love it!",
    " The delivery was terrible and the box arrived broken. Not good.",
    " Paid $1,299.99 for this Samsung laptop, see https://shop.example/x?id=1 now",
    "",
    " Very bad plastic build, waste of money!!!!",
    " WORST AWFUL CHEAP speaker ever",
    " <b>Nice</b> sony headphone with bluetooth and usb, price $49.50 or $39.00",
    " yoga gym shoes, never disappointed, but extremely expensive",
    "",
]
# Short reviews of parts, by p_partkey % 8; the last one is completed with the name.
SHORT_REVIEWS = [
    "best best love !!!!",
    "ok",
    "Great!!!! Perfect!!!!",
    "buy buy buy buy buy buy buy now",
    None,
    "   ",
    "BAD BAD AWFUL product",
]

# All dictionaries of the text stage, found in one pass.
MATCHER = Matcher(
    words_of(D.CATEGORY_KEYWORDS, D.RECOMMENDER_KEYWORDS, D.BRANDS, D.FEATURE_KEYWORDS, D.ASPECT_KEYWORDS)
)


class Views:
    """Lazily built views over one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        return spread(self.table("documents"))

    @cached_property
    def products(self) -> DataFrame:
        lines = self.table("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
        k = F.col("p_partkey")
        price = F.floor(F.col("p_retailprice") * (100 - F.col("p_size"))) / 100.0
        return (
            self.table("part").join(lines, k == F.col("l_partkey"), "left")
            .select(
                k.alias("product_idx"),
                F.concat(F.lit("P"), k.cast("string")).alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p_type").alias("category"),
                F.col("p_brand").alias("brand"),
                F.when(k % 3 == 0, "catalogue").when(k % 3 == 1, "marketplace")
                .otherwise("reviews").alias("source"),
                F.col("p_retailprice").alias("list_price"),
                F.when(k % 17 == 5, None).when(k % 23 == 7, 0.0).otherwise(price).alias("price"),
                F.when(k % 13 != 0, ((k * 7) % 51) / 10.0).alias("rating"),
                F.coalesce("n", F.lit(0)).alias("review_count"),
                F.when(k % 10 == 0, True).when(k % 10 != 1, False).alias("is_bestseller"),
                F.when(k % 4 == 0, F.concat(F.lit("http://img/"), k.cast("string")))
                .when(k % 4 == 1, F.concat(F.lit("https://img/"), k.cast("string")))
                .when(k % 4 == 2, F.concat(F.lit("ftp://img/"), k.cast("string")))
                .alias("image_url"),
            )
            .withColumn("discount_pct", N.discount_pct("price", "list_price"))
        )

    @cached_property
    def raw_catalogue(self) -> DataFrame:
        """The catalogue as text, the way a raw file has it."""
        p = self.products
        k = F.col("product_idx")
        return p.select(
            F.col("product_id").alias("asin"),
            F.when(k % 19 == 0, None).when(k % 19 == 1, "abc").otherwise(F.col("product_name"))
            .alias("title"),
            F.coalesce(F.col("rating").cast("string"), F.lit("n/a")).alias("stars"),
            F.when(k % 29 == 3, "many")
            .otherwise(F.format_number(F.col("review_count") * 37, 0)).alias("reviews"),
            F.coalesce(F.concat(F.lit("$"), F.format_number("price", 2)), F.lit("nan")).alias("price"),
            F.concat(F.lit("Rs. "), F.format_number("list_price", 2)).alias("listPrice"),
            F.when(F.col("is_bestseller"), "true").when(~F.col("is_bestseller"), "false")
            .alias("isBestSeller"),
            F.col("category").alias("category_id"),
            F.col("image_url").alias("imgUrl"),
        )

    @cached_property
    def stored_products(self) -> DataFrame:
        """Products as a written table, for queries that read them several times."""
        return materialise(self.products, "products")

    @cached_property
    def product_sentiment(self) -> DataFrame:
        """Sentiment of each product's own review."""
        own = OwnReviews(self.spark, self.sf_dir)
        return own.sentiment.select(own.product_number, "sentiment_compound", "sentiment_label")

    @cached_property
    def product_scores(self) -> DataFrame:
        """Sentiment, fake score, risk, features and cleaned text of each product's own review."""
        own = OwnReviews(self.spark, self.sf_dir)
        found = own.matched.withColumn("features", X.mentions(MATCHER.found("hits"), D.FEATURE_KEYWORDS))
        found = found.withColumns(
            {"features_mentioned": X.mention_list("features"), "feature_count": F.size("features").cast("bigint")}
        )
        found = found.withColumn("fake_review_score", trust.fake_score("clean_review", "rating", "batch", "feature_count"))
        carry = ["rating", "fake_review_score", "features_mentioned", "clean_review"]
        both = sentiment.sentiment(found, "product_id", "combined_text", own.lexicon, carry)
        return both.select(
            own.product_number, "sentiment_compound", "sentiment_label", "fake_review_score",
            trust.risk_tier("fake_review_score", "sentiment_compound", "rating").alias("product_risk_tier"),
            "features_mentioned", "clean_review",
        )

    @cached_property
    def enriched_products(self) -> DataFrame:
        return self.products.join(self.product_scores, "product_idx")

    @cached_property
    def labelled_products(self) -> DataFrame:
        return self.products.join(self.product_sentiment, "product_idx")

    @cached_property
    def features(self) -> DataFrame:
        return features.engineer_features(self.stored_products)

    @cached_property
    def quality(self) -> DataFrame:
        return features.quality_score(self.features.join(self.product_scores, "product_idx"))

    @cached_property
    def stored_quality(self) -> DataFrame:
        cols = ["product_idx", "product_name", "category", "price", "rating", "quality_score"]
        return materialise(self.quality.select(*cols), "quality")

    @cached_property
    def reviews(self) -> DataFrame:
        part = self.table("part")
        parts = part.agg(F.count("*")).scalar()
        names = part.select(F.col("p_partkey").alias("_pk"), F.col("p_name").alias("product_name"))
        doc = F.col("doc_id")
        suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (doc % 9 + 1).cast("int"))
        long = (
            self.documents.withColumn("_pk", doc % parts).join(names, "_pk", "left")
            .select(
                F.concat(F.lit("R"), doc.cast("string")).alias("product_id"),
                "product_name",
                F.concat("text", suffix).alias("review_text"),
                F.when(doc % 12 != 0, (doc % 6).cast("double")).alias("rating"),
            )
        )
        return long.unionByName(self.brief_reviews)

    @cached_property
    def brief_reviews(self) -> DataFrame:
        """One short review of each part."""
        part, k = self.table("part"), F.col("p_partkey")
        short = F.when(k % 8 == 7, F.concat(F.lit("Nice "), F.col("p_name"), F.lit(" for the kitchen")))
        for i, s in enumerate(SHORT_REVIEWS):
            short = short.when(k % 8 == i, F.lit(s).cast("string"))
        return part.select(
            F.concat(F.lit("S"), k.cast("string")).alias("product_id"),
            F.col("p_name").alias("product_name"),
            short.alias("review_text"),
            F.when(k % 11 != 0, (F.floor(k / 8) % 6).cast("double")).alias("rating"),
        )
    @cached_property
    def cleaned(self) -> DataFrame:
        r = self.reviews.withColumns(
            {
                "clean_title": X.clean_text("product_name"),
                "clean_review": X.clean_text("review_text"),
            }
        )
        return r.withColumn("combined_text", X.combine_text("clean_title", "clean_review"))

    @cached_property
    def matched(self) -> DataFrame:
        """Cleaned texts with the numbers of all dictionary keywords in them."""
        return self.cleaned.withColumn("hits", MATCHER.find("combined_text"))

    @cached_property
    def dictionary_stage(self) -> DataFrame:
        known = MATCHER.found("hits")
        found = self.matched.withColumns(
            {
                "text_length": F.length("combined_text").cast("bigint"),
                "word_count": X.word_count("combined_text"),
                "has_review": F.length("clean_review") > 10,
                "predicted_category": X.classify(known, D.CATEGORY_KEYWORDS),
                "brand_extracted": X.extract_brand(known, D.BRANDS),
                "price_mentioned": X.first_price("review_text"),
                "features": X.mentions(known, D.FEATURE_KEYWORDS),
                "aspect_sentiments": X.aspects(
                    "combined_text", D.ASPECT_KEYWORDS, D.POSITIVE_WORDS, D.NEGATIVE_WORDS,
                    found=known,
                ),
            }
        )
        return found.withColumns(
            {
                "features_mentioned": X.mention_list("features"),
                "feature_count": F.size("features").cast("bigint"),
            }
        )

    @cached_property
    def lexicon(self) -> DataFrame:
        return sentiment.lexicon_table(self.spark)

    @cached_property
    def sentiment(self) -> DataFrame:
        return sentiment.sentiment(self.cleaned, "product_id", "combined_text", self.lexicon)

    @cached_property
    def scored(self) -> DataFrame:
        """Dictionary results and fake score beside the combined text."""
        score = trust.fake_score("clean_review", "rating", "batch", "feature_count")
        return self.dictionary_stage.select(
            "product_id", "product_name", "rating", "text_length", "word_count", "has_review",
            "predicted_category", "brand_extracted", "price_mentioned", "features_mentioned",
            "feature_count", "combined_text", score.alias("fake_review_score"),
        ).withColumn("fake_review_flag", F.col("fake_review_score") >= 50)

    @cached_property
    def enriched(self) -> DataFrame:
        """All columns of the text stage but whole texts, which no report needs."""
        rows = self.scored
        carry = [c for c in rows.columns if c not in ("product_id", "combined_text")]
        both = sentiment.sentiment(rows, "product_id", "combined_text", self.lexicon, carry)
        return both.withColumns(
            {
                "nlp_quality_score": trust.nlp_quality(
                    "sentiment_compound", "feature_count", "word_count"
                ),
                "product_risk_tier": trust.risk_tier(
                    "fake_review_score", "sentiment_compound", "rating"
                ),
            }
        )

    @cached_property
    def interactions(self) -> DataFrame:
        """Buyer and part with a score from 1 to 5 in steps of 0.1, from mean quantity."""
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.groupBy(
            F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
        ).agg(F.round(1 + F.avg("l_quantity") * 4 / 50, 1).alias("score"))

    @cached_property
    def stored_interactions(self) -> DataFrame:
        return materialise(self.interactions, "interactions")

    @cached_property
    def daily(self) -> DataFrame:
        part = self.table("part").select("p_partkey", "p_type")
        lines = self.table("lineitem").select("l_partkey", "l_quantity", "l_shipdate")
        # Sum per part and day first: the join then carries far fewer rows.
        sums = lines.groupBy("l_partkey", F.to_date("l_shipdate").alias("day")).agg(
            F.sum("l_quantity").alias("qty")
        )
        facts = sums.join(part, F.col("l_partkey") == F.col("p_partkey"))
        return demand.daily_demand(facts, "day", "p_type", "qty")

    @cached_property
    def spine(self) -> DataFrame:
        """Filled series; the facts are read once, for the small written daily table."""
        return demand.date_spine(materialise(self.daily, "daily"))

    @cached_property
    def event_demand(self) -> DataFrame:
        return demand.daily_demand(self.table("events"), "ts", "event_type", F.lit(1))

    @cached_property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("item_id"),
            F.col("embedding").alias("vector"),
            F.concat(F.lit("C"), F.col("label").cast("string")).alias("category"),
            ((F.col("vec_id") * 7 % 51) / 10.0).alias("rating"),
            (F.col("vec_id") % 100).cast("double").alias("price"),
        )


class OwnReviews(Views):
    """The same views over the short reviews of the products alone."""

    @property
    def product_number(self) -> Column:
        """The product that a review's id belongs to."""
        return F.expr("CAST(substring(product_id, 2) AS BIGINT)").alias("product_idx")

    @cached_property
    def reviews(self) -> DataFrame:
        return self.brief_reviews
