"""Counts, shares, profiles and summaries, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Rows per value, largest first, equal counts by value."""
    out = df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)
    return out if n is None else out.limit(n)


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Rows per value and their percentage of all rows."""
    total = df.agg(F.count("*")).scalar()
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(F.col("n") / total * 100, 1))


def null_profile(df: DataFrame, n: int = 10) -> DataFrame:
    """Columns with nulls: count and percentage, the n worst."""
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counted.unpivot(["_rows"], list(df.columns), "column", "n_null")
    pct = F.round(F.try_divide(F.col("n_null") * 100, F.col("_rows")), 1)
    return (
        long.where("n_null > 0").select("column", "n_null", pct.alias("pct_null"))
        .orderBy(F.desc("n_null"), "column").limit(n)
    )


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, minimum and maximum of each numeric column, two digits."""
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.round(F.avg(c), 2).alias("mean"),
                F.round(F.min(c).cast("double"), 2).alias("min"),
                F.round(F.max(c).cast("double"), 2).alias("max"),
            )
            for c in cols
        ]
    )
    return df.agg(stats.alias("s")).select(F.inline("s"))


def _summary(
    df: DataFrame, counts: Mapping[str, str], totals: Mapping[str, Column], top: Mapping[str, int] | None = None
) -> DataFrame:
    """(metric, key, value) rows: counts per column value and totals, from one scan.

    Grouping sets count every column in the same aggregate, and each of its rows becomes one
    count or all totals. ``top`` keeps the largest values of the metrics that it names.
    """
    cols = list(counts.values())
    sets = [[F.col(c)] for c in cols] + [[]]
    grouped = df.groupingSets(sets, *cols).agg(
        F.grouping_id(*cols).alias("_gid"),
        F.count("*").cast("double").alias("_n"),
        *[expr.cast("double").alias(name) for name, expr in totals.items()],
    )
    width = len(cols)
    everything = 2**width - 1
    metric = F.when(F.lit(False), F.lit(""))
    key = F.when(F.lit(False), F.lit(""))
    for i, (name, c) in enumerate(counts.items()):
        test = F.col("_gid") == everything - 2 ** (width - 1 - i)
        metric = metric.when(test, name)
        key = key.when(test, F.col(c).cast("string"))

    def entry(metric: Column, key: Column, value: Column) -> Column:
        return F.struct(metric.alias("metric"), key.alias("key"), value.alias("value"))

    whole = F.array(*[entry(F.lit(name), F.lit(""), F.col(name)) for name in totals])
    one = F.array(entry(metric, key, F.col("_n")))
    rows = grouped.select(F.inline(F.when(F.col("_gid") == everything, whole).otherwise(one)))
    if not top:
        return rows
    limit = F.create_map(*[F.lit(x) for item in top.items() for x in item])[F.col("metric")]
    place = F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("value"), F.asc("key")))
    return rows.withColumn("_rk", place).where((F.col("_rk") <= limit) | limit.isNull()).drop("_rk")


def catalogue_summary(df: DataFrame) -> DataFrame:
    """Size, rows per source, mean rating and mean price."""
    return _summary(
        df,
        {"sources": "source"},
        {
            "total_records": F.count("*"),
            "avg_rating": F.round(F.avg("rating"), 2),
            "avg_price": F.round(F.avg("price"), 2),
            "n_columns": F.lit(len(df.columns)) + F.count("*") * 0,
        },
    )


def pipeline_summary(df: DataFrame) -> DataFrame:
    """The catalogue summary and the names of the columns with their places."""
    spark, fields = df.sparkSession, "metric string, key string, value double"
    names = spark.createDataFrame([("columns", c, float(i)) for i, c in enumerate(df.columns)], fields)
    return catalogue_summary(df).unionByName(names)


def nlp_summary(df: DataFrame, top: int = 10) -> DataFrame:
    """Distributions of the text stage, of categories and brands the ``top`` largest, and its totals."""
    flagged = F.col("fake_review_flag").cast("int")
    return _summary(
        df,
        {
            "sentiment_distribution": "sentiment_label",
            "category_distribution": "predicted_category",
            "top_brands": "brand_extracted",
            "risk_distribution": "product_risk_tier",
        },
        {
            "total_records": F.count("*"),
            "fake_reviews_flagged": F.sum(flagged),
            "fake_review_pct": F.round(F.avg(flagged) * 100, 2),
            "avg_nlp_quality": F.round(F.avg("nlp_quality_score"), 2),
        },
        {"category_distribution": top, "top_brands": top},
    )


def nlp_evaluation(df: DataFrame) -> DataFrame:
    """One row of coverage and rate figures of the text stage."""
    cat, brand = F.col("predicted_category"), F.col("brand_extracted")

    def pct(test: Column, digits: int = 1) -> Column:
        return F.round(F.avg(test.cast("int")) * 100, digits)

    return df.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("has_review")).alias("with_review"),
        F.count_if(F.col("sentiment_label") == "Positive").alias("positive"),
        F.count_if(F.col("sentiment_label") == "Negative").alias("negative"),
        F.count_if(F.col("sentiment_label") == "Neutral").alias("neutral"),
        F.round(F.avg("sentiment_compound"), 4).alias("avg_compound"),
        F.count_distinct(cat).alias("categories"),
        pct(cat != "Other").alias("category_coverage"),
        F.count_if(brand != "Unknown").alias("brands_identified"),
        pct(brand != "Unknown").alias("brand_coverage"),
        F.round(F.avg("feature_count"), 1).alias("avg_features"),
        F.count_if(F.col("fake_review_flag")).alias("flagged"),
        pct(F.col("fake_review_flag")).alias("flagged_pct"),
        F.round(F.avg("fake_review_score"), 1).alias("avg_fake_score"),
        *[
            F.count_if(F.col("product_risk_tier") == f"{t} Risk").alias(f"{t.lower()}_risk")
            for t in ("High", "Medium", "Low")
        ],
    )


def aspect_coverage(df: DataFrame, text: str, names: Sequence[str]) -> DataFrame:
    """Rows whose text contains the aspect name itself."""
    t = F.lower(F.col(text))
    counted = df.select(t.alias("_t")).agg(
        *[F.count_if(F.col("_t").contains(n)).alias(n) for n in names]
    )
    return counted.unpivot([], list(names), "aspect", "n_rows")


def aspect_keyword_coverage(df: DataFrame, aspects: str = "aspect_sentiments") -> DataFrame:
    """Rows per aspect and polarity from the aspect map."""
    return (
        df.select(F.explode(aspects).alias("aspect", "polarity"))
        .groupBy("aspect", "polarity").agg(F.count("*").alias("n_rows"))
    )


def headline(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_products"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
        F.round(F.avg("fake_review_score"), 2).alias("avg_fake_score"),
    )


def platform_stats(df: DataFrame, index: DataFrame, approx: bool = False) -> DataFrame:
    """Products, indexed products and categories."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    indexed = index.agg(F.count("*")).scalar()
    return df.agg(
        F.count("*").alias("total_products"), distinct("category").alias("categories")
    ).withColumn("indexed_products", indexed)


def interaction_stats(df: DataFrame) -> DataFrame:
    """Size, mean per user and the share of empty cells of the user-item matrix."""
    cells = F.col("users").cast("double") * F.col("items")
    users = df.select("user_id").distinct().agg(F.count("*").alias("users")).scalar()
    items = df.select("item_id").distinct().agg(F.count("*").alias("items")).scalar()
    return (
        df.agg(F.count("*").alias("interactions"))
        .withColumn("users", users).withColumn("items", items)
        .withColumn("per_user", F.round(F.try_divide(F.col("interactions"), F.col("users")), 1))
        .withColumn(
            "sparsity_pct", F.round((1 - F.try_divide(F.col("interactions"), cells)) * 100, 1)
        )
    )


def category_rollup(df: DataFrame, category: str, label: str) -> DataFrame:
    """Counts per category and label with subtotals; ``level`` tells them apart."""
    return df.rollup(category, label).agg(
        F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level")
    )


def price_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(
        F.count("*").alias("n"),
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


def explode_aspects(df: DataFrame, key: str, aspects: str = "aspect_sentiments") -> DataFrame:
    """One row per product and aspect."""
    return df.select(key, F.explode(aspects).alias("aspect", "polarity"))


def percent_of_total(df: DataFrame, by: str, n: str = "n") -> DataFrame:
    """Share of each row's count within its group (few rows per group: already counted)."""
    return df.withColumn("share", F.col(n) / F.sum(n).over(Window.partitionBy(by)))
