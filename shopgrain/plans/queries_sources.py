"""Readers and writers: rows of the tables written to the shared folder in each format and read back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.operators.checkpoints import new_path
from shopgrain.plans.registry import query
from shopgrain.plans.views import Views
from shopgrain.sources import files

CSV_SCHEMA = T.StructType(
    [T.StructField("asin", T.LongType()), T.StructField("title", T.StringType()), T.StructField("price", T.DoubleType())]
)


def with_header(lines: DataFrame, header: str) -> DataFrame:
    """The header before the lines of every part, as each part becomes a file."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [header]})
        yield from batches

    return lines.mapInArrow(add, "value string")


def raw_csv(v: Views) -> str:
    """Parts as CSV lines, some of them short or with surplus fields, empty or not; returns their folder."""
    k = F.col("p_partkey")
    quoted = F.concat(F.lit('"'), F.replace("p_name", F.lit('"'), F.lit('""')), F.lit('"'))
    whole = F.concat_ws(",", k, quoted, "p_retailprice")
    line = (
        F.when(k % 10 == 3, F.concat(whole, F.lit(","))).when(k % 10 == 4, F.concat(whole, F.lit(",,surplus")))
        .when(k % 10 == 5, k.cast("string")).otherwise(whole)
    )
    path = new_path(v.spark, "csv")
    with_header(v.table("part").select(line.alias("value")), "asin,title,price").write.text(path)
    return path


@query("scan_csv_skip_bad", """
SELECT p_partkey AS asin, CASE WHEN p_partkey % 10 <> 5 THEN p_name END AS title,
 CASE WHEN p_partkey % 10 <> 5 THEN p_retailprice END AS price FROM part WHERE p_partkey % 10 NOT IN (3, 4)""")
def _(v: Views):
    return files.scan_csv(v.spark, raw_csv(v), CSV_SCHEMA)


@query("scan_csv_quarantine", """
SELECT p_partkey AS asin, CASE WHEN p_partkey % 10 IN (3, 4) THEN 'more than 3 fields' END AS reason,
 p_partkey % 10 IN (3, 4) AS has_line FROM part""")
def _(v: Views):
    """Good and quarantined rows together are the lines written."""
    bad = new_path(v.spark, "quarantine")
    good = files.scan_csv(v.spark, raw_csv(v), CSV_SCHEMA, corrupt_to=bad)
    kept = files.published(v.spark, bad, T.StructType([T.StructField(c, T.StringType()) for c in ("line", "file", "reason")]))
    number = F.substring_index("line", ",", 1).cast("bigint")
    return good.select("asin", F.lit(None).cast("string").alias("reason"), F.lit(False).alias("has_line")).unionByName(
        kept.select(number.alias("asin"), "reason", (F.col("line").isNotNull() & F.col("file").endswith(".txt")).alias("has_line"))
    )


@query("scan_optional", "SELECT s_suppkey, s_name FROM supplier")
def _(v: Views):
    rows, path = v.table("supplier").select("s_suppkey", "s_name"), new_path(v.spark, "optional")
    files.write_table(rows, path)
    there = files.scan_optional(v.spark, path, rows.schema)
    return there.unionByName(files.scan_optional(v.spark, path + "-absent", rows.schema))


@query("scan_with_fallback", "SELECT p_partkey, p_name, 'Other' AS predicted_category FROM part")
def _(v: Views):
    path = new_path(v.spark, "fallback")
    files.write_table(v.table("part").select("p_partkey", "p_name"), path)
    return files.scan_first(v.spark, [path + "-absent", path])


@query("scan_news_json", """
WITH rows AS (SELECT 'T' || doc_id AS product_name, CASE WHEN doc_id % 4 > 0 THEN coalesce(nullif(text, ''), source)
 ELSE source END AS review_text, '2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS published_at,
 'u/' || doc_id AS url, lang AS news_source FROM documents)
SELECT 'NEWS_' || (row_number() OVER (ORDER BY concat_ws('|', published_at, url, product_name, coalesce(review_text, ''))) - 1)
 AS product_id, product_name, review_text, published_at, coalesce(news_source, '') AS news_source FROM rows""")
def _(v: Views):
    k = F.col("doc_id")
    article = F.struct(
        F.concat(F.lit("T"), k).alias("title"), F.when(k % 4 > 0, F.col("text")).otherwise("").alias("description"),
        F.col("source").alias("content"),
        F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")).alias("publishedAt"),
        F.concat(F.lit("u/"), k).alias("url"), F.struct(F.col("lang").alias("name")).alias("source"),
    )
    path = new_path(v.spark, "news")
    v.table("documents").select(F.array(article).alias("articles")).write.json(path)
    found = files.news_articles(files.scan_news(v.spark, path, multi_line=False))
    return found.select("product_id", "product_name", "review_text", "published_at", "news_source")


@query("scan_demand_csv", """
SELECT strftime(date, '%Y-%m-%d') AS date, category, demand::INTEGER AS demand, isodow(date)::INTEGER - 1 AS day_of_week,
 day(date)::INTEGER AS day_of_month, month(date)::INTEGER AS month, (isodow(date) > 5)::INTEGER AS is_weekend,
 demand / 4.0 AS trend FROM event_demand""", ["event_demand"])
def _(v: Views):
    rows = v.event_demand.select(
        "date", "category", F.col("demand").cast("int").alias("demand"), F.weekday("date").alias("day_of_week"),
        F.dayofmonth("date").alias("day_of_month"), F.month("date").alias("month"),
        (F.weekday("date") > 4).cast("int").alias("is_weekend"), (F.col("demand") / 4.0).alias("trend"),
    )
    path = new_path(v.spark, "demand")
    files.write_table(rows, path, fmt="csv")
    return files.demand_csv(v.spark, path).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("write_master", "SELECT product_idx, product_id, product_name, category, brand FROM products", ["products"])
def _(v: Views):
    path = new_path(v.spark, "master")
    files.write_table(v.products.select("product_idx", "product_id", "product_name", "category", "brand"), path, ["category"])
    return v.spark.read.parquet(path).select("product_idx", "product_id", "product_name", "category", "brand")


@query("write_vectors", """
SELECT vec_id AS item_id, len(embedding)::INTEGER AS dims, embedding[1]::DOUBLE AS first, embedding[-1]::DOUBLE AS last
FROM embeddings""")
def _(v: Views):
    path = new_path(v.spark, "vectors")
    files.write_vectors(v.vectors, path, "item_id")
    vector = F.col("vector")
    return v.spark.read.parquet(path).select(
        "item_id", F.size(vector).alias("dims"), F.element_at(vector, 1).cast("double").alias("first"),
        F.element_at(vector, -1).cast("double").alias("last"),
    )
