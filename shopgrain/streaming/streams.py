"""The row operators and bounded-state aggregates on Structured Streaming, and a run that ends a stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import dictionaries as D
from shopgrain.functions import textual as X
from shopgrain.functions import trust
from shopgrain.functions.matching import Matcher, words_of
from shopgrain.sources.files import exists


def enrich(df: DataFrame, text: str = "review_text", rating: str = "rating") -> DataFrame:
    """Cleaning, dictionaries and fake score; stateless, so the same on batch and stream."""
    matcher = Matcher(words_of(D.CATEGORY_KEYWORDS, D.BRANDS, D.FEATURE_KEYWORDS))
    cleaned = df.withColumn("clean_review", X.clean_text(text))
    known = matcher.found("_hits")
    found = cleaned.withColumn("_hits", matcher.find("clean_review")).withColumns(
        {
            "predicted_category": X.classify(known, D.CATEGORY_KEYWORDS),
            "brand_extracted": X.extract_brand(known, D.BRANDS),
            "_features": X.mentions(known, D.FEATURE_KEYWORDS),
        }
    )
    counted = found.withColumns(
        {
            "features_mentioned": X.mention_list("_features"),
            "feature_count": F.size("_features").cast("bigint"),
        }
    ).drop("_features", "_hits")
    score = trust.fake_score("clean_review", rating, "batch", "feature_count")
    return counted.withColumn("fake_review_score", score)


def stream_dedup(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """First row per key; state is dropped once the watermark has passed."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark([key])


def stream_daily_demand(df: DataFrame, category: str, ts: str, qty: str, delay: str) -> DataFrame:
    """Sum and count per category and day; a day is final once the watermark has passed it.

    Windows align to UTC, so local times are moved there and the dates back.
    """
    zone = F.current_timezone()
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    timed = df.withColumn("_at", local).withWatermark("_at", delay)
    windows = timed.groupBy(F.window("_at", "1 day"), F.col(category).alias("category")).agg(
        F.sum(qty).alias("demand"), F.count("*").alias("n")
    )
    day = F.to_date(F.to_utc_timestamp("window.start", zone))
    return windows.select("category", day.alias("date"), "demand", "n")


def stream_first(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """The first row of each key and UTC day, whole, once the watermark has passed the day.

    First by ``ts``, then by the other columns in their order, so it does not depend on arrival; none may be a
    map. State holds one row per key of the open days. Null keys are a key; rows without a time are late.
    """
    rest = [c for c in df.columns if c not in (*keys, ts)]
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    first = F.min(F.struct(F.col(ts).alias("_at"), *rest)).alias("_first")
    days = timed.groupBy(F.window(ts, "1 day"), *keys).agg(first)
    return days.select(*keys, F.col("_first._at").alias(ts), *[F.col(f"_first.`{c}`").alias(c) for c in rest])


@dataclass
class StreamReport:
    """What a run did to its state: rows too late for it, and rows still held at the end.

    ``late_rows`` are counted as Spark counts them, after rows of one key have met within a task, over the
    batches that ``spark.sql.streaming.numRecentProgressUpdates`` keeps.
    """

    late_rows: int
    state_rows: int


def run_once(df: DataFrame, path: str, checkpoint: str) -> StreamReport:
    """Process everything available and append it to a Parquet table."""
    query = (
        df.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    states = [p["stateOperators"] for p in query.recentProgress]
    late = sum(op["numRowsDroppedByWatermark"] for batch in states for op in batch)
    return StreamReport(late, sum(op["numRowsTotal"] for op in states[-1]) if states else 0)


# A time behind all events: its arrival tells that the input has ended.
END_OF_INPUT = "9999-01-01 00:00:00"


def run_to_end(
    source: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
    until: str = END_OF_INPUT,
) -> tuple[DataFrame, StreamReport]:
    """Run ``build(source)`` over everything available, then emit what the watermark still holds back.

    A second file stream joins the source. After the first run it gets one row at ``until``, all else null, and
    a second run from the same checkpoint reads that row alone: the watermark passes every open day, so their
    rows come out of state and no event is read again. The row's own day never closes. Each step can be repeated
    after a failure: the checkpoint knows what has been read, and a second end changes nothing. Events that arrive
    behind the end are late; with an earlier ``until`` the stream goes on from there.
    """
    spark, marks = source.sparkSession, checkpoint.rstrip("/") + "-ends"
    rows = source.withColumn(ts, F.col(ts).cast("timestamp"))
    if not exists(spark, marks):
        spark.createDataFrame([], rows.schema).write.parquet(marks)
    built = build(rows.unionByName(spark.readStream.schema(rows.schema).parquet(marks)))
    before = run_once(built, path, checkpoint)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != ts]
    spark.range(1).select(F.lit(until).cast("timestamp").alias(ts), *empty).write.mode("append").parquet(marks)
    after = run_once(built, path, checkpoint)
    report = StreamReport(before.late_rows + after.late_rows, after.state_rows)
    return spark.read.schema(built.schema).parquet(path), report
