"""The streaming operators, run once over everything available."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import dictionaries as D
from shopgrain.operators.checkpoints import new_path
from shopgrain.plans import ctes
from shopgrain.plans.registry import query
from shopgrain.plans.views import Views
from shopgrain.streaming import streams


def stream_of(v: Views, table: str) -> DataFrame:
    """A table as a file stream."""
    reader = v.spark.readStream.schema(v.table(table).schema)
    return reader.option("pathGlobFilter", f"{table}.parquet").parquet(v.sf_dir)


def finished(v: Views, df: DataFrame, name: str) -> DataFrame:
    """Run the stream into a table in the shared folder and read that back."""
    out = new_path(v.spark, name)
    streams.run_once(df, out, out + "-progress")
    return v.spark.read.schema(df.schema).parquet(out)


def ended(v: Views, source: DataFrame, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The same for a stream with state, whose last days come out at the end of the input."""
    out = new_path(v.spark, f"stream-{name}")
    return streams.run_to_end(source, "ts", build, out, out + "-progress")[0]


@query("stream_enrich", f"""
WITH c AS (SELECT doc_id, {ctes.clean('text')} AS t FROM documents),
cat AS (SELECT doc_id, arg_max(name, score * 1000 - ord) AS predicted_category FROM (
 SELECT doc_id, ord, name, count(*) AS score FROM c JOIN (VALUES {ctes.keyword_rows(D.CATEGORY_KEYWORDS)}) k(ord, name, kw)
 ON contains(t, kw) GROUP BY ALL) GROUP BY 1),
feat AS (SELECT doc_id, count(DISTINCT name) AS n FROM c JOIN (VALUES {ctes.keyword_rows(D.FEATURE_KEYWORDS)}) k(ord, name, kw)
 ON contains(t, kw) GROUP BY 1)
SELECT doc_id, t AS clean_review, coalesce(predicted_category, 'Other') AS predicted_category,
 coalesce(n, 0) AS feature_count FROM c LEFT JOIN cat USING (doc_id) LEFT JOIN feat USING (doc_id)""")
def _(v: Views):
    source = stream_of(v, "documents").select("doc_id", "text", F.lit(3.0).alias("rating"))
    rows = streams.enrich(source, "text", "rating")
    kept = rows.select("doc_id", "clean_review", "predicted_category", "feature_count")
    return finished(v, kept, "stream-enrich")


@query("stream_dedup", "SELECT DISTINCT user_id || '-' || event_type AS id FROM events")
def _(v: Views):
    key = F.concat_ws("-", F.col("user_id").cast("string"), "event_type")
    source = stream_of(v, "events").select(key.alias("id"), "ts")
    return finished(v, streams.stream_dedup(source, "id", "ts", "40 days").select("id"), "stream-dedup")


@query("stream_daily_demand", """
SELECT event_type AS category, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, round(sum(value), 4) AS demand
FROM events GROUP BY ALL""")
def _(v: Views):
    source = stream_of(v, "events").select("event_type", "ts", "value")
    days = ended(v, source, lambda df: streams.stream_daily_demand(df, "event_type", "ts", "value", "1 day"), "demand")
    return days.select(
        "category", F.date_format("date", "yyyy-MM-dd").alias("date"), "n", F.round("demand", 4).alias("demand")
    )


@query("stream_first", """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, ts::DATE ORDER BY ts, event_id) = 1""")
def _(v: Views):
    """The first event of each user, type and day; days leave the state two days later, or at the end."""
    source = stream_of(v, "events").select("user_id", "event_type", "ts", "event_id", "value")
    first = ended(v, source, lambda df: streams.stream_first(df, ["user_id", "event_type"], "ts", "2 days"), "first")
    return first.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
