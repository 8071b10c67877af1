"""Readers, writers, schema alignment and streams."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.operators import cleaning
from shopgrain.plans import all_queries
from shopgrain.sources import files
from shopgrain.streaming import streams

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("asin", "title", "price")])


def test_csv_skips_long_rows_and_pads_short_ones(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'asin,title,price\n1,good,"$1,2"\n2,short\n3,long,5,surplus\n4,"two\nlines",6\n'
    )
    got = files.scan_csv(spark, str(tmp_path / "a.csv"), SCHEMA, multi_line=True).orderBy("asin").collect()
    assert [tuple(r) for r in got] == [("1", "good", "$1,2"), ("2", "short", None), ("4", "two\nlines", "6")]


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_counts_empty_surplus_fields(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3,4,\n5\n6,"x,y"\n9,10,,11\n7,8,z\n12,"q""r"\n13,\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    got = files.scan_csv(spark, str(tmp_path), schema, multi_line=multi_line)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "2"), (5, None), (6, "x,y"), (12, 'q"r'), (13, None)]
    assert got.select("b").count() == 5


def test_csv_quarantine_keeps_every_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('a,b\n1,2\n3,4,\n5\n6,"x,y"\n9,10,,11\n12,"q""r"\n')
    (tmp_path / "in" / "b.csv").write_text("a,b\n7,8,z\n13,\na,b\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    good = files.scan_csv(spark, str(tmp_path / "in"), schema, corrupt_to=str(tmp_path / "bad"))
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [("1", "2"), ("5", None), ("6", "x,y"), ("12", 'q"r'), ("13", None), ("a", "b")], key=str
    )
    bad = files.published(spark, str(tmp_path / "bad")).collect()
    assert {(r["line"], r["file"].rsplit("/", 1)[1], r["reason"]) for r in bad} == {
        ("3,4,", "a.csv", "more than 2 fields"), ("9,10,,11", "a.csv", "more than 2 fields"), ("7,8,z", "b.csv", "more than 2 fields")
    }
    with pytest.raises(ValueError):
        files.scan_csv(spark, str(tmp_path), schema, multi_line=True, corrupt_to="x")


def test_csv_is_split(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("asin,title,price\n" + "1,a title,2\n" * 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert files.scan_csv(spark, str(tmp_path), SCHEMA).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_optional_and_first_scan(spark, tmp_path):
    missing, there = str(tmp_path / "no"), str(tmp_path / "yes")
    assert files.scan_optional(spark, missing, SCHEMA).count() == 0
    spark.createDataFrame([("1", "t", "2")], SCHEMA).write.parquet(there)
    assert files.scan_optional(spark, there, SCHEMA).count() == 1
    got = files.scan_first(spark, [missing, there])
    assert got.first()["predicted_category"] == "Other"
    with pytest.raises(FileNotFoundError):
        files.scan_first(spark, [missing])


def test_news(spark, tmp_path):
    articles = [
        {"title": "B", "description": "", "content": "body", "publishedAt": "2024-02-01", "source": {"name": "s"}, "url": "u"},
        {"title": "A", "description": "text", "content": "body", "publishedAt": "2024-01-01", "source": {"name": None}},
        {"title": "A", "description": "text", "content": "body", "publishedAt": "2024-01-01", "source": {"name": None}},
    ]
    (tmp_path / "n.json").write_text(json.dumps({"articles": articles}))
    raw = files.scan_news(spark, str(tmp_path / "n.json"))
    got = files.news_articles(raw).orderBy("product_id").collect()
    assert [(r["product_id"], r["product_name"], r["review_text"]) for r in got] == [
        ("NEWS_0", "A", "text"), ("NEWS_1", "A", "text"), ("NEWS_2", "B", "body")
    ]
    assert got[2]["news_source"] == "s" and got[0]["rating"] is None
    assert files.news_articles(raw, cap=1).count() == 1


def test_demand_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text(
        "date,category,demand,day_of_week,day_of_month,month,is_weekend,trend\n2023-01-02,Toys,103,0,2,1,0,0.25\n"
    )
    row = files.demand_csv(spark, str(tmp_path / "d.csv")).first()
    assert (row["date"], row["demand"], row["trend"]) == (datetime.date(2023, 1, 2), 103, 0.25)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "High Risk", [0.5, 1.0]), (2, "Low Risk", [1.0, 0.0])], "k int, tier string, vector array<double>")
    files.write_table(df, str(tmp_path / "t"), ["tier"])
    assert spark.read.parquet(str(tmp_path / "t")).where("tier = 'Low Risk'").count() == 1
    files.write_table(df.drop("vector"), str(tmp_path / "c"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    files.write_slice(df, F.col("tier") == "High Risk", str(tmp_path / "s"))
    assert [r["k"] for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [1]
    files.write_vectors(df, str(tmp_path / "v"), "k")
    assert dict(spark.read.parquet(str(tmp_path / "v")).dtypes) == {"k": "int", "vector": "array<float>"}
    with pytest.raises(ValueError):
        files.write_table(df, str(tmp_path / "x"), fmt="orc")


def test_combine_earlier_source_wins(spark):
    a = spark.createDataFrame([("1", "first name", "x"), ("2", "abc", "x")], "product_id string, product_name string, source string")
    b = spark.createDataFrame([("1", "other name", 5.0), ("3", None, 1.0), ("4", "kept", None)], "product_id string, product_name string, price double")
    got = cleaning.combine([a, b], ["product_name"])
    assert got.columns == cleaning.STANDARD_SCHEMA.fieldNames()
    assert sorted((r["product_id"], r["product_name"]) for r in got.collect()) == [("1", "first name"), ("4", "kept")]


def test_standardise_renames_only_present_columns(spark):
    df = spark.createDataFrame([("n", "5", 1)], "`name` string, `reviews.rating` string, other int")
    got = cleaning.standardise(df, cleaning.REVIEW_COLUMNS, "reviews")
    assert got.columns == ["product_name", "rating", "other", "source"]
    assert cleaning.keep(df, ["reviews.rating", "absent"]).columns == ["reviews.rating"]


def test_stamp(spark):
    at = datetime.datetime(2024, 5, 1, 12, 0)
    assert cleaning.stamp(spark.range(1), at).first()["processed_at"] == at


def test_unknown_product_has_no_detail(spark):
    df = spark.createDataFrame([(1, "p", None)], "product_idx bigint, product_id string, price double")
    df = df.withColumns({c: F.lit(None).cast("double") for c in ("rating", "list_price", "discount_pct")})
    df = df.withColumn("review_count", F.lit(None).cast("bigint")).withColumn("product_name", F.lit("n"))
    assert cleaning.product_detail(df, 9).count() == 0
    row = cleaning.product_detail(df, 1).first()
    assert (row["price"], row["review_count"], row["category"], row["sentiment"]) == (0.0, 0, "Other", "N/A")


def test_stream_enrich_equals_batch(spark, tmp_path):
    rows = [(1, "Great <b>usb</b> phone!", 5.0), (2, "ok", 5.0), (3, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, review_text string, rating double")
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    streams.run_once(streams.enrich(source), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, streams.enrich(df).select(got.columns).collect()))


def test_stream_dedup(spark, tmp_path):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [("a", t0), ("a", t0 + datetime.timedelta(minutes=5)), ("b", t0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    streams.run_once(streams.stream_dedup(source, "k", "ts", "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def _day(n, hour=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n, hours=hour)


def test_stream_ends_with_its_open_days(spark, tmp_path):
    """Open days come out at the end, a late event is counted and changes nothing, state leaves."""
    # Spark holds events against the watermark with which the batch before began to close days.
    for row in [("a", _day(0), 1.0), ("b", _day(5), 2.0), ("b", _day(5, 1), 4.0), ("a", _day(0, 3), 9.0)]:
        df = spark.createDataFrame([row], "k string, ts timestamp, q double")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def build(rows):
        return streams.stream_daily_demand(rows, "k", "ts", "q", "1 day")

    held = streams.run_once(build(source), str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert held.late_rows == 1 and held.state_rows == 1
    days, report = streams.run_to_end(source, "ts", build, str(tmp_path / "o2"), str(tmp_path / "c2"))
    want = [("a", datetime.date(2024, 1, 1), 1.0, 1), ("b", datetime.date(2024, 1, 6), 6.0, 2)]
    assert sorted(map(tuple, days.collect())) == want
    # Only the row that ended the stream is held.
    assert report == streams.StreamReport(late_rows=1, state_rows=1)
    again, report = streams.run_to_end(source, "ts", build, str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert sorted(map(tuple, again.collect())) == want and report.state_rows == 1


def test_stream_first_keeps_the_first_row(spark, tmp_path):
    rows = [("a", _day(0, 5), 1, None), ("a", _day(0, 2), 2, "x"), ("a", _day(0, 2), 1, "y"), ("a", _day(1), 7, "z"),
            (None, _day(0), 3, "n"), ("b", None, 4, "no time")]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, note string")
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    got, report = streams.run_to_end(
        source, "ts", lambda d: streams.stream_first(d, ["k"], "ts", "1 hour"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert got.columns == ["k", "ts", "id", "note"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [rows[2], rows[3], rows[4]]))
    assert report.state_rows == 1


def test_stream_without_events_ends_empty(spark, tmp_path):
    spark.createDataFrame([], "k string, ts timestamp, q double").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("k string, ts timestamp, q double").parquet(str(tmp_path / "in"))
    got, _ = streams.run_to_end(
        source, "ts", lambda d: streams.stream_first(d, ["k"], "ts", "1 day"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert got.collect() == []


def test_trends_have_every_event_type(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 10:00:00", "view"), ("2024-01-02 10:00:00", "refund"),
                                  ("2024-01-02 11:00:00", "part.return")], "ts string, event_type string")
    rows.selectExpr("CAST(ts AS TIMESTAMP_NTZ) AS ts", "event_type").write.parquet(f"{tmp_path}/events.parquet")
    got = all_queries.QUERIES["unpivot_trends"](spark, str(tmp_path)).where("search_interest > 0").collect()
    assert sorted((r["date"], r["keyword"]) for r in got) == [
        ("2024-01-01", "view"), ("2024-01-02", "part.return"), ("2024-01-02", "refund")]
