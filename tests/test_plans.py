"""Plans stay small whatever is filtered, and published tables change whole or not at all."""

import pytest
from pyspark.sql import functions as F

from shopgrain.plans.all_queries import QUERIES
from shopgrain.plans.views import Views
from shopgrain.sources import files

ENRICHED = [
    "sentiment_score", "risk_tier", "nlp_quality", "nlp_summary", "nlp_evaluation", "category_rollup",
    "category_risk_rollup", "headline_metrics", "product_document", "attach_scores", "write_high_risk",
]


def _plan_size(df) -> int:
    return len(df._jdf.queryExecution().optimizedPlan().toString())


@pytest.mark.parametrize("name", ENRICHED)
def test_plans_on_the_enriched_table_are_bounded(spark, sf_dir, name):
    assert _plan_size(QUERIES[name](spark, sf_dir)) < 100_000


@pytest.mark.parametrize("column", ["product_risk_tier", "sentiment_label", "nlp_quality_score", "predicted_category"])
def test_filters_do_not_copy_the_scoring(spark, sf_dir, column):
    plain = Views(spark, sf_dir).enriched
    twice = plain.where(F.col(column).isNotNull()).where(F.col(column).cast("string") != "x")
    text = twice._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("score(") == plain._jdf.queryExecution().optimizedPlan().toString().count("score(")
    assert len(text) < 100_000


def test_publish_replaces_the_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        files.published(spark, path)
    files.publish(spark.range(5).withColumn("kind", F.col("id") % 2), path, ["kind"])
    first = files.published(spark, path)
    files.publish(spark.range(3).withColumn("kind", F.lit(7)), path, ["kind"])
    assert sorted(r["id"] for r in files.published(spark, path).collect()) == [0, 1, 2]
    assert first.count() == 5  # a reader under way keeps its version
    assert files.drop_versions(spark, path) == 1
    assert files.published(spark, path).count() == 3


def test_an_interrupted_publish_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    files.publish(spark.range(4), path)

    @F.udf("long")
    def fails(x):
        if x == 8:
            raise ValueError("lost")
        return x

    with pytest.raises(Exception, match="lost"):
        files.publish(spark.range(10).select(fails("id").alias("id")), path)
    assert files.published(spark, path).count() == 4


def test_empty_slices_keep_their_columns(spark, tmp_path):
    kept = files.publish_slice(spark.range(4), F.col("id") > 10, str(tmp_path / "none"))
    assert kept.columns == ["id"] and kept.count() == 0


def test_slices_are_replaced_one_by_one(spark, tmp_path):
    path, rows = str(tmp_path / "s"), spark.range(6).select("id", (F.col("id") % 3).alias("kind"))
    files.replace_slices(rows, path, ["kind"])
    files.replace_slices(spark.createDataFrame([(100, 1)], "id long, kind long"), path, ["kind"])
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "kind").collect())) == [(0, 0), (2, 2), (3, 0), (5, 2), (100, 1)]
