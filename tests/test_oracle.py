"""Every registered query against its SQL, or against its own rules."""

import oracle
import pytest

from shopgrain.plans.all_queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize(
    "name, column, expected",
    [
        ("discount_tier", "discount_tier", {"No Discount", "Low", "Medium", "High", "Very High"}),
        ("rating_tier", "rating_tier", {"Poor", "Below Average", "Average", "Good", "Excellent", None}),
        ("sentiment_label", "sentiment_label", {"Positive", "Negative", "Neutral"}),
        ("risk_tier", "product_risk_tier", {"High Risk", "Medium Risk", "Low Risk"}),
        ("fake_score_interactive", "risk_level", {"High", "Medium", "Low"}),
        ("review_recommendation", "recommendation", {"Flag for manual review", "Appears genuine"}),
        ("split_70_15_15", "part", {"train", "validation", "test"}),
        ("explode_aspects", "polarity", {"positive", "negative", "neutral"}),
    ],
)
def test_every_branch_occurs(spark, sf_dir, name, column, expected):
    rows = QUERIES[name](spark, sf_dir).select(column).distinct().collect()
    assert {r[0] for r in rows} == expected
