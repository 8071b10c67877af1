"""Number parsing, binning and score arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain finite number becomes null."""
    c = _col(c).cast("string")
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))


def parse_price(c: Column | str) -> Column:
    """Drop ``$`` and thousands commas, then parse."""
    return parse_number(F.regexp_replace(_col(c).cast("string"), r"[$,]", ""))


def parse_price_loose(c: Column | str) -> Column:
    """First number in free text such as ``Rs. 1,500``; null without one.

    The digits are picked as one match, so the dot of an abbreviation is never
    taken for a decimal point.
    """
    hit = F.regexp_extract(_col(c).cast("string"), r"(\d[\d,]*(?:\.\d+)?)", 1)
    return parse_number(F.regexp_replace(hit, ",", ""))


def parse_count(c: Column | str) -> Column:
    """Drop commas, parse, truncate to an integer; missing counts as 0."""
    n = parse_number(F.regexp_replace(_col(c).cast("string"), ",", ""))
    return F.coalesce(n, F.lit(0.0)).cast("bigint")


def clip(c: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def round_even(c: Column, digits: int) -> Column:
    """Round to digits, halves to the even neighbour; stays in generated code."""
    return F.rint(c * 10**digits) / 10**digits


def discount_pct(price: Column | str, list_price: Column | str) -> Column:
    """Percentage off the list price in 0..100, one digit.

    A list price of 0 gives 0 when something was charged, else null.
    """
    p, lp = _col(price), _col(list_price)
    pct = clip(F.try_divide(lp - p, lp) * 100, 0.0, 100.0)
    return round_even(F.when((lp == 0) & (p > 0), F.lit(0.0)).otherwise(pct), 1)


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]] -> labels[i]``; outside is null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per bin")
    c = _col(c)
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        hit = (c > low) & (c <= high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


# Bin edges and labels of the two tiers.
DISCOUNT_EDGES = (-1.0, 0.0, 10.0, 25.0, 50.0, 100.0)
DISCOUNT_LABELS = ("No Discount", "Low", "Medium", "High", "Very High")
RATING_EDGES = (0.0, 2.0, 3.0, 4.0, 4.5, 5.0)
RATING_LABELS = ("Poor", "Below Average", "Average", "Good", "Excellent")


def discount_tier(c: Column | str) -> Column:
    return cut(F.coalesce(_col(c), F.lit(0.0)), DISCOUNT_EDGES, DISCOUNT_LABELS)


def rating_tier(c: Column | str) -> Column:
    """A missing rating is 3.0; a rating of exactly 0 has no tier."""
    return cut(F.coalesce(_col(c), F.lit(3.0)), RATING_EDGES, RATING_LABELS)


def price_per_rating(price: Column | str, rating: Column | str) -> Column:
    p = F.coalesce(_col(price), F.lit(0.0))
    return round_even(F.try_divide(p, F.coalesce(_col(rating), F.lit(3.0))), 2)


def rank_score(rating: Column | str, reviews: Column | str) -> Column:
    return F.coalesce(_col(rating), F.lit(0.0)) * F.coalesce(_col(reviews), F.lit(0))


def flag(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("boolean"), F.lit(False))


def compare_score(rating: Column, fake: Column, reviews: Column) -> Column:
    """Head-to-head score: rating, authenticity, and review volume up to 300,000."""
    volume = F.least(F.coalesce(reviews, F.lit(0)).cast("double"), F.lit(300000.0))
    return (
        F.coalesce(rating, F.lit(0.0)) * 20
        + (100 - F.coalesce(fake, F.lit(0.0))) * 0.3
        + volume / 300000 * 30
    )
