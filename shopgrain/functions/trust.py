"""Fake-review scores, text quality and risk tiers as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopgrain.functions import dictionaries as D
from shopgrain.functions.matching import let
from shopgrain.functions.numbers import _col, clip, round_even
from shopgrain.functions.textual import words


@dataclass(frozen=True)
class FakePreset:
    """Points and limits of one fake-review score; 0 points switch a signal off."""

    short_points: int
    short_len: int
    short_needs_five: bool
    five_points: int
    five_len: int
    bang_points: int
    caps_points: int
    repeat_points: int
    generic_points: int
    generic_ratio: float
    generic_words: Sequence[str]
    vague_points: int


# The three published scorings. Capital words can only be seen in raw
# text, so the two presets that lower-case first carry no points for them.
PRESETS = {
    "batch": FakePreset(30, 20, True, 0, 0, 15, 0, 25, 20, 0.4, D.GENERIC_BATCH, 10),
    "api": FakePreset(25, 20, False, 20, 30, 15, 0, 20, 15, 0.35, D.GENERIC_API, 0),
    "raw": FakePreset(25, 30, False, 20, 40, 20, 15, 0, 20, 0.3, D.GENERIC_RAW, 0),
}


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def bangs(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "!", ""))


def caps_words(text: Column) -> Column:
    """Tokens of two or more plain capitals; split on anything but letters and digits."""
    return F.size(F.filter(F.split(text, r"[^\p{L}\p{N}_]+"), lambda w: w.rlike("^[A-Z]{2,}$")))


def fake_signals(
    text: Column, tokens: Column, rating: Column, preset: str,
    feature_count: Column | str | None = None,
) -> list[tuple[int, Column, Column]]:
    """(points, whether it fires, flag text) of each signal of a preset."""
    p = PRESETS[preset]
    n = F.size(tokens)
    generic = F.size(F.filter(tokens, lambda w: w.isin(list(p.generic_words))))
    repeated = (n > 5) & (_ratio(F.size(F.array_distinct(tokens)), n) < 0.5)
    vague_words = F.coalesce(_ratio(generic, n) > p.generic_ratio, F.lit(False))
    five = F.coalesce(rating == 5, F.lit(False))
    length = F.length(text)
    short = (length < p.short_len) & five if p.short_needs_five else length < p.short_len
    shouted = F.concat(
        F.lit("Excessive exclamation marks ("), bangs(text).cast("string"), F.lit(")")
    )
    out = [
        (p.short_points, short, F.lit("Very short review")),
        (p.five_points, five & (length < p.five_len), F.lit("5-star with minimal text")),
        (p.bang_points, bangs(text) > 3, shouted),
        (p.caps_points, caps_words(text) > 2, F.lit("Multiple ALL CAPS words")),
        (p.repeat_points, repeated, F.lit("High word repetition")),
        (p.generic_points, vague_words, F.lit("Generic positive words only")),
    ]
    if p.vague_points:
        vague = (length > 0) & (length < 50) & (_col(feature_count) == 0)
        out.append((p.vague_points, vague, F.lit("No product details")))
    return [signal for signal in out if signal[0] > 0]


def _points(preset: str, fired: Column) -> Column:
    """Score from the array of fired signals, in the order of ``fake_signals``."""
    none = F.lit(None)
    total = F.lit(0)
    for i, (points, _, _) in enumerate(fake_signals(none, none, none, preset, none)):
        total = total + F.when(fired[i], points).otherwise(0)
    return F.least(total, F.lit(100)).cast("bigint")


def _fired(text: Column, rating: Column, preset: str, feature_count=None) -> Column:
    """Array of signals; the tokens they share are made once."""
    return let(
        words(F.lower(text)),
        lambda tokens: F.array(
            *[test for _, test, _ in fake_signals(text, tokens, rating, preset, feature_count)]
        ),
    )


def fake_score(
    text: Column | str, rating: Column | str, preset: str, feature_count: Column | str | None = None
) -> Column:
    """Points of all signals that fire, at most 100. Null text counts as empty."""
    text = F.coalesce(_col(text), F.lit(""))
    return let(
        _fired(text, _col(rating), preset, feature_count), lambda fired: _points(preset, fired)
    )


def fake_report(text: Column | str, rating: Column | str, preset: str = "api") -> Column:
    """Struct of score, verdict, level, flags, length and word count for a review."""

    def report(clean: Column) -> Column:
        labels = [label for _, _, label in fake_signals(clean, F.array(), F.lit(None), preset)]

        def result(fired: Column) -> Column:
            score = _points(preset, fired)
            flags = [F.when(fired[i], label) for i, label in enumerate(labels)]
            return F.struct(
                score.alias("fake_probability"),
                (score >= 50).alias("is_suspicious"),
                F.when(score >= 70, "High").when(score >= 40, "Medium").otherwise("Low")
                .alias("risk_level"),
                F.array_compact(F.array(*flags)).alias("flags"),
                F.length(clean).cast("bigint").alias("review_length"),
                F.size(words(clean)).cast("bigint").alias("word_count"),
            )

        return let(_fired(clean, _col(rating), preset), result)

    return let(F.trim(F.lower(F.coalesce(_col(text), F.lit("")))), report)


def nlp_quality(compound: Column | str, features: Column | str, n_words: Column | str) -> Column:
    """0..100 from sentiment (50), number of features (25) and length (25)."""
    zero = F.lit(0.0)
    return round_even(
        (F.coalesce(_col(compound), zero) + 1) * 25
        + clip(F.coalesce(_col(features).cast("double"), zero), 0.0, 5.0) * 5
        + clip(F.coalesce(_col(n_words).cast("double"), zero), 0.0, 100.0) / 100 * 25,
        2,
    )


def risk_tier(fake: Column | str, compound: Column | str, rating: Column | str) -> Column:
    """High, Medium or Low Risk. A rating of 0 or null adds no risk."""
    fake, compound = _col(fake), _col(compound)
    known = F.nullif(_col(rating), F.lit(0.0))
    points = (
        F.when(fake > 60, 40).when(fake > 30, 20).otherwise(0)
        + F.when(compound < -0.2, 30).otherwise(0)
        + F.when(known < 2.5, 30).otherwise(0)
    )
    return F.when(points >= 60, "High Risk").when(points >= 30, "Medium Risk").otherwise("Low Risk")


def review_verdict(df, text: str = "review_text", rating: str = "rating"):
    """Reviews of three characters or more with a recommendation for each."""
    checked = df.where(F.length(F.trim(F.col(text))) >= 3).withColumn(
        "_report", fake_report(text, rating)
    )
    verdict = F.when(F.col("_report.is_suspicious"), "Flag for manual review").otherwise(
        "Appears genuine"
    )
    return checked.withColumn("recommendation", verdict).drop("_report")
