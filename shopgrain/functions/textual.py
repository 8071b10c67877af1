"""Text cleaning and dictionary matching as column expressions.

Dictionary operators take a text column, which they test natively, or the keywords a
``matching.Matcher`` has found in it. A text column is read many times, so hand over a
stored one (a ``withColumn`` earlier), which Catalyst keeps as a separate projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopgrain.functions.matching import Contains, Found, as_source, let
from shopgrain.functions.numbers import _col, parse_number


def words(c: Column | str) -> Column:
    """Blank-separated tokens; no empty tokens, so blank text has none."""
    return F.filter(F.split(_col(c), r"\s+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.coalesce(F.size(words(c)), F.lit(0)).cast("bigint")


# Printable ASCII that is neither a letter, a digit, a blank nor one of ``.,!?``.
_SYMBOLS = "".join(
    c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in ".,!?"
)


def clean_text(c: Column | str) -> Column:
    """Lower case, no tags, no links, only letters, digits and ``.,!?``.

    Native tests keep texts without a tag or a link away from those two patterns. Other
    characters become blanks by ``translate`` and one plain range, which Java matches
    about six times faster than the equal negated class of letters, digits and marks.
    """

    def drop(test, pattern: str):
        return lambda t: F.when(test(t), F.regexp_replace(t, pattern, "")).otherwise(t)

    tags = drop(lambda t: t.contains("<"), r"<[^>]+>")
    links = drop(lambda t: t.contains("http") | t.contains("www"), r"http\S+|www\S+")
    plain = F.translate(let(let(F.lower(_col(c)), tags), links), _SYMBOLS, " " * len(_SYMBOLS))
    ascii_only = F.regexp_replace(plain, r"[^\x20-\x7e]+", " ")
    return F.coalesce(F.trim(F.regexp_replace(ascii_only, r"  +", " ")), F.lit(""))


def combine_text(a: Column | str, b: Column | str) -> Column:
    return F.trim(F.concat(_col(a), F.lit(" "), _col(b)))


def title_length(c: Column | str) -> Column:
    return F.coalesce(F.length(_col(c)), F.lit(0)).cast("bigint")


def classify(
    c: Column | str | Contains | Found,
    dictionary: Mapping[str, Sequence[str]],
    weight=lambda keyword: 1,
    default: str = "Other",
) -> Column:
    """Category with the largest keyword score; ties go to the earlier category."""
    source = as_source(c)

    def score(keywords: Sequence[str]) -> Column:
        by_weight: dict[int, list[str]] = {}
        for k in keywords:
            by_weight.setdefault(weight(k), []).append(k)
        return reduce(add, [source.count(group) * w for w, group in by_weight.items()])

    scores = F.array(*[F.coalesce(score(kws), F.lit(0)) for kws in dictionary.values()])
    labels = _literals(list(dictionary))

    def pick(s: Column) -> Column:
        first = F.array_position(s, F.array_max(s)).cast("int")
        return F.when(F.array_max(s) > 0, F.element_at(labels, first)).otherwise(default)

    return let(scores, pick)


def long_word_weight(keyword: str) -> int:
    """Keywords of more than four letters count double."""
    return 2 if len(keyword) > 4 else 1


def _spoken(word: str) -> str:
    """A dictionary entry in the form ``clean_text`` would leave it in."""
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", word.lower())).strip()


def extract_brand(
    c: Column | str | Contains | Found, brands: Sequence[str], match: str = "substring",
    default: str = "Unknown",
) -> Column:
    """First brand of the ordered list found in the text.

    ``substring`` also hits inside words (``acer`` in ``spacer``); ``word`` needs
    whole tokens and compares the entries in their cleaned form.
    """
    if match == "substring":
        source = as_source(c)
        tests = [(source.has(b), b.title()) for b in brands]
        if isinstance(source, Found):
            # Most texts name no brand: one look instead of one per brand.
            none = ~F.coalesce(source.any(brands), F.lit(False))
            tests = [(none, default), *tests]
    elif match == "word":
        plain = F.regexp_replace(F.lower(_col(c)), r"[^a-z0-9]+", " ")
        padded = F.concat(F.lit(" "), plain, F.lit(" "))
        tests = [(padded.contains(f" {_spoken(b)} "), b.title()) for b in brands]
    else:
        raise ValueError("match is 'substring' or 'word'")
    out = F.when(F.lit(False), F.lit(default))
    for test, name in tests:
        out = out.when(test, name)
    return out.otherwise(default)


def first_price(c: Column | str) -> Column:
    """First ``$`` amount of the raw text as a number, else null."""
    hit = F.regexp_extract(_col(c), r"\$([\d,]+\.?\d*)", 1)
    return parse_number(F.regexp_replace(hit, ",", ""))


def mentions(c: Column | str | Contains | Found, dictionary: Mapping[str, Sequence[str]]) -> Column:
    """Names of the dictionary entries with any keyword in the text, as an array."""
    source = as_source(c)
    return F.array_compact(
        F.array(*[F.when(source.any(kws), F.lit(name)) for name, kws in dictionary.items()])
    )


def mention_list(names: Column | str) -> Column:
    """Comma list of an array of names, ``none`` when empty."""
    names = _col(names)
    return F.when(F.size(names) > 0, F.array_join(names, ",")).otherwise("none")


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def aspects(
    c: Column | str,
    dictionary: Mapping[str, Sequence[str]],
    positive: Sequence[str],
    negative: Sequence[str],
    min_length: int = 5,
    found: Found | None = None,
) -> Column:
    """Map of aspect to polarity.

    An aspect counts when one of its keywords occurs; its polarity compares the
    distinct positive and negative words of the whole text. Tokens lose the
    punctuation around them first. ``found`` supplies keywords that are already known.
    """
    text = F.lower(_col(c))
    source = found or Contains(text)
    names = list(dictionary)
    hit = F.array_compact(
        F.array(*[F.when(source.any(kws), F.lit(name)) for name, kws in dictionary.items()])
    )
    tokens = words(F.regexp_replace(text, r"[.,!?]", " "))
    told = F.array_distinct(F.filter(tokens, lambda w: w.isin([*positive, *negative])))

    def polarity(t: Column) -> Column:
        pos = F.size(F.filter(t, lambda w: w.isin(list(positive))))
        neg = F.size(F.filter(t, lambda w: w.isin(list(negative))))
        return F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")

    # Only a text with an aspect needs its words; they are looked at once.
    none = F.create_map().cast("map<string,string>")
    said = let(
        let(told, polarity),
        lambda p: F.map_from_arrays(hit, F.transform(hit, lambda _: p)),
    )
    relevant = (F.length(text) >= min_length) & source.any([k for n in names for k in dictionary[n]])
    return F.when(relevant, said).when(text.isNotNull(), none)


def sentiment_label(compound: Column | str) -> Column:
    c = _col(compound)
    return F.when(c >= 0.05, "Positive").when(c <= -0.05, "Negative").otherwise("Neutral")


def sentiment_summary(label: Column | str, compound: Column | str) -> Column:
    """Sentence with the absolute compound score as a percentage, one digit."""
    pct = F.round(F.abs(_col(compound)) * 100, 1)
    return F.concat(
        F.lit("This text is "), F.lower(_col(label)),
        F.lit(" (confidence: "), F.format_string("%.1f", pct), F.lit("%)"),
    )


def content_text(
    name: Column, category: Column, brand: Column, review: Column, features: Column,
    review_chars: int | None = None,
) -> Column:
    """Text that stands for a product in content matching: the name twice, category,
    brand, the review (its first ``review_chars`` signs, or all of it), features."""
    name = F.when(name != "", name)
    body = review if review_chars is None else F.substring(review, 1, review_chars)
    return F.trim(
        F.concat_ws(
            " ",
            name,
            name,
            F.when((category != "") & (category != "Other"), category),
            F.when((brand != "") & (brand != "Unknown"), brand),
            F.when(F.length(review) > 10, body),
            F.when((features != "") & (features != "none"), F.translate(features, ",", " ")),
        )
    )


def overlap(a: Column, b: Column) -> tuple[Column, Column]:
    """Sizes of the intersection and the union of two word arrays."""
    return (
        F.size(F.array_intersect(a, b)).cast("bigint"),
        F.size(F.array_union(a, b)).cast("bigint"),
    )
