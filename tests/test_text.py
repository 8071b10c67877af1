"""Text, sentiment, trust and search operators on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from shopgrain.functions import dictionaries as D
from shopgrain.functions import textual as X
from shopgrain.functions import matching, trust
from shopgrain.operators import search, sentiment, tfidf


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clean_text(spark):
    got = column(
        spark,
        [None, "", "  ", "<b>x</b> Y", "see http://a.b/c", "Café-crème!", "a\n\tb", "www.x.y end"],
        X.clean_text("v"),
    )
    assert got == ["", "", "", "x y", "see", "caf cr me!", "a b", "end"]


def test_words_of_blank_text(spark):
    assert column(spark, ["", "  ", " a  b ", None], X.word_count("v")) == [0, 0, 2, 0]


def test_category_ties_go_to_the_earlier_entry(spark):
    got = column(spark, ["laptop speaker", "gpu", "speaker soundbar laptop", "zzz", None],
                 X.classify("v", D.CATEGORY_KEYWORDS))
    assert got == ["Electronics", "Electronics", "Audio", "Other", "Other"]


def test_weighted_category(spark):
    got = column(spark, ["ram ssd camera", "ram camera"],
                 X.classify("v", D.RECOMMENDER_KEYWORDS, X.long_word_weight))
    assert got == ["Electronics", "Camera"]


def test_brand_modes(spark):
    texts = ["a spacer of sony", "tp link router", "my acer", None]
    assert column(spark, texts, X.extract_brand("v", D.BRANDS)) == ["Sony", "Unknown", "Acer", "Unknown"]
    assert column(spark, texts, X.extract_brand("v", D.BRANDS, match="word")) == [
        "Sony", "Tp-Link", "Acer", "Unknown"
    ]
    assert column(spark, ["spacer"], X.extract_brand("v", D.BRANDS)) == ["Acer"]
    assert column(spark, ["spacer"], X.extract_brand("v", D.BRANDS, match="word")) == ["Unknown"]


def test_first_price(spark):
    got = column(spark, ["was $1,299.99 now $5", "$, none", "no", None, "$7."], X.first_price("v"))
    assert got == [1299.99, None, None, None, 7.0]


def test_mentions(spark):
    names = X.mentions("v", D.FEATURE_KEYWORDS)
    got = column(spark, ["fast usb battery", "zzz"], X.mention_list(names))
    assert got == ["battery,performance,connectivity", "none"]


def test_aspects(spark):
    a = X.aspects("v", D.ASPECT_KEYWORDS, D.POSITIVE_WORDS, D.NEGATIVE_WORDS)
    got = column(spark, ["great! battery", "bad box", "bad but good lens", "lens", "none here"], a)
    assert got == [{"battery": "positive"}, {"delivery": "negative"}, {"camera": "neutral"}, {}, {}]


def one_sentiment(spark, text, lexicon=None):
    df = spark.createDataFrame([("a", text)], "id string, t string")
    return sentiment.sentiment(df, "id", "t", sentiment.lexicon_table(spark, lexicon)).first()


@pytest.mark.parametrize("joined", [False, True])
def test_sentiment_keeps_rows_with_equal_keys_apart(spark, monkeypatch, joined):
    if joined:
        monkeypatch.setattr(sentiment, "FILTER_WORDS", 2)  # a larger lexicon is joined
    rows = [("a", "great"), ("a", "terrible"), (None, "good"), (None, "good"), ("b", None), ("c", "")]
    df = spark.createDataFrame(rows, "id string, t string")
    lexicon = {"great": 3.1, "terrible": -2.1, "good": 1.9}
    got = sentiment.sentiment(df, "id", "t", sentiment.lexicon_table(spark, lexicon)).collect()
    assert sorted((r["id"] or "", r["sentiment_compound"], r["sentiment_neutral"]) for r in got) == [
        ("", compound(1.9), 0.0), ("", compound(1.9), 0.0), ("a", compound(-2.1), 0.0), ("a", compound(3.1), 0.0),
        ("b", 0.0, 1.0), ("c", 0.0, 1.0),
    ]


@pytest.mark.parametrize("joined", [False, True])
def test_lexicon_file_with_phrases(spark, monkeypatch, tmp_path, joined):
    """Longest entry at a place, none within an earlier one; a phrase is one sentiment word of its length."""
    if joined:
        monkeypatch.setattr(sentiment, "FILTER_WORDS", 2)
    (tmp_path / "words.txt").write_text(
        "good\t1.9\tnote\nBad  Ass!\t2.0\nbad\t-2.5\nass kicking good\t3.0\n\t1\nugly\tn/a\nfine\t1\nFine\t2\n"
        "inf\tInfinity\nzero sum\t0\n", encoding="utf-8"
    )
    lexicon = sentiment.scan_lexicon(spark, str(tmp_path))
    assert sorted(map(tuple, lexicon.collect())) == [
        ("ass kicking good", 3.0), ("bad", -2.5), ("bad ass", 2.0), ("fine", 1.5), ("good", 1.9), ("zero sum", 0.0)]
    cases = {
        "a bad ass phone": (2.0, 1, 3), "bad phone": (-2.5, 1, 3.5), "bad ass kicking good thing": (2.0, 3, 3),
        "not bad ass": (2.0 * -0.74, 1, 2.48), "ass kicking good": (3.0, 0, 4), "bad ass": (2.0, 0, 3), "ass kicking": None,
        "fine zero sum": (1.5, 2, 2.5), "": None,
    }
    # "good" lies within the phrase that "bad ass" covers: covered matches count as cover themselves.
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "id int, t string")
    got = {r["id"]: r for r in sentiment.sentiment(df, "id", "t", lexicon).collect()}
    # "a" has one letter and is no token.
    for i, (text, want) in enumerate(cases.items()):
        if want is None:
            assert got[i]["sentiment_compound"] == 0.0 and got[i]["sentiment_neutral"] == 1.0
        else:
            total, neutral, weight = want
            assert got[i]["sentiment_compound"] == pytest.approx(compound(total), abs=1e-4), text
            assert got[i]["sentiment_neutral"] == pytest.approx(neutral / (weight + neutral), abs=1e-4), text


def compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


@pytest.mark.parametrize(
    "text, total",
    [
        ("a good phone", 1.9),
        ("not good phone", 1.9 * -0.74),
        ("very good phone", 1.9 + 0.293),
        ("very bad phone", -2.5 - 0.293),
        ("really the good phone", 1.9 + 0.293 * 0.95),
        ("slightly good phone", 1.9 - 0.293),
        ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
        ("good phone!!", 1.9 + 2 * 0.292),
        ("bad phone!!!!!!", -2.5 - 4 * 0.292),
    ],
)
def test_sentiment_rules(spark, text, total):
    row = one_sentiment(spark, text)
    assert row["sentiment_compound"] == pytest.approx(compound(total), abs=1e-4)
    label = "Positive" if total > 0 else "Negative"
    assert row["sentiment_label"] == label


def test_sentiment_shares(spark):
    row = one_sentiment(spark, "good phone here")
    whole = 2.9 + 2
    assert row["sentiment_positive"] == round(2.9 / whole, 4)
    assert row["sentiment_neutral"] == round(2 / whole, 4)
    assert row["sentiment_negative"] == 0.0


@pytest.mark.parametrize("text", ["", "ok", "plain words only", None])
def test_sentiment_defaults(spark, text):
    row = one_sentiment(spark, text)
    assert (row["sentiment_compound"], row["sentiment_neutral"], row["sentiment_label"]) == (0.0, 1.0, "Neutral")


def fake(spark, text, rating, preset, features=0):
    df = spark.createDataFrame([(text, rating, features)], "t string, r double, f bigint")
    return df.select(trust.fake_score("t", "r", preset, "f")).first()[0]


def test_fake_presets(spark):
    assert fake(spark, "ok", 5.0, "batch") == 40
    assert fake(spark, "ok", None, "batch") == 10
    assert fake(spark, "", 5.0, "batch") == 30
    assert fake(spark, "buy buy buy buy buy buy", 1.0, "batch", 1) == 25
    assert fake(spark, "best best love !!!!", 5.0, "api") == 75
    assert fake(spark, "GREAT GREAT GREAT", 5.0, "raw") == 25 + 20 + 15 + 20
    assert fake(spark, "great great great", 5.0, "raw") == 25 + 20 + 20


def test_fake_report_flags(spark):
    df = spark.createDataFrame([(" Best BEST love !!!! ", 5.0)], "t string, r double")
    r = df.select(trust.fake_report("t", "r").alias("r")).first()["r"]
    assert r["is_suspicious"] and r["risk_level"] == "High" and r["review_length"] == 19
    assert r["flags"] == ["Very short review", "5-star with minimal text", "Excessive exclamation marks (4)",
                          "Generic positive words only"]


def test_risk_tier_unknown_ratings_add_nothing(spark):
    rows = [(70, -0.5, 1.0), (70, 0.0, 0.0), (35, -0.3, None), (0, 0.0, 2.4), (0, 0.0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f int, c double, r double")
    got = [r[0] for r in df.orderBy("i").select(trust.risk_tier("f", "c", "r")).collect()]
    assert got == ["High Risk", "Medium Risk", "Medium Risk", "Medium Risk", "Low Risk"]


def test_nlp_quality_limits(spark):
    df = spark.createDataFrame([(1.0, 9, 500), (-1.0, 0, 0), (None, None, None)], "c double, f int, w int")
    assert [r[0] for r in df.select(trust.nlp_quality("c", "f", "w")).collect()] == [100.0, 0.0, 25.0]


def test_tfidf_against_the_formula(spark):
    docs = spark.createDataFrame([(1, "red ring red"), (2, "blue ring"), (3, "")], "k int, t string")
    weights, vocab = tfidf.tfidf(docs, "k", "t", bigrams=False)
    idf = {t: math.log((1 + 3) / (1 + n)) + 1 for t, n in (("red", 1), ("ring", 2), ("blue", 1))}
    raw = {"red": (1 + math.log(2)) * idf["red"], "ring": idf["ring"]}
    norm = math.sqrt(sum(x * x for x in raw.values()))
    got = {r["term"]: r["weight"] for r in weights.where("k = 1").collect()}
    assert got == pytest.approx({t: x / norm for t, x in raw.items()})
    assert vocab.count() == 3


def test_tfidf_term_limit_and_bigrams(spark):
    docs = spark.createDataFrame([(1, "the red ring"), (2, "red ring")], "k int, t string")
    weights, vocab = tfidf.tfidf(docs, "k", "t")
    assert {r["term"] for r in vocab.collect()} == {"red", "ring", "red ring"}
    assert tfidf.tfidf(docs, "k", "t", max_terms=2)[1].count() == 2


def test_product_document_defaults(spark):
    df = spark.createDataFrame(
        [(1, "x" * 160, None, None, None, "none", "abc")],
        "product_idx int, product_name string, price double, rating double, review_count bigint,"
        "features string, review_text string",
    )
    lines = search.product_document(df, name_chars=150).first()["document"].split("\n")
    assert lines == [
        "Product: " + "x" * 150, "Category: General", "Brand: Unknown", "Price: $0.00", "Rating: 0.0/5.0",
        "Reviews: 0 customer reviews", "Sentiment: Neutral", "Features: General product",
        "Review excerpt: No review available",
    ]


def test_last_turns_keeps_the_latest_pairs(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(10)]
    df = spark.createDataFrame([*rows, (2, 0, "user", "alone")], "conv_id bigint, turn bigint, role string, text string")
    got = search.last_turns(df).collect()
    assert [(r["conv_id"], r["history"]) for r in got] == [
        (1, "".join(f"User: m{t}\nAssistant: m{t + 1}\n\n" for t in (4, 6, 8)))
    ]


def test_context_and_answer(spark):
    hits = spark.createDataFrame(
        [("q", 2, "B", "c", 2.0, 3.0, 0.5, "doc b"), ("q", 1, "A", "c", 1.5, 4.25, 0.756, "doc a")],
        "query_id string, rank int, product_name string, category string, price double, rating double,"
        "score double, document string",
    )
    line = search.build_context(hits, "line").first()["context"]
    assert line.startswith("\nProduct 1: A | $1.50 | Rating: 4.3/5 | Category: c\n\nProduct 2: B")
    block = search.build_context(hits).first()["context"]
    assert block.startswith("\nProduct 1 (Similarity: 0.76):\ndoc a\n" + "-" * 40 + "\n")
    asks = spark.createDataFrame([("q",), ("z",)], "query_id string")
    answers = {r["query_id"]: r["answer"] for r in search.fallback_answer(asks, hits).collect()}
    assert answers["q"].startswith("Based on our database, I found 2 relevant products. Top match: A at $1.50")
    assert answers["z"] == search.NO_ANSWER
    summary = {r["query_id"]: (r["n_retrieved"], r["top_product"]) for r in search.batch_queries(asks, hits).collect()}
    assert summary == {"q": (2, "A"), "z": (0, "")}


def test_sentiment_summary_text(spark):
    df = spark.createDataFrame([("Positive", 0.8765)], "l string, c double")
    assert df.select(X.sentiment_summary("l", "c")).first()[0] == f"This text is positive (confidence: {0.8765:.1%})"


def test_overlap(spark):
    df = spark.range(1).select(F.split(F.lit("a b c"), " ").alias("x"), F.split(F.lit("b c d"), " ").alias("y"))
    a, b = X.overlap(F.col("x"), F.col("y"))
    assert tuple(df.select(a, b).first()) == (2, 4)


@pytest.mark.parametrize("native", [False, True])
def test_matcher_agrees_with_contains(spark, native):
    from shopgrain.functions.matching import Matcher, words_of

    matcher = Matcher(words_of(D.CATEGORY_KEYWORDS, D.BRANDS, D.FEATURE_KEYWORDS, D.ASPECT_KEYWORDS), native=native)
    texts = ["SmartWatch with gaming laptop", "a cheap tablet", "apple watch band", "", None, "great lens, bad box", "zzz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    df = df.withColumn("h", matcher.find("t"))
    known = matcher.found("h")
    words = (D.ASPECT_KEYWORDS, D.POSITIVE_WORDS, D.NEGATIVE_WORDS)
    pairs = [
        (X.classify(known, D.CATEGORY_KEYWORDS), X.classify("t", D.CATEGORY_KEYWORDS)),
        (X.extract_brand(known, D.BRANDS), X.extract_brand("t", D.BRANDS)),
        (X.mentions(known, D.FEATURE_KEYWORDS), X.mentions("t", D.FEATURE_KEYWORDS)),
        (X.aspects("t", *words, found=known), X.aspects("t", *words)),
    ]
    for ours, plain in pairs:
        rows = df.orderBy("i").select(ours.alias("a"), plain.alias("b")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows]


def test_texts_become_strings_a_slice_at_a_time(spark):
    """Python's memory must not follow the texts of a whole batch."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([f"good phone {i} " + "x" * 20_000 for i in range(2_000)] + [None, ""])
    scan, score = matching._scan(["phone"]).func, sentiment._scorer({"good": 2.0}).func
    tracemalloc.start()
    hits = [h for part in scan(iter([texts])) for h in part.to_pylist()]
    scores = score(texts).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == [[0]] * 2_000 + [None, []]
    assert [s["total"] for s in scores] == [2.0] * 2_000 + [None, None]
    assert peak < 20 << 20


def test_a_joined_lexicon_makes_rows_of_its_own_words_only(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("not so bad", 1.0), (None, 3.0)], "word string, valence double")
    bitmap = sentiment._bitmap(lexicon)
    assert sum(b.bit_count() for b in bitmap) == 2 and len(bitmap) * 8 == sentiment.BITS
    texts = ["plain words " * 500 + "good", None, "", "but it is not so bad, not so", "a ñandú good!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    found = df.select("i", sentiment._candidates(bitmap, 3)("t").alias("f")).orderBy("i").collect()
    assert [[(h["word"], h["pos"], h["len"], h["w1"]) for h in r["f"]["hits"]] for r in found] == [
        [("good", 1000, 1, "words")], [], [], [("not so bad", 3, 3, "is")], [("good", 1, 1, "ñandú")]
    ]
    assert [(r["f"]["n"], r["f"]["but"]) for r in found] == [(1001, 0), (0, 0), (0, 0), (8, 1), (2, 0)]


@pytest.mark.parametrize("slice_bytes", [4 << 20, 200])
def test_a_large_lexicon_is_looked_up_without_a_shuffle(spark, monkeypatch, slice_bytes):
    """In the row, packed, and joined a lexicon gives the same scores; packed, no text or word is shuffled."""
    import random

    words = ["good", "bad", "not", "very", "slightly", "but", "never", "ring", "blue", "old", "x", "great", "a b", "no", "ñu"]
    draw = random.Random(4)
    texts = [" ".join(draw.choice(words) + draw.choice(["", "!", ",", "?", "\t"]) for _ in range(draw.randint(0, 25))) for _ in range(200)]
    rows = [(i % 150, None if i % 17 == 3 else t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k bigint, t string").repartition(3)
    entries = {" ".join(draw.choice(words) for _ in range(draw.randint(1, 5))): draw.choice([-2.5, -1.0, 0.0, 1.5, 3.0]) for _ in range(120)}
    entries |= {"double  blank": 1.0, "": 2.0, "void": None}
    lexicon = spark.createDataFrame([*entries.items(), (None, 1.0)], "word string, valence double")

    def scores():
        return sentiment.sentiment(df, "k", "t", lexicon, ["t"])

    in_row = sorted(scores().collect(), key=str)
    monkeypatch.setattr(sentiment, "FILTER_WORDS", 2)
    monkeypatch.setattr(sentiment, "TEXT_BYTES", slice_bytes)
    plan = scores()._jdf.queryExecution().optimizedPlan().toString()
    assert not any(node in plan for node in ("Join", "Window", "Aggregate"))
    assert sorted(scores().collect(), key=str) == in_row
    assert sum(r["sentiment_compound"] != 0 for r in in_row) > 100
    monkeypatch.setattr(sentiment, "PACKED_WORDS", 100)
    assert "Join" in scores()._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(scores().collect(), key=str) == in_row


def test_repeated_entries_of_a_large_lexicon_all_count(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "FILTER_WORDS", 2)
    lexicon = spark.createDataFrame([("good", 2.0), ("good", 1.0), ("bad", -1.0)], "word string, valence double")
    assert sentiment._packed(lexicon) is None
    df = spark.createDataFrame([("a", "good")], "id string, t string")
    assert sentiment.sentiment(df, "id", "t", lexicon).first()["sentiment_compound"] == compound(3.0)


def test_token_lists_are_the_tokens(spark):
    texts = ["  a\x1cb  cc..d, ,\t\x0bx!y\r\n .hello! é! ", "", None, "..", "but but", "ñandú, x"]
    want = column(spark, texts, sentiment.sentiment_tokens(F.col("v")))
    assert column(spark, texts, sentiment.token_lists(F.col("v"))) == want


def test_words_of_a_packed_lexicon_are_found_by_hash():
    import numpy as np
    import pyarrow as pa

    words = pa.array(["good", "bad", "ñu", ""])
    hashes = sentiment._word_hashes(words)
    order = np.argsort(hashes)
    found = pa.array(["ñu", "ugly", "good", "x"])
    got = sentiment._places(found, words.take(pa.array(order)), hashes[order])
    assert [order[i] if i >= 0 else -1 for i in got] == [2, -1, 0, -1]
    # Equal hashes of two words, and no words at all.
    assert sentiment._places(found, words, np.zeros(4, np.int64)).tolist() == [2, -1, 0, -1]
    assert sentiment._places(found, words[:0], hashes[:0]).tolist() == [-1] * 4


def test_tasks_of_a_packed_lexicon_need_no_copy_of_the_package(spark, tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    path = sentiment._packed(spark.createDataFrame([("good", 2.0), ("bad day", -1.0)], "word string, valence double"))
    (tmp_path / "task").write_bytes(cloudpickle.dumps(sentiment._packed_scorer(path).func))
    code = (
        "import pickle, sys, pyarrow as pa; score = pickle.load(open(sys.argv[1], 'rb'))\n"
        "print([r['total'] for r in score(pa.array(['good', 'a bad day', 'bad'])).to_pylist()])"
    )
    run = subprocess.run([sys.executable, "-I", "-c", code, tmp_path / "task"], capture_output=True, text=True, cwd=tmp_path, timeout=60)
    assert run.stdout.strip() == "[2.0, -1.0, None]", run.stderr
