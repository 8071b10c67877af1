"""SentencePiece against the library, languages and scores against held-out documents and plain counts."""

import collections
import hashlib
import math
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopgrain.llm import language_id, language_model, queries, sentencepiece_codec
from shopgrain.llm.common import learned_from

MODEL = public_tokenizers.path(queries.MODEL)
SIGNS = st.text(st.sampled_from(list(" ab\n\t▁é😀.0<>\x00　")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(SIGNS, min_size=1, max_size=6))
def test_ids_are_those_of_the_library(texts):
    table = sentencepiece_codec.word_table(MODEL)
    assert sentencepiece_codec.encode_batch(pa.array(texts), table).to_pylist() == table.model.encode(texts, add_eos=True)


def test_sentencepiece_query(spark, sf_dir, texts):
    library = sentencepiece_codec.word_table(MODEL).model
    got = {r["doc_id"]: r for r in queries.op7_sentencepiece(spark, sf_dir).collect()}
    assert len(got) == len(texts)
    for doc_id, text, _ in texts:
        ids = library.encode(text or "", add_eos=True)
        r = got[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_codec_edge_rows(rows):
    data = [(1, None), (2, ""), (2, ""), (3, "  a  b "), (None, "wort " * 60_000)]
    for table in (rows("doc_id long, text string", data), rows("doc_id long, text string", [])):
        coded = sentencepiece_codec.decode(sentencepiece_codec.encode(table, MODEL), MODEL)
        assert set(table.columns) <= set(coded.columns)
        for r in coded.collect():
            assert r["decoded"] == (r["text"] or "") and r["ids"][-1] == 2
        both = sentencepiece_codec.encode(table, MODEL, decoded="decoded")
        assert sorted(map(str, both.collect())) == sorted(map(str, coded.collect()))


def test_language_query_on_held_out_documents(spark, sf_dir, texts):
    lang = {d: x for d, _, x in texts}
    got = queries.op8_language(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {*lang.values(), "und"}
    out = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) / len(out) > 0.95
    assert sum(r["rejected"] for r in got) <= 0.01 * len(got)


def test_language_edge_rows(spark, rows):
    data = [(i, "the cat and the dog " * (1 + i % 7), "en") for i in range(40)]
    data += [(100 + i, "der Hund und die Katze " * (1 + i % 7), "de") for i in range(40)]
    odd = [(200, None, "en"), (201, "", None), (202, "12 !?", "de"), (202, "12 !?", "de"), (None, "the dog", None),
           (203, "и кот и пёс и мышь " * 9, None), (204, "and the dog " * 20_000, None)]
    table = rows("doc_id long, text string, lang string", data + odd)
    model = language_id.fit(table, learned_from("doc_id", 3))
    got = [(r["doc_id"], r["language"]) for r in language_id.identify(table, model).collect()]
    assert len(got) == len(data + odd)
    by = {i: x for i, x in got}
    assert all(by[i]["lang"] == ("en" if i < 100 else "de") for i in (*range(40), *range(100, 140)))
    assert all(by[i]["lang"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (200, 201, 202))
    assert by[None]["lang"] == "en" and by[204]["lang"] == "en" and by[203]["rejected"]
    none = language_id.fit(rows("doc_id long, text string, lang string", []), learned_from("doc_id", 3))
    assert {r["language"]["lang"] for r in language_id.identify(table, none).collect()} == {"und"}
    assert language_id.identify(table.limit(0), model).count() == 0


def test_a_language_that_was_not_learned_is_rejected(spark, sf_dir):
    sf_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang IS NOT NULL AND n_chars > 200")
    for unlearned in ("de", "es", "fr"):
        model = language_id.fit(docs.where(f"lang <> '{unlearned}'"), learned_from("doc_id", 3))
        got = language_id.identify(docs, model).groupBy((docs.lang == unlearned).alias("new")).agg(
            F.avg(F.col("language.rejected").cast("int")).alias("share")
        )
        share = {r["new"]: r["share"] for r in got.collect()}
        assert share[True] > 0.9 and share[False] <= 0.01


def test_a_few_odd_texts_do_not_let_all_pass(rows):
    rng = np.random.default_rng(3)
    usual = "the and with that from have this which would their there about other could water people".split()
    data = [(i, " ".join(rng.choice(usual, 12)), "en") for i in range(3000)]
    odd = ["".join(chr(0x4E00 + 100 * k + i) for i in range(70)) for k in range(12)]  # no gram in common
    data += [(3000 + i, t, "en") for i, t in enumerate(odd)]
    new = [(4000, "hyvää päivää kuinka voitte tänään olemme menossa kylään syömään kalaa", None)]
    model = language_id.fit(rows("doc_id long, text string, lang string", data), F.lit(True), sample=5000)
    got = language_id.identify(rows("doc_id long, text string, lang string", new + data[:50]), model).collect()
    assert [r["doc_id"] for r in got if r["language"]["rejected"]] == [4000]
    assert min(model.lowest.values()) > 0.3


def test_limits_rest_on_all_rows_and_not_on_one():
    def by(**cosines):
        return {int(z[1:]): np.bincount((np.array(c) * language_id.STEPS).astype(int), minlength=language_id.STEPS + 1) for z, c in cosines.items()}

    usual = [0.5 + i / 1000 for i in range(300)]
    assert language_id.low(by(z9=usual), 9) >= 0.5
    assert language_id.low(by(z9=[*usual, 0.01]), 9) >= 0.5  # one odd text
    assert 0.5 <= language_id.low(by(z9=usual, z10=[0.95]), 10) < 0.51  # a length with one text
    assert language_id.low(by(z9=[0.4] * 5), 9) == pytest.approx(0.4)


def _tokens(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w.decode() for w in low.encode().split()] + [""]


def _base(texts):
    counts = collections.Counter()
    for d, t in texts:
        if d is None or zlib.crc32(str(d).encode()) % 5 != 1:
            counts.update(_tokens(t))
    n, v = sum(counts.values()), len(counts)
    return counts, n, lambda t: sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in _tokens(t))


def test_language_model_query(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 500)  # so that rare words are joined
    sf_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")  # 200 documents are too few to learn from
    t = pq.read_table(os.path.join(sf_dir, "documents.parquet"), columns=["doc_id", "text"])
    texts = [(d, x, None) for d, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True)]
    counts, n, base = _base([(d, t) for d, t, _ in texts])
    text = {d: t for d, t, _ in texts}
    got = queries.op9_language_model(spark, sf_dir).collect()
    assert len(got) == len(texts)
    gain = tokens = 0
    for r in got:
        t = _tokens(text[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(base(text[r["doc_id"]]), rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        if r["held_out"]:
            gain, tokens = gain + r["score"] - r["base_score"], tokens + len(t)
    assert gain / tokens > 0.01  # better than counts alone on documents it has not seen


def test_language_model_edge_rows(rows):
    data = [(1, None), (2, ""), (2, ""), (None, "A b a"), (3, "a b " * 50_000), (9, "a zz")]
    table = rows("doc_id long, text string", data)
    counts, n, base = _base(data)
    got = language_model.score(table, learned_from("doc_id", 5)).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 1, 3, 4, 100_001]
    for r in got:
        want = [base(t) for d, t in data if d == r["id"]]
        assert any(r["base_score"] == pytest.approx(w) for w in want) and r["train_tokens"] == n
    untrained = language_model.score(table, learned_from("doc_id", 5) & learned_from("doc_id", 5).isNull()).collect()
    assert all(r["base_score"] == 0 and r["train_tokens"] == 0 and r["n_known"] == 0 for r in untrained)
    assert language_model.score(table.limit(0), learned_from("doc_id", 5)).count() == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    model = language_model.LogBilinear.new(9, rng.normal(size=9))
    assert np.allclose((10 ** model.log10_rows(np.arange(81))).sum(1), 1)


def _pairs(k=400, texts=1500):
    """Words that are all equally frequent, and each of which only its own follows."""
    rng = np.random.default_rng(1)
    return [(i, " ".join(f"a{j}x b{j}y" for j in rng.integers(0, k, 20))) for i in range(texts)]


def test_language_model_follows_every_word(rows):
    data = _pairs()
    got = language_model.score(rows("doc_id long, text string", data), learned_from("doc_id", 5)).collect()
    text = dict(data)
    held = [r for r in got if zlib.crc32(str(r["id"]).encode()) % 5 == 1]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert len(held) > 100 and len(text) == len(got)
    # Half of the words are certain after the one before, a gain of nearly log10(800) each; 253 words are a third.
    assert gain > 0.9


def test_language_model_trains_on_every_token(spark, rows, monkeypatch):
    table = rows("doc_id long, text string", _pairs(texts=600)).select("text").repartition(5)
    known = language_model.Vocabulary.of(language_model.count_tokens(table))
    assert known.total == 600 * 41
    shared = spark.sparkContext.broadcast(known)
    noise = (known.mass + 0.5) / (known.mass + 0.5).sum()
    model = language_model.LogBilinear.new(known.size, np.log(noise))
    for least, times in ((1, 1), (2 * known.total, language_model.ROUNDS)):  # many tokens and few
        monkeypatch.setattr(language_model, "LEAST_DRAWS", least)
        seen = 0
        for step in range(language_model.ROUNDS):
            moved = language_model.moves(table, shared, model, noise, step)
            seen += sum(r["n"] for r in moved.select("trainer", "n").distinct().collect())
        assert seen == times * known.total


def test_weights_of_two_levels_are_those_scored():
    rng = np.random.default_rng(0)
    model = language_model.LogBilinear.new(90, rng.normal(size=90))
    two, one, target = rng.integers(0, 90, 500), rng.integers(0, 90, 500), rng.integers(1, 90, 500)
    want = model.log10_rows(two * 90 + one)[np.arange(500), target]
    assert np.allclose(model.scorer()(two, one, target), want, atol=1e-4)


def test_words_are_found_without_python_strings(rows):
    """Places and buckets of a slice's words come from Arrow and are those of the single words; counts do not depend on slices."""
    words = [b"", b"a", b"ab", b"abc", "größe".encode(), b"xyzabc", b"abc"]
    assert language_model.buckets_of(pa.array([b"before", *words], pa.binary())[1:], 97).tolist() == [language_model.bucket(w, 97) for w in words]
    known = language_model.Vocabulary.of(language_model.count_tokens(rows("text string", [("a a a b a a a a a c",), ("abc",)])))
    place, buckets = known.places(pa.array([b"a", b"zz", b"abc"], pa.binary()))
    assert known.tokens[int(place[0])].as_py() == b"a" and buckets[0] == -1 and known.n[place[0]] == 8
    assert place[1] == -1 and buckets[1] == language_model.bucket(b"zz", len(known.within)) and known.n[place[2]] == 1


def test_scores_where_exponentials_would_overflow():
    rng = np.random.default_rng(0)
    model = language_model.LogBilinear.new(90, rng.normal(size=90))
    model.flat[: 2 * 90 * language_model.DIMS] *= 60  # products of hundreds
    two, one, target = rng.integers(0, 90, 500), rng.integers(0, 90, 500), rng.integers(1, 90, 500)
    got, want = model.scorer()(two, one, target), model.log10_rows(two * 90 + one)[np.arange(500), target]
    assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-4, atol=1e-2)
