"""Runs of words, conversation tries and packing against plain versions, the library and SQL."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import oracle
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopgrain.llm import periodic_runs, prefix_trie, queries, vector_packing

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Runs of words


def plain_runs(words):
    kinds, out = {}, {}
    w = np.array([kinds.setdefault(x, len(kinds)) for x in words])
    for q in range(1, len(w) // 3 + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(int), [0]])
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e + q - s >= max(24, 3 * q):
                out.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def kept_words(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def found_runs(docs):
    counts = np.array([len(d) for d in docs], np.int64)
    found = periodic_runs.find_runs(np.array([x for d in docs for x in d], np.int64), counts)
    out = [[] for _ in docs]
    for d, *run in zip(*(f.tolist() for f in found), strict=True):
        out[d].append(tuple(run))
    return out


PERIODIC = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 9), st.integers(0, 3)), max_size=4
).map(lambda parts: [x for base, times, cut in parts for x in (base * times)[: max(1, len(base) * times - cut)]])


@settings(max_examples=150, deadline=None)
@given(st.lists(PERIODIC, min_size=1, max_size=5))
def test_runs_of_small_alphabets(docs):
    assert found_runs(docs) == [plain_runs(d) for d in docs]


def test_runs_whose_period_is_nearly_periodic():
    """Blocks with three and more occurrences in a window: the period follows from ends of stretches."""
    random.seed(5)
    docs = []
    for p in range(16, 80, 3):
        for inner in (1, 2, 3):
            base = [i % inner for i in range(p - 1)] + [9]
            docs.append([7] * random.randrange(5) + (base * 5)[: 4 * p + random.randrange(p)] + [8] * 3)
    assert found_runs(docs) == [plain_runs(d) for d in docs] and all(map(plain_runs, docs))


def test_wavelet_tree():
    random.seed(2)
    values = np.array([random.randrange(50) for _ in range(200)])
    tree, a = periodic_runs.WaveletTree(values), np.array([3, 10, 0, 57])
    b, x = np.array([20, 200, 200, 58]), np.array([25, 0, 70, 31])
    assert tree.below(a, b, x).tolist() == [int((values[i:j] < k).sum()) for i, j, k in zip(a, b, x, strict=True)]
    k = np.array([0, 100, 199, 0])
    assert tree.kth(a, b, k).tolist() == [sorted(values[i:j].tolist())[n] for i, j, n in zip(a, b, k, strict=True)]


def looped_words(doc_id, text):
    words, h = SPACE.findall(text or ""), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_op11_against_every_period(spark, sf_dir, texts):
    found = {r["doc_id"]: r for r in queries.op11_runs(spark, sf_dir).collect()}
    assert len(found) == len(texts) and any(r["n_runs"] for r in found.values())
    for doc_id, text, _ in texts:
        words, r = looped_words(doc_id, text), found[doc_id]
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(kept_words(words, runs)))


def test_runs_of_odd_rows(spark, rows):
    cases = [None, "", " \t\n", "a", "a " * 23, "a " * 24, "x y " * 40, "b c\x1cd " * 12, "a " * 200_000, "a " * 24]
    df = rows("id int, text string", [(i, t) for i, t in enumerate(cases)]).withColumn("RUNS", F.lit(1)).withColumn("collapsed", F.lit("x"))
    out = periodic_runs.periodic_runs(df)
    assert out.columns == [*df.columns, "runs_", "collapsed_"]
    got = {r["id"]: (sorted(map(tuple, r["runs_"])), r["collapsed_"]) for r in out.collect()}
    for i, t in enumerate(cases[:8]):
        words = SPACE.findall(t or "")
        assert got[i] == (plain_runs(words), " ".join(kept_words(words, plain_runs(words))))
    assert got[8] == ([(0, 200_000, 1)], "a") and got[9] == got[5] and len(got) == len(cases)
    assert periodic_runs.periodic_runs(rows("id int, text string", [])).collect() == []


# Conversation tries


def plain_trie(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(m) - 1) * (len(n[-1][1]) if n else 0)
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], sha(",".join(map(str, sorted(ends[n])))))
        for n, m in members.items()
    )


def as_tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


TURNS = "conv_id long, turn int, role string, text string"


def table_of(rows, conversations):
    return rows(TURNS, [(c, i, r, t) for c, ts in conversations.items() for i, (r, t) in enumerate(ts)])


@pytest.mark.parametrize("band", [2, 3, 4])
def test_tries_deeper_than_a_band_of_bands(spark, rows, band):
    random.seed(band)
    conversations = {}
    for c in range(30):
        base = conversations[random.randrange(c)] if c else []
        keep = base[: random.randrange(len(base) + 1)]
        conversations[c * 7 % 31] = keep + [(random.choice("ua"), random.choice(["", "x", "yy", "é😀"])) for _ in range(random.randrange(14))]
        conversations.setdefault(c, conversations[c * 7 % 31])
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    assert as_tuples(prefix_trie.prefix_trie(table_of(rows, conversations), ids, band)) == plain_trie(conversations)


def test_one_conversation_with_most_rows(spark, rows):
    """Its rows lie in several ranges of the sort; counts are carried from one to the next."""
    conversations = {1: [("u", str(i % 3)) for i in range(300)], 2: [("u", str(i % 3)) for i in range(40)], 3: [("u", "1")]}
    turns = table_of(rows, conversations)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = prefix_trie.running(turns.select("conv_id", "turn"), "conv_id", ["turn"], "place")
        assert all(r["turn"] == r["place"] for r in placed.collect())
        assert as_tuples(prefix_trie.prefix_trie(turns)) == plain_trie(conversations)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_tries_of_odd_rows(spark, rows):
    data = [
        (1, None, "u", "a"), (1, 0, None, "b"), (1, 0, None, "b"), (2, None, "u", "a"), (2, 5, "", "b"), (3, 1, "u", None),
        (None, 0, "u", "a"), (-4, 1, "u", ""), (5, 1, "x" * 100_000, "y" * 100_000),
    ]
    expected = plain_trie({
        1: [("u", "a"), ("", "b"), ("", "b")], 2: [("u", "a"), ("", "b")], 3: [("u", "")], -4: [("u", "")],
        5: [("x" * 100_000, "y" * 100_000)],
    })
    found = prefix_trie.prefix_trie(rows(TURNS, data).withColumn("key", F.lit(1)).withColumn("depth", F.lit(2)))
    assert as_tuples(found) == expected
    assert prefix_trie.prefix_trie(rows(TURNS, [])).collect() == []
    only = spark.createDataFrame([(9,), (None,), (9,)], "conv_id long")
    assert as_tuples(prefix_trie.prefix_trie(rows(TURNS, []), only)) == plain_trie({9: []})


def test_long_lists_of_members_are_hashed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 20)
    ends = spark.range(-50, 500).select((F.col("id") % 2).cast("string").alias("key"), F.col("id").alias("c"))
    got = dict(map(tuple, prefix_trie._listed(ends).collect()))
    for key in ("0", "1", "-1"):
        ids = [i for i in range(-50, 500) if str(i % 2 if i >= 0 else -(-i % 2)) == key]
        assert got[key] == sha(",".join(map(str, ids)))


def test_op12_against_sql(spark, sf_dir):
    con = oracle.connect(sf_dir)
    assert oracle.differences(queries.op12_prefix_trie(spark, sf_dir), con, queries.OP12_SQL) == []


# Packing

FILE = public_tokenizers.path(queries.WORD_MODEL)
NASTY = [
    None, "", " ", "\n\t ", "don't DON'T we'll 'tis o'clock'S", "a1b22c  333", "É Ö ÿ ß × ÷ ÀÉ", "İstanbul ǅ ΣΑΣ Σ", "é ́x",
    "naïve—dash…", "<|endoftext|> x<|startoftext|>y", "<|END|>", "你好 世界", "😀😀 a b", "a b c\x1cd\x85e", "x\x00y \x7f", "~!@# $%^",
    "ªº µ ²³¼", "ſt ﬁ K Å", "w" * 5000, "it's'm'll", "ẞ ẞ ﬀ", "﻿bom", "a‍b",
]


def library_ids(texts):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return [e.ids for e in Tokenizer.from_file(FILE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def cut_ids(texts):
    ids, counts = vector_packing.token_ids(pa.array([t or "" for t in texts], pa.string()), vector_packing.word_ids(FILE))
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]


def test_words_give_the_ids_of_whole_texts(texts):
    cases = NASTY + [t for _, t, _ in texts]
    assert cut_ids(cases) == library_ids(cases)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x3FF) | st.sampled_from(list(" '\n ́ſﬁ<|>"))), max_size=6))
def test_words_of_any_signs(cases):
    assert cut_ids(cases) == library_ids(cases)


def test_op13_against_the_library(spark, sf_dir, texts):
    rows = queries.op13_packing(spark, sf_dir).toPandas()
    expected = []
    for (doc_id, _, _), ids in zip(texts, library_ids([t for _, t, _ in texts]), strict=True):
        whole = np.array([*ids, 0], "<u4")
        for k, s in enumerate(range(0, len(whole), 2048)):
            expected.append((doc_id, k, s, len(whole[s : s + 2048]), zlib.crc32(whole[s : s + 2048].tobytes())))
    got = rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)
    assert sorted(got) == sorted(expected)
    filled(rows.sequence_id, rows.offset, rows.length, 2048)
    assert rows.sequence_id.nunique() <= 1.02 * -(-rows.length.sum() // 2048)


def filled(sequence, offset, length, size):
    ends = defaultdict(int)
    for s, o, n in sorted(zip(sequence, offset, length, strict=True)):
        assert o == ends[s]
        ends[s] += n
    assert max(ends.values(), default=0) <= size
    return len(ends)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents, attention", [(100, 100**2), (3, 100**2), (100, 4000), (4, 5200)])
def test_every_capacity_holds(spark, rule, documents, attention):
    random.seed(7)
    lengths = [random.choice([1, 2, 3, 7, 10, 22, 30, 45, 60]) for _ in range(400)]
    room = vector_packing.Capacity(100, documents, attention, rule=rule)
    df = spark.createDataFrame(list(enumerate(lengths)), "id int, length int").repartition(5)
    rows = vector_packing.pack(df, room).toPandas()
    assert sorted(zip(rows.id, rows.length, strict=True)) == list(enumerate(lengths))
    filled(rows.sequence_id, rows.offset, rows.length, 100)
    of = rows.groupby("sequence_id").length
    assert of.count().max() <= documents and of.apply(lambda x: (x**2).sum()).max() <= attention
    least = max(sum(lengths) / 100, len(lengths) / documents, sum(n * n for n in lengths) / attention)
    assert rows.sequence_id.nunique() <= 1.25 * least + 2


def test_packing_odd_rows(spark, rows):
    df = rows("length int, text string", [(None, "a"), (0, "b"), (-3, "c"), (5, "d"), (5, "d"), (5, None), (10, "e")])
    out = vector_packing.pack(df.withColumn("offset", F.lit("x")), vector_packing.Capacity(10, 10, 100))
    assert out.columns == [*df.columns, "offset", "sequence_id", "offset_"]
    got = out.collect()
    assert len(got) == 7
    assert all((r["sequence_id"] is None and r["offset_"] is None) == (not r["length"] or r["length"] < 0) for r in got)
    real = [r for r in got if r["sequence_id"] is not None]
    assert filled(*zip(*((r["sequence_id"], r["offset_"], r["length"]) for r in real), strict=True), 10) == 3
    assert vector_packing.pack(rows("length int, text string", []), vector_packing.Capacity(10, 10, 100)).collect() == []
    with pytest.raises(ValueError, match="exceeds"):
        vector_packing.pack(df, vector_packing.Capacity(9, 10, 100))
    with pytest.raises(ValueError, match="rule"):
        vector_packing.plan([1], [1], vector_packing.Capacity(9, 10, 100, rule="x"))


def test_cutting_odd_rows(spark, rows):
    long = "word " * 5000
    df = rows("doc_id long, text string", [(1, None), (1, ""), (None, "a b"), (2, long), (2, long)])
    got = [(r["id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in vector_packing.cut(df, FILE, 2048, "doc_id").collect()]
    zero = np.array([0], "<u4").tobytes()
    assert sorted((i, p, n) for i, p, _, n, b in got if i == 1) == [(1, 0, 1)] * 2 and all(b == zero for i, *_, b in got if i == 1)
    ids = library_ids([long])[0] + [0]
    parts = [np.array(ids[s : s + 2048], "<u4").tobytes() for s in range(0, len(ids), 2048)]
    assert sorted(b for i, *_, b in got if i == 2) == sorted(parts * 2)
    assert [n for i, _, _, n, _ in got if i is None] == [3]
    assert vector_packing.cut(rows("doc_id long, text string", []), FILE, 2048, "doc_id").collect() == []
