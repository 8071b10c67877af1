"""SimHash, embeddings, containment, repeats and components against brute force."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from shopgrain.llm import decontamination, embedding_dedup, queries, simhash, suffix_dedup
from shopgrain.llm.components import components


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    links = {
        "chain": [(i, i + 1) for i in range(0, 60)], "star": [(90, i) for i in range(80)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "none": [],
    }[kind]
    rng.shuffle(links)
    df = spark.createDataFrame([*links, *links[:3], (7, None)], "a long, b long")
    want = roots({n for x in links for n in x}, links)
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {n: r for n, r in want.items() if n in got}
    assert all(n in got for x in links for n in x if x[0] != x[1])


def plain_fingerprint(text, width=4):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w.decode() for w in low.encode().split()]
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_query(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in queries.op6_simhash(spark, sf_dir).collect()}
    fps = {d: plain_fingerprint(t) for d, t, _ in texts}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = roots(ids, links)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in got.items()} == {
        d: (f"{fps[d]:016x}", want[d]) for d in ids
    }


def test_anchors_join_all_close_pairs_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 40)
    rng, fps = random.Random(5), set()
    for centre in [rng.getrandbits(64) for _ in range(12)]:
        for _ in range(60):
            x = centre
            for _ in range(rng.randrange(7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    links = [(signed[a], signed[b]) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    df = spark.createDataFrame([(f,) for f in signed.values()], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.close_pairs(df)).collect()}
    assert {f: got.get(f, f) for f in signed.values()} == roots(signed.values(), links)


def test_simhash_edge_rows(rows):
    long = "wort und " * 40_000
    data = [(5, None), (4, ""), (None, " \t"), (7, "a b"), (7, "a b"), (6, "A  b"), (1, long), (2, long), (None, "x y z w v")]
    table = rows("doc_id long, text string", data)
    got = [(r["id"] or 0, r["component_id"]) for r in simhash.near_duplicates(table, 4).collect()]
    assert len(got) == len(data) and {x for x in got if x[0] in (4, 5)} == {(4, 4), (5, 4)}
    assert {c for i, c in got if i in (6, 7)} == {6} and {c for i, c in got if i in (1, 2)} == {1}
    kept = simhash.keep_one(table, 4)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in kept.collect()) == [(0, 9), (1, len(long)), (4, 0), (6, 4)]
    repeated = simhash.keep_one(table.where("doc_id = 7"), 4).collect()
    assert len(repeated) == 1
    assert simhash.keep_one(table.limit(0), 4).count() == 0


def test_embeddings_recall_and_counts(spark, sf_dir):
    t = pq.read_table(os.path.join(sf_dir, "embeddings.parquet"))
    x = np.array(t["embedding"].to_pylist(), np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels, ids = np.array(t["label"].to_pylist()), np.array(t["vec_id"].to_pylist())
    near = (x @ x.T >= 0.93) & (labels[:, None] == labels) & ~np.eye(len(x), dtype=bool)
    got = {r["vec_id"]: r for r in queries.op5_embeddings(spark, sf_dir).collect()}
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.999 * near.sum()
    if found.sum() == near.sum():
        want = roots(ids.tolist(), [(int(ids[a]), int(ids[b])) for a, b in np.argwhere(near)])
        assert {i: r["component_id"] for i, r in got.items()} == want


def test_embeddings_in_tiles_with_odd_rows(rows, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(4, 24))
    vectors = [(centre[i % 4] + 0.12 * rng.normal(size=24)).tolist() for i in range(160)]
    vectors += [vectors[0], vectors[0], [2 * v for v in vectors[1]]]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None, *vectors[0][1:]], [float("inf"), *vectors[0][1:]], [1.0, 2.0]]
    data = [(i, v, i % 2) for i, v in enumerate(vectors)] + [(1000 + i, v, 0) for i, v in enumerate(odd)]
    data += [(2000, vectors[0], None), (3000, vectors[5], 1), (3000, vectors[5], 1)]
    table = rows("vec_id long, embedding array<double>, label int", data)
    got = embedding_dedup.near_duplicates(table).collect()
    assert len(got) == len(data)
    usable = [(i, np.array(v), l) for i, v, l in data if i < 1000 or i == 3000]
    unit = np.array([v / np.linalg.norm(v) for _, v, _ in usable])
    label = np.array([l for *_, l in usable])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(usable), dtype=bool)
    want = Counter((i, int(n)) for (i, *_), n in zip(usable, near.sum(1), strict=True))
    assert Counter((r["id"], r["n_links"]) for r in got if r["id"] < 1000 or r["id"] == 3000) == want
    assert all(r["n_links"] == 0 and r["component_id"] == r["id"] for r in got if 1000 <= r["id"] <= 2000)
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def plain_containment(docs, items, share=0.8):
    out = []
    for d, t in docs:
        own = decontamination.shingles(t or "")
        for i, q in items:
            s = decontamination.shingles(q or "")
            if s and len(s & own) >= share * len(s) - 1e-9:
                out.append((d, i, len(s), len(s & own)))
    return Counter(out)


def test_containment_edge_rows_and_passes(rows, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 9, 30, 64, 65])))) for i in range(60)]
    items += [(90, None), (91, ""), (92, "..."), (93, items[0][1].upper()), (93, items[0][1].upper()), (None, "one two")]
    docs = []
    for i in range(150):
        q = rng.choice(items)[1] or ""
        words = q.split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            if words:
                words[rng.randrange(len(words))] = word()
        docs.append((i, " ".join([word() for _ in range(rng.choice([0, 3, 400]))] + words + [word()] * rng.choice([0, 4]))))
    docs += [(200, None), (201, ""), (7, docs[7][1]), (None, docs[8][1]), (202, "One, TWO!"), (203, " ".join(word() for _ in range(60_000)))]
    d, i = rows("doc_id long, text string", docs), rows("item_id long, text string", items)
    want = plain_containment(docs, items)
    assert len(want) > 50
    for passes in (20_000, 9):
        got = decontamination.contained(d, i, pass_items=passes)
        assert Counter((r["id"], r["item"], r["n_shingles"], r["n_shared"]) for r in got.collect()) == want
    kept = decontamination.without(d, i, pass_items=9)
    assert kept.columns == d.columns
    bad = {t for t in docs if any(plain_containment([t], items))}
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(t for t in docs if t not in bad)
    assert decontamination.contained(d.limit(0), i).count() == 0 and decontamination.without(d, i.limit(0)).count() == len(docs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab é.\nZ")), max_size=60), min_size=1, max_size=5))
def test_shingle_hashes_stand_for_shingles(texts):
    hashes, doc = decontamination.shingle_hashes(texts)
    for i, t in enumerate(texts):
        assert len(set(hashes[doc == i].tolist())) == len(decontamination.shingles(t))
    alone = [set(decontamination.shingle_hashes([t])[0].tolist()) for t in texts]
    assert all(set(hashes[doc == i].tolist()) == a for i, a in enumerate(alone))


def plain_repeats(docs, depth, keep):
    counts, first = Counter(), {}
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is not None, docs[k][0] or 0))
    for k in order:
        raw = (docs[k][1] or "").encode()
        for j in range(len(raw) - depth + 1):
            counts[raw[j : j + depth]] += 1
            first.setdefault(raw[j : j + depth], (k, j))
    out = []
    for k, (d, t) in enumerate(docs):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for j in range(len(raw) - depth + 1):
            w = raw[j : j + depth]
            if counts[w] > 1 and (keep == "none" or first[w] != (k, j)):
                gone[j : j + depth] = True
        runs = int((np.diff(np.concatenate(([0], gone)).astype(int)) == 1).sum())
        out.append((d, len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def found_repeats(df, **options):
    return Counter(
        (r["id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in suffix_dedup.remove_repeats(df, **options).collect()
    )


@pytest.mark.parametrize("crowd, keep", [(1 << 12, "none"), (1, "none"), (1 << 12, "first"), (1, "first")])
def test_repeats_with_odd_rows(rows, monkeypatch, crowd, keep):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 256)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcd é") for _ in range(n))
    passages = [text(n) for n in (30, 45, 60, 90, 300)]
    docs = [(i, text(rng.randrange(80)) + rng.choice(passages) + text(rng.randrange(60)) + rng.choice(passages)) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "x" * 400), (103, "xy" * 300), (104, docs[3][1]), (None, docs[4][1] + "tail"), (105, text(9_000))]
    assert found_repeats(rows("doc_id long, text string", docs), depth=48, keep=keep) == plain_repeats(docs, 48, keep)


def test_repeats_query(spark, sf_dir, texts):
    got = queries.op4_suffixes(spark, sf_dir).collect()
    want = plain_repeats([(d, t) for d, t, _ in texts], 200, "none")
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_repeats_of_nothing(rows):
    assert suffix_dedup.remove_repeats(rows("doc_id long, text string", [])).count() == 0


def test_suffix_order_is_that_of_the_bytes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 600).astype(np.uint8)
    starts = np.arange(600 - 50)
    ranks = suffix_dedup.suffix_classes(data, starts, 50)
    raw = data.tobytes()
    words = [raw[s : s + 50] for s in starts]
    order = {w: i for i, w in enumerate(sorted(set(words)))}
    assert ranks.tolist() == [order[w] for w in words]
