"""Vectors, factors and recommendation against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.operators import factors, recommend, vectors


def table(spark, matrix, name="item_id", extra=()):
    rows = [(i, [float(x) for x in v], *[e[i] for _, _, e in extra]) for i, v in enumerate(matrix)]
    schema = f"{name} bigint, vector array<double>" + "".join(f", {n} {t}" for n, t, _ in extra)
    return spark.createDataFrame(rows, schema)


def unit(m):
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    return rng.standard_normal((300, 16)), rng.standard_normal((12, 16))


def ranked(scores, k):
    return [sorted(range(len(s)), key=lambda i: (-round(s[i], 6), i))[:k] for s in scores]


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["item_id"])
    return [out[q] for q in sorted(out)]


@pytest.mark.parametrize("block", [4096, 5])
@pytest.mark.parametrize("parts", [1, 16])
def test_vector_search_is_exact(spark, data, block, parts):
    items, queries = data
    got = vectors.vector_search(
        table(spark, queries, "query_id"), table(spark, items).repartition(parts), 7, block=block
    )
    assert found(got) == ranked(unit(queries) @ unit(items).T, 7)


@pytest.mark.parametrize("pairs", [1 << 20, 60])
def test_vector_search_without_k_ranks_every_pair(spark, data, monkeypatch, pairs):
    monkeypatch.setattr(vectors, "PAIRS", pairs)
    monkeypatch.setattr(vectors, "SLICE", 10)
    items, queries = data
    got = vectors.vector_search(table(spark, queries, "query_id"), table(spark, items), None, metric="dot", block=5)
    dots = queries @ items.T
    assert found(got) == ranked(dots, 300)
    rows = got.collect()
    assert sorted((r["query_id"], r["rank"]) for r in rows) == [(q, n) for q in range(12) for n in range(1, 301)]
    assert [r["score"] for r in rows] == pytest.approx([dots[r["query_id"], r["item_id"]] for r in rows], abs=6e-5)


def test_vector_search_without_k_keeps_conditions_and_nulls(spark, data):
    items, queries = data
    cats = [f"c{i % 3}" for i in range(300)]
    hidden = [[0] if i % 4 == 0 else None for i in range(300)]
    t = table(spark, items, extra=[("category", "string", cats), ("hidden_from", "array<bigint>", hidden)])
    q = table(spark, queries[:3], "query_id", extra=[("category", "string", ["c1", "missing", None])])
    got = found(vectors.vector_search(q, t, None, other_category=None))
    full = unit(queries[:3]) @ unit(items).T
    full[0, [i for i in range(300) if i % 3 != 1 or i % 4 == 0]] = -np.inf
    assert got[0] == [i for i in ranked(full, 300)[0] if full[0, i] > -np.inf] and got[1:] == ranked(full, 300)[1:]
    # The score of a null vector is null and comes last; a query without an id is a query.
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (0, None), (3, [2.0, 0.0])], "item_id bigint, vector array<double>")
    asked = spark.createDataFrame([("a", [1.0, 1.0]), (None, [-1.0, 0.0])], "query_id string, vector array<double>")
    got = vectors.vector_search(asked, rows, None, metric="dot").collect()
    want = [("", 1, -1.0, 1), ("", 3, -2.0, 2), ("a", 3, 2.0, 1), ("a", 1, 1.0, 2)] + [(q, i, None, 3 + i // 2) for q in ("", "a") for i in (0, 2)]
    assert sorted(((r[0] or "", r[1], r[2], r[3]) for r in got), key=str) == sorted(want, key=str)
    empty = asked.where("query_id = 'z'")
    assert vectors.vector_search(empty, rows, None).collect() == []


def test_every_query_meets_every_item(spark, sf_dir):
    from shopgrain.plans.all_queries import ORACLE, QUERIES

    items = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = QUERIES["query_x_item_scores"](spark, sf_dir)
    assert rows.count() == items.count() * items.select("label").distinct().count()
    assert "QUALIFY" not in ORACLE["query_x_item_scores"]


def test_vector_search_over_a_grid_of_cells(spark, data, monkeypatch):
    monkeypatch.setattr(vectors, "ITEM_BLOCK", 37)
    monkeypatch.setattr(vectors, "SLICE", 10)
    items, queries = data
    got = vectors.vector_search(table(spark, queries, "query_id"), table(spark, items), 7, block=5)
    assert found(got) == ranked(unit(queries) @ unit(items).T, 7)
    ends = vectors.similarity_range(table(spark, queries, "query_id"), table(spark, items), block=5)
    dots = queries @ items.T
    rows = sorted((r["query_id"], r["low"], r["high"]) for r in ends.collect())
    assert [r[0] for r in rows] == list(range(12))
    assert [r[1] for r in rows] == pytest.approx(dots.min(axis=1)) and [r[2] for r in rows] == pytest.approx(dots.max(axis=1))


def test_cells_of_several_blocks_and_tasks_meet(spark, data, monkeypatch):
    """Without merged partitions: both sides of a cell must be dealt to the same task."""
    monkeypatch.setattr(vectors, "ITEM_BLOCK", 37)
    items, queries = data
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        asked, rows = table(spark, queries, "query_id"), table(spark, items)
        assert found(vectors.vector_search(asked, rows, 7)) == ranked(unit(queries) @ unit(items).T, 7)
        dots = queries @ items.T
        ends = sorted((r["query_id"], r["low"], r["high"]) for r in vectors.similarity_range(asked, rows).collect())
        assert [r[1] for r in ends] == pytest.approx(dots.min(axis=1)) and [r[2] for r in ends] == pytest.approx(dots.max(axis=1))
        # Fewer queries than columns of the grid: some cells hold items only.
        few = vectors.vector_search(table(spark, queries[:2], "query_id"), rows, 7, block=1)
        assert found(few) == ranked(unit(queries[:2]) @ unit(items).T, 7)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_queries_stay_in_spark():
    import inspect

    assert ".collect()" not in inspect.getsource(vectors)


def test_vector_search_equal_scores_go_by_id(spark):
    items = table(spark, [[1, 0]] * 9 + [[0, 1]]).repartition(5)
    got = vectors.vector_search(table(spark, [[2, 0]], "query_id"), items, 4)
    assert found(got) == [[0, 1, 2, 3]]


def test_vector_search_with_bonus_category_and_hidden_items(spark, data):
    items, queries = data
    cats = [f"c{i % 3}" for i in range(300)]
    bonus = [i / 300 for i in range(300)]
    hidden = [[q for q in range(12) if (i + q) % 4 == 0] for i in range(300)]
    t = table(spark, items, extra=[
        ("category", "string", cats), ("bonus", "double", bonus), ("hidden_from", "array<bigint>", hidden)
    ])
    asked = [None if q % 2 else f"c{q % 3}" for q in range(12)]
    q = table(spark, queries, "query_id", extra=[("category", "string", asked)])
    got = vectors.vector_search(q, t, 6, sim_weight=0.6, other_category=0.1)
    scores = 0.6 * (unit(queries) @ unit(items).T) + np.array(bonus)
    for a in range(12):
        for i in range(300):
            if asked[a] is not None and cats[i] != asked[a]:
                scores[a, i] *= 0.1
            if a in hidden[i]:
                scores[a, i] = -np.inf
    assert found(got) == ranked(scores, 6)


def test_category_filter_falls_back_to_all(spark, data):
    items, queries = data
    cats = [f"c{i % 3}" for i in range(300)]
    t = table(spark, items, extra=[("category", "string", cats)]).repartition(8)
    q = table(spark, queries[:2], "query_id", extra=[("category", "string", ["c1", "missing"])])
    got = found(vectors.vector_search(q, t, 5, other_category=None))
    full = unit(queries[:2]) @ unit(items).T
    only = np.where(np.array(cats) == "c1", full[0], -np.inf)
    assert got == [ranked([only], 5)[0], ranked([full[1]], 5)[0]]


def test_no_queries_gives_no_rows(spark, data):
    empty = table(spark, data[1], "query_id").where("query_id < 0")
    assert vectors.vector_search(empty, table(spark, data[0]), 3).collect() == []


def test_approximate_search_finds_most_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((10, 16)) * 3
    items = np.vstack([c + rng.standard_normal((60, 16)) for c in centres])
    queries = centres + 0.3 * rng.standard_normal((10, 16))
    exact = ranked(unit(queries) @ unit(items).T, 5)
    got = vectors.approx_vector_search(table(spark, queries, "query_id"), table(spark, items), 5, dims=16)
    recall = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found(got), exact)])
    assert recall >= 0.8


def test_mean_vectors(spark):
    members = spark.createDataFrame([("g", 0, 2), ("g", 1, 1)], "g string, item_id bigint, n bigint")
    got = vectors.mean_vectors(members, table(spark, [[3.0, 0.0], [0.0, 3.0]]), "g").first()
    assert got["vector"] == [2.0, 1.0]


def test_truncated_svd_against_numpy(spark):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((40, 6)) @ rng.standard_normal((6, 25)) * (rng.random((40, 25)) < 0.9)
    rows = [(i, j, float(m[i, j])) for i in range(40) for j in range(25) if m[i, j]]
    entries = spark.createDataFrame(rows, "r bigint, c bigint, v double")
    svd = factors.truncated_svd(entries, "r", "c", "v", rank=4, oversample=3, tolerance=1e-6)
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    assert svd.singular_values == pytest.approx(s[:4].tolist(), rel=1e-4)
    left = {r["r"]: r["vector"] for r in svd.rows.collect()}
    right = {r["c"]: r["vector"] for r in svd.cols.collect()}
    approx = np.array([left[i] for i in range(40)]) @ np.array([right[j] for j in range(25)]).T
    best = (u[:, :4] * s[:4]) @ vt[:4]
    assert np.linalg.norm(approx - best) < 0.01 * np.linalg.norm(best)
    x = np.array([left[i] for i in range(40)])
    assert svd.explained_variance == pytest.approx((x.var(axis=0) / m.var(axis=0).sum()).tolist(), rel=1e-6)


def test_svd_drops_directions_without_weight(spark):
    entries = spark.createDataFrame([(0, 0, 3.0), (1, 1, 4.0)], "r bigint, c bigint, v double")
    svd = factors.truncated_svd(entries, "r", "c", "v", rank=10)
    assert svd.singular_values == pytest.approx([4.0, 3.0])


@pytest.mark.parametrize("rows", [[], [(0, 0, 0.0), (1, 2, 0.0)], [(None, 0, 1.0), (0, None, 1.0), (0, 0, None)]])
def test_svd_of_a_matrix_without_weight(spark, rows):
    svd = factors.truncated_svd(spark.createDataFrame(rows, "r bigint, c bigint, v double"), "r", "c", "v", rank=3)
    assert svd.singular_values == [] and svd.explained_variance == []
    assert all(r["vector"] == [] for r in svd.rows.collect())
    assert svd.cols.columns == ["c", "vector"]


@pytest.mark.parametrize("cell_bytes", [64 << 20, 40 * 8 * 3])
def test_cells_keep_every_entry_of_hot_rows_and_columns(spark, monkeypatch, cell_bytes):
    """One row and one column hold most entries; cells stay bounded and products are those of the whole matrix."""
    monkeypatch.setattr(factors, "CELL_BYTES", cell_bytes)
    rng = np.random.default_rng(3)
    m = rng.standard_normal((30, 50)) * (rng.random((30, 50)) < 0.03)
    m[4], m[:, 7] = rng.standard_normal(50), rng.standard_normal(30)
    rows = [(f"r{i}", j, float(m[i, j])) for i in range(30) for j in range(50) if m[i, j]]
    entries = spark.createDataFrame(rows, "row string, col bigint, value double")
    cells = factors.pack_cells(entries, 3)
    sizes = [len(r["value"]) // 8 for r in cells.table.collect()]
    assert sum(sizes) == len(rows)
    if cell_bytes < 64 << 20:
        assert max(sizes) <= 2 * cell_bytes // 24 and len(sizes) > 4
    x = rng.standard_normal((50, 3))
    dense = spark.createDataFrame([(j, *map(float, x[j])) for j in range(50)], "col bigint, d0 double, d1 double, d2 double")
    small = rng.standard_normal((3, 2))
    got, names = factors._multiply(cells, "col", "row", dense, ["d0", "d1", "d2"], small)
    want = m @ x @ small
    found = {r["row"]: [r[n] for n in names] for r in got.collect()}
    assert sorted(found) == sorted({r for r, _, _ in rows})
    for name, values in found.items():
        assert values == pytest.approx(want[int(name[1:])].tolist())
    s = np.linalg.svd(m, compute_uv=False)
    svd = factors.truncated_svd(entries, "row", "col", "value", rank=2, tolerance=1e-4)
    assert svd.singular_values == pytest.approx(s[:2].tolist(), rel=1e-3)


@pytest.fixture(scope="module")
def shop(spark):
    rng = np.random.default_rng(5)
    n = 40
    terms = ["red", "blue", "ring", "bolt", "gear"]
    weights = []
    for i in range(n):
        for t in rng.choice(len(terms), size=2, replace=False):
            weights.append((i, terms[t], float(rng.random())))
    quality = rng.random(n)
    items = [(i, f"c{i % 3}", float(quality[i])) for i in range(n)]
    return (
        spark.createDataFrame(weights, "product_idx bigint, term string, weight double"), weights,
        spark.createDataFrame(items, "product_idx bigint, category string, quality_score double"), items,
    )


def test_similar_items_against_all_pairs(spark, shop):
    weights, wrows, items, irows = shop
    anchors = spark.createDataFrame([(0,), (17,), (999,)], "query_id bigint")
    got = recommend.similar_items(anchors, weights, items, 30)
    vec = {}
    for i, t, w in wrows:
        vec.setdefault(i, {})[t] = w
    for a in (0, 17, 999):
        scores = {}
        for i, _, q in irows:
            if i == a:
                continue
            if a == 999:
                scores[i] = q
            else:
                scores[i] = 0.45 * sum(w * vec[i].get(t, 0) for t, w in vec[a].items()) + 0.25 * q
        want = sorted(scores, key=lambda i: (-round(scores[i], 6), i))[:30]
        rows = got.where(F.col("query_id") == a).orderBy("rank").collect()
        assert [r["product_idx"] for r in rows] == want


def test_recommend_users_against_numpy(spark):
    rng = np.random.default_rng(9)
    scores = (rng.random((15, 12)) < 0.4) * rng.integers(1, 6, (15, 12))
    scores[:, 0] = 0
    scores[0, 1] = 5
    rows = [(u, i, float(scores[u, i])) for u in range(15) for i in range(12) if scores[u, i]]
    inter = spark.createDataFrame(rows, "user_id bigint, item_id bigint, score double")
    quality = rng.random(12)
    qt = spark.createDataFrame([(i, float(q)) for i, q in enumerate(quality)], "item_id bigint, quality_score double")
    model = recommend.collaborative(inter, rank=3, tolerance=1e-3)
    users = spark.createDataFrame([(0,), (3,), (77,)], "user_id bigint")
    got = recommend.recommend_users(users, model, qt, inter, 4)
    uf = {r["user_id"]: np.array(r["vector"]) for r in model.rows.collect()}
    itf = {r["item_id"]: np.array(r["vector"]) for r in model.cols.collect()}
    want = []
    for u in (0, 3, 77):
        if u in uf:
            collab = np.array([uf[u] @ itf[i] if i in itf else 0.0 for i in range(12)])
            collab = (collab - collab.min()) / (collab.max() - collab.min())
            s = 0.30 * collab + 0.25 * quality
            s[scores[u] > 0] = -np.inf
        else:
            s = quality
        want.append([i for i in ranked([s], 4)[0] if s[i] > -np.inf])
    assert found(got) == want


def sent_whole(plan):
    """Whether rows of a Python function, whose size Spark does not know, are broadcast in a plan."""
    lines, inside = plan.splitlines(), None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-"))
        inside = None if inside is not None and depth <= inside else inside
        if inside is not None and "MapInArrow" in line:
            return True
        if inside is None and "BroadcastExchange" in line:
            inside = depth
    return False


@pytest.mark.parametrize("query", ["recommend_user", "user_x_item_scores"])
def test_dense_rows_of_factors_are_not_broadcast(spark, sf_dir, monkeypatch, query):
    """At 60 times sf0.1 they are 850 MB, which the driver would have to hold."""
    from shopgrain.plans.all_queries import QUERIES

    seen = []
    planned = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString())
    for module in (recommend, vectors):
        def recorded(df, *args, write=module.materialise, **options):
            planned(df)
            return write(df, *args, **options)

        monkeypatch.setattr(module, "materialise", recorded)

    def paired(queries, items, *args, meet=vectors._paired):
        planned(queries)
        planned(items)
        return meet(queries, items, *args)

    monkeypatch.setattr(vectors, "_paired", paired)
    monkeypatch.setattr(factors, "CELL_BYTES", 1 << 14)
    assert QUERIES[query](spark, sf_dir).count() > 0
    assert any("MapInArrow" in plan for plan in seen)
    assert not any(map(sent_whole, seen))


def test_user_vectors_keep_repeated_and_unknown_users(spark):
    rows = spark.createDataFrame([(i, [float(i)]) for i in range(5)], "user_id bigint, vector array<double>")
    users = spark.createDataFrame([(3,), (3,), (9,), (None,)], "user_id bigint")
    got = sorted(recommend.user_vectors(users, rows).collect())
    assert [tuple(r) for r in got] == [(3, [3.0]), (3, [3.0])]
    every = recommend.user_vectors(users, rows, "left").collect()
    assert sorted(((r[0] or 0, r[1]) for r in every), key=str) == [(0, None), (3, [3.0]), (3, [3.0]), (9, None)]


def test_cooccurrence_against_dense_product(spark):
    rng = np.random.default_rng(2)
    m = (rng.random((20, 8)) < 0.5) * rng.integers(1, 6, (20, 8))
    rows = [(u, i, float(m[u, i])) for u in range(20) for i in range(8) if m[u, i]]
    inter = spark.createDataFrame(rows, "user_id bigint, item_id bigint, score double")
    anchors = spark.createDataFrame([(0,), (5,)], "item_id bigint")
    got = recommend.cooccurrence(inter, anchors, 3)
    cos = unit(m.T.astype(float)) @ unit(m.T.astype(float)).T
    for a in (0, 5):
        cos[a, a] = -1
        rows = got.where(F.col("anchor") == a).orderBy("rank").collect()
        assert [r["item_id"] for r in rows] == ranked([cos[a]], 3)[0]


def test_compare_pairs_first_wins_ties(spark):
    a = spark.createDataFrame([("x", 1, 5.0), ("y", 2, 1.0)], "k string, product_idx int, score double")
    b = spark.createDataFrame([("x", 3, 5.0), ("y", 4, 2.0)], "k string, product_idx int, score double")
    got = {r["k"]: r["winner"] for r in recommend.compare_pairs(a, b, "k").collect()}
    assert got == {"x": 1, "y": 4}


def test_frequent_terms_are_exact_and_drop_rare_ones(spark):
    """Pruned by bucket loads; repeated and null keys count as one text."""
    from collections import Counter

    from shopgrain.operators import tfidf

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, 40) if x < 5000) for _ in range(300)]
    keys = [None if i % 50 == 7 else i // 2 if i < 40 else i for i in range(300)]
    df = spark.createDataFrame(list(zip(keys, texts)), "key bigint, text string")
    tf = {}
    for k, t in zip(keys, texts):
        w = t.split()
        tf.setdefault(k, Counter()).update(w + [" ".join(p) for p in zip(w, w[1:])])
    total = sum(tf.values(), Counter())
    best = sorted(total, key=lambda x: (-total[x], x))[:30]
    df_of = {x: sum(x in c for c in tf.values()) for x in best}
    weights, vocab = tfidf.tfidf(df, "key", "text", 30)
    assert {r["term"]: r["df"] for r in vocab.collect()} == df_of
    raw = {(k, x): (1 + np.log(c[x])) * (np.log(301 / (1 + df_of[x])) + 1) for k, c in tf.items() for x in best if x in c}
    norm = {k: sum(v * v for (q, _), v in raw.items() if q == k) ** 0.5 for k in tf}
    got = {(r["key"], r["term"]): r["weight"] for r in weights.collect()}
    assert got == pytest.approx({p: v / norm[p[0]] for p, v in raw.items()})
    tokens = df.select(tfidf.term_list(F.col("text")).alias("_t"))
    assert tfidf.frequent_terms(tokens, 30).count() < len(total) / 10


@pytest.mark.parametrize("cell_bytes", [64 << 20, 8 * 6 * 9 * 8])
def test_svd_of_few_columns_moves_no_dense_rows(spark, monkeypatch, cell_bytes):
    """With a bounded vocabulary only sums as large as the small side are shuffled; results are those of the general way."""
    monkeypatch.setattr(factors, "CELL_BYTES", cell_bytes)
    monkeypatch.setattr(factors, "PACKED", 4)
    rng = np.random.default_rng(7)
    m = rng.standard_normal((90, 9)) @ np.diag(2.0 ** -np.arange(9)) * (rng.random((90, 9)) < 0.7)
    rows = [(i, f"t{j}", float(m[i, j])) for i in range(90) for j in range(9) if m[i, j]]
    entries = spark.createDataFrame(rows, "r bigint, c string, v double")

    def never(*_):
        raise AssertionError("dense rows of the large side are sent")

    with monkeypatch.context() as only:
        only.setattr(factors, "_multiply", never)
        svd = factors.truncated_svd(entries, "r", "c", "v", rank=3, oversample=3, tolerance=1e-7)
        got = {r["r"]: r["vector"] for r in svd.rows.collect()}, {r["c"]: r["vector"] for r in svd.cols.collect()}
    assert svd.singular_values == pytest.approx(np.linalg.svd(m, compute_uv=False)[:3].tolist(), rel=1e-4)
    assert sorted(got[0]) == [i for i in range(90) if m[i].any()] and len(got[1]) == 9
    back = np.array([got[0].get(i, [0.0] * 3) for i in range(90)]) @ np.array([got[1][f"t{j}"] for j in range(9)]).T
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    assert np.abs(back - (u[:, :3] * s[:3]) @ vt[:3]).max() < 0.01
    monkeypatch.setattr(factors, "CELL_BYTES", 8)
    general = factors.truncated_svd(entries, "r", "c", "v", rank=3, oversample=3, tolerance=1e-7)
    assert general.singular_values == pytest.approx(svd.singular_values, rel=1e-4)
    assert general.explained_variance == pytest.approx(svd.explained_variance, rel=1e-3)


@pytest.mark.parametrize("cell_bytes", [64 << 20, 8 * 5 * 12])
def test_products_of_a_large_matrix_shuffle_no_dense_rows(spark, monkeypatch, cell_bytes):
    """However fine the grid is, a product writes each of its rows once and sends none; results are those of numpy."""
    monkeypatch.setattr(factors, "CELL_BYTES", cell_bytes)
    monkeypatch.setattr(factors, "BLOCK", 1)
    monkeypatch.setattr(factors, "PACKED", 3)
    monkeypatch.setattr(factors, "PIECE", 2)
    monkeypatch.setattr(factors, "TOGETHER", 2)
    rng = np.random.default_rng(11)
    m = rng.standard_normal((60, 5)) @ np.diag(3.0 ** -np.arange(5)) @ rng.standard_normal((5, 70)) * (rng.random((60, 70)) < 0.3)
    m[7], m[:, 9] = rng.standard_normal(70), rng.standard_normal(60)
    rows = [(f"u{i}", j - 35, float(m[i, j])) for i in range(60) for j in range(70) if m[i, j]] + [(None, 1, 2.0)]
    entries = spark.createDataFrame(rows, "row string, col bigint, value double")
    cells = factors.pack_cells(entries.dropna(), 5)
    assert cells.table.count() > 30
    x = rng.standard_normal((60, 5))
    dense = spark.createDataFrame([(f"u{i}", *map(float, x[i])) for i in range(60)], "row string, " + ", ".join(f"d{j} double" for j in range(5)))
    got, names = factors._multiply(cells, "row", "col", dense, [f"d{j}" for j in range(5)])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    found = {r["col"]: [r[n] for n in names] for r in got.collect()}
    assert sorted(found) == list(range(-35, 35))
    np.testing.assert_allclose([found[j - 35] for j in range(70)], m.T @ x, atol=1e-9)

    plans, write = [], factors._written_blocks
    monkeypatch.setattr(factors, "_written_blocks", lambda df, *a: plans.append(df) or write(df, *a))
    signs = factors._sign_blocks(cells, "col", 5, 42)
    plans.clear()
    out, gram, total, n = factors._product(cells, "col", "row", signs)
    assert len(plans) == 1 and "Exchange" not in plans[0]._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(out.path).agg(F.sum(F.length("x"))).first()[0] == 60 * 5 * 8
    ids = cells.sides["col"].table.select("id")
    of = {r["id"]: [r[f"d{j}"] for j in range(5)] for r in factors._signs(ids, "id", names, 42).collect()}
    y = m @ np.array([of[j - 35] for j in range(70)])
    np.testing.assert_allclose(gram, y.T @ y, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(total, y.sum(axis=0), atol=1e-9)
    assert n == 60

    monkeypatch.setattr(factors, "_strips", None)  # the way for a small side is not taken
    monkeypatch.setattr(factors, "CELL_BYTES", min(cell_bytes, 70 * 8 * 9))
    svd = factors.truncated_svd(entries, "row", "col", "value", rank=4, oversample=6, tolerance=1e-6)
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    assert svd.singular_values == pytest.approx(s[:4].tolist(), rel=1e-3)
    left = {r["row"]: r["vector"] for r in svd.rows.collect()}
    right = {r["col"]: r["vector"] for r in svd.cols.collect()}
    left = np.array([left[f"u{i}"] for i in range(60)])
    back = left @ np.array([right[j - 35] for j in range(70)]).T
    assert np.linalg.norm(back - (u[:, :4] * s[:4]) @ vt[:4]) < 0.05 * np.linalg.norm(back)
    assert svd.explained_variance == pytest.approx((left.var(axis=0) / m.var(axis=0).sum()).tolist(), rel=1e-6)
