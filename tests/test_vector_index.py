"""The stored vector index: recall, pruning by cell, odd vectors."""

import numpy as np
import pytest
from test_search import found, ranked, table, unit

from shopgrain.operators import vector_index
from shopgrain.plans.all_queries import QUERIES
from shopgrain.sources import files


def recall(exact, got):
    return np.mean([len(set(a) & set(b)) / len(a) for a, b in zip(exact, got, strict=True)])


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16)) * 3
    items = np.vstack([c + rng.standard_normal((60, 16)) for c in centres])
    return items, centres + 0.3 * rng.standard_normal((40, 16))


def test_few_cells_of_clustered_vectors_are_read(spark, tmp_path, clustered):
    items, queries = clustered
    path = str(tmp_path / "index")
    index = vector_index.build(table(spark, items), path, k=5)
    probes = index.probes(0.9)
    assert probes <= 0.1 * len(index.centres)
    stored = files.published(spark, path)
    assert stored.count() == len(items) and stored.select("cell").distinct().count() <= len(index.centres)
    got = vector_index.search(spark, index, table(spark, queries, "query_id"), 5)
    exact = ranked(unit(queries) @ unit(items).T, 5)
    assert recall(exact, found(got)) >= 0.9
    # Candidates: vectors in the probed cells, as a share of all pairs.
    nearest = np.argmax(unit(items) @ index.centres.T, axis=1)
    probed = np.argsort(-(unit(queries) @ index.centres.T), axis=1)[:, :probes]
    assert np.mean([np.isin(nearest, p).mean() for p in probed]) < 0.1


def test_only_probed_folders_are_read(spark, tmp_path, clustered):
    items, queries = clustered
    index = vector_index.build(table(spark, items), str(tmp_path / "index"), k=5)
    got = vector_index.search(spark, index, table(spark, queries[:1], "query_id"), 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_all_cells_give_the_exact_result(spark, tmp_path):
    rng = np.random.default_rng(5)
    items, queries = rng.standard_normal((200, 8)), rng.standard_normal((6, 8))
    index = vector_index.build(table(spark, items), str(tmp_path / "index"), k=5, cells=7)
    index.recall = []
    got = vector_index.search(spark, index, table(spark, queries, "query_id"), 5)
    assert found(got) == ranked(unit(queries) @ unit(items).T, 5)


def test_odd_vectors(spark, tmp_path):
    items = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 0.0]), (5, [0.0, 1.0])], "item_id long, vector array<double>"
    )
    index = vector_index.build(items, str(tmp_path / "index"))
    asked = spark.createDataFrame([("a", [2.0, 0.0]), ("z", [0.0, 0.0]), ("n", None)], "query_id string, vector array<double>")
    got = vector_index.search(spark, index, asked, 2, recall=1.0).collect()
    assert [(r["query_id"], r["item_id"], r["score"]) for r in sorted(got)] == [("a", 1, 1.0), ("a", 4, 1.0)]
    none = vector_index.build(items.where("item_id > 9"), str(tmp_path / "none"))
    assert vector_index.search(spark, none, asked, 2).collect() == []


def test_recall_of_the_registered_query(spark, sf_dir):
    def lists(name):
        out = {}
        for r in QUERIES[name](spark, sf_dir).collect():
            out.setdefault(r["query_id"], set()).add(r["item_id"])
        return out

    exact, got = lists("vector_search"), lists("approx_vector_search")
    assert np.mean([len(exact[q] & got.get(q, set())) / len(exact[q]) for q in exact]) >= 0.9
