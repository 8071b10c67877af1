"""A stored inverted-file index over vectors: cells around trained centres, one folder of files a cell.

Centres are trained on a bounded sample; every vector is then filed under its nearest centre, and the table is
published partitioned by cell. A search reads the files of the probed cells only and ranks all vectors in them
exactly. How many cells have to be probed for a recall is measured when the index is built: queries of the
kind that will be asked, or vectors of the sample, ask for their neighbours in the sample with and without
the index. Vectors without clusters need many probes; the recall is kept, not the saving.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.operators.checkpoints import materialise
from shopgrain.operators.ordering import topk
from shopgrain.operators.vectors import _matrix, _unit, cosine
from shopgrain.sources import files

# The helpers travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors that centres are trained on, at most; centres, at most; rounds of training.
SAMPLE, MOST_CELLS, ROUNDS = 50_000, 4096, 12
#: Vectors that ask for their neighbours when probes are measured, and how much is asked for beyond the recall.
ASKED, MARGIN = 200, 0.03


@dataclass
class VectorIndex:
    """Where the index is, its centres, and for each number of probed cells the recall measured in the sample."""

    path: str
    schema: T.StructType
    centres: np.ndarray
    recall: list[float]

    def probes(self, recall: float) -> int:
        """The fewest cells that reach a recall in the sample, with a margin; all cells if none does."""
        wanted = min(1.0, recall + MARGIN)
        return next((i + 1 for i, r in enumerate(self.recall) if r >= wanted), len(self.centres))


def _train(sample: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """Centres on the unit sphere, by Lloyd's rounds from vectors of the sample; an empty cell keeps its centre."""
    centres = sample[np.random.default_rng(seed).choice(len(sample), cells, replace=False)]
    for _ in range(ROUNDS):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        full = np.bincount(nearest, minlength=cells) > 0
        centres = np.where(full[:, None], _unit(sums), centres)
    return centres


def _measured(sample: np.ndarray, asked: np.ndarray, centres: np.ndarray, k: int) -> list[float]:
    """Share of the k nearest vectors of the sample that lie in the 1, 2, ... cells nearest to a query.

    A vector that equals the query does not count, as it would always be found.
    """
    cell = np.argmax(sample @ centres.T, axis=1)
    scores = asked @ sample.T
    scores[scores > 1 - 1e-9] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, cell[best], axis=1)
    return (np.cumsum(np.bincount(needed.ravel(), minlength=len(centres))) / needed.size).tolist()


def _drawn(df: DataFrame, key: str, n: int, limit: int, seed: int) -> np.ndarray:
    """Up to ``limit`` of the n vectors, those with the least hashes of their ids: the same ones in every run."""
    order = F.xxhash64(key, F.lit(seed))
    share = min(1.0, 2 * limit / max(n, 1))
    some = df.where(F.pmod(order, F.lit(1 << 20)) < math.ceil(share * (1 << 20))).orderBy(order).limit(limit)
    return _unit(np.array([r["vector"] for r in some.select("vector").collect()], dtype=float))


def build(
    items: DataFrame, path: str, k: int = 10, cells: int | None = None, asked: DataFrame | None = None, seed: int = 42
) -> VectorIndex:
    """Publish the index of ``items`` (item_id, vector and further columns) at ``path``.

    ``asked`` (query_id, vector) are queries of the kind that will be asked; without them, vectors of the
    sample take their place when probes are measured. Cells default to twice the square root of the number of vectors. Vectors that are null or zero have no
    direction and are left out, as no search can rank them.
    """
    items = items.where(F.exists("vector", lambda x: x != 0))
    n = items.count()
    schema = T.StructType([*items.schema.fields, T.StructField("cell", T.IntegerType())])
    if not n:
        files.publish(items.withColumn("cell", F.lit(0)), path, ["cell"])
        return VectorIndex(path, schema, np.zeros((0, 0)), [])
    sample = _drawn(items, "item_id", n, SAMPLE, seed)
    cells = min(cells or math.ceil(2 * math.sqrt(n)), MOST_CELLS, len(sample))
    centres = _train(sample, cells, seed)
    known = sample[:ASKED] if asked is None else _drawn(asked, "query_id", asked.count(), ASKED, seed)
    measured = _measured(sample, known, centres, k) if len(known) else []

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nearest = np.argmax(_matrix(batch.column("vector")) @ centres.T, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32())], [*batch.schema.names, "cell"])

    rows = items.mapInArrow(filed, schema)
    # A task holds all rows of its cells, or, of a cell with very many, one of the parts that it is dealt to.
    files.publish(rows.repartition("cell", F.pmod(F.xxhash64("item_id"), F.lit(-(-n // (cells * 100_000))))), path, ["cell"])
    return VectorIndex(path, schema, centres, measured)


def search(spark: SparkSession, index: VectorIndex, queries: DataFrame, k: int, recall: float = 0.9, digits: int = 4) -> DataFrame:
    """(query_id, item_id, score, rank): the k nearest by cosine in the cells that each query probes.

    Ids of queries and the cells they probe are joined with the filed vectors by cell; folders that no query
    probes are not read. Queries that are null or zero find nothing.
    """
    probes = index.probes(recall)
    stored = files.published(spark, index.path, index.schema)
    asked = queries.select("query_id", F.col("vector").alias("_q")).where(F.exists("_q", lambda x: x != 0))
    kind = asked.schema["query_id"].dataType.simpleString()
    centres = index.centres
    if not len(centres):
        return stored.crossJoin(asked.limit(0)).select("query_id", "item_id", F.lit(0.0).alias("score"), F.lit(0).alias("rank")).limit(0)

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.argsort(-(_unit(_matrix(batch.column(1))) @ centres.T), axis=1, kind="stable")[:, :probes]
                ends = np.arange(batch.num_rows + 1, dtype=np.int32) * near.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(near.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["query_id", "_q", "cells"])

    vector = asked.schema["_q"].dataType.simpleString()
    wanted = asked.mapInArrow(probed, f"query_id {kind}, _q {vector}, cells array<int>").select("query_id", "_q", F.explode("cells").alias("cell"))
    wanted = materialise(wanted, "probes")
    # At most MOST_CELLS numbers: a filter on the partition column, so no other folder is listed or read.
    cells = [r["cell"] for r in wanted.select("cell").distinct().collect()]
    pairs = stored.where(F.col("cell").isin(cells)).join(wanted, "cell").select(
        "query_id", "item_id", cosine(F.col("_q"), F.col("vector")).alias("raw")
    )
    best = topk(pairs, ["query_id"], [F.desc(F.round("raw", 6)), F.asc("item_id")], k)
    return best.select("query_id", "item_id", F.round("raw", digits).alias("score"), "rank")
