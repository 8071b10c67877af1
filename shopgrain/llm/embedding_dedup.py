"""Near-duplicate vectors by Euclidean p-stable hashing, checked by exact cosine.

Vectors are normalised, so a cosine of at least ``least`` is a distance of at most sqrt(2 - 2 * least). Each
of several tables hashes a vector by the floors of random Gaussian projections of width ``WIDTH``; vectors of
one label that share a bucket in some table are compared by their cosine in double precision. The number
of projections grows with the logarithm of the largest label, so that buckets of unlike vectors stay
small; the number of tables follows from it and from ``MISS``, the chance that a pair exactly at the
threshold shares no bucket.

Equal vectors of a label are one class, hashed once; a class counts as many vectors as it has. A pair is counted
in the first table where it meets, which both vectors' buckets tell. Crowded buckets are dealt in tiles
to several tasks; a tile returns counts and a spanning forest, not its pairs.

Defined results: a vector that is null, empty or zero, holds null or non-finite components, or has a null
label links with nothing; vectors of different length don't link; repeated rows are vectors of their
own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.components import components
from shopgrain.operators.checkpoints import materialise

LEAST, MISS, WIDTH, SEED = 0.93, 0.0005, 2.0, 7
#: Unlike vectors that a bucket is expected to hold, vectors of a bucket compared in one task, most projections.
CROWD, TILE, MOST_PROJECTIONS = 64, 1024, 24


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one projection puts two vectors at a distance into the same cell."""
    r = width / distance
    tail = math.erfc(r / math.sqrt(2)) / 2
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(largest: int, least: float = LEAST, miss: float = MISS) -> tuple[int, int]:
    """Projections a table, and tables, for labels of up to ``largest`` vectors."""
    unlike = -math.log(collision(math.sqrt(2)))
    projections = min(MOST_PROJECTIONS, max(2, math.ceil(math.log(max(1, largest / CROWD)) / unlike)))
    near = collision(math.sqrt(2 - 2 * least)) ** projections
    return projections, math.ceil(math.log(miss) / math.log1p(-near))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows or vanishes."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _hasher(projections: int, tables: int):
    @F.arrow_udf("array<long>")
    def codes(vectors: pa.Array) -> pa.Array:
        lengths = np.diff(vectors.offsets.to_numpy())
        flat, start = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets[0].as_py()
        starts = np.cumsum(lengths) - lengths + start
        out = np.zeros((len(vectors), tables), np.int64)
        for d in np.unique(lengths):
            rng = np.random.default_rng([SEED, int(d)])
            planes, shift = rng.standard_normal((int(d), tables * projections)), rng.random(tables * projections) * WIDTH
            odd = rng.integers(1, 1 << 62, (projections, 1), np.int64) | 1
            rows = np.flatnonzero(lengths == d)
            for i in range(0, len(rows), 1024):
                at = rows[i : i + 1024]
                x = unit(flat[starts[at, None] + np.arange(d)])
                cells = np.floor((x @ planes + shift) / WIDTH).astype(np.int64).reshape(len(at), tables, projections)
                out[at] = (cells @ odd)[:, :, 0] + int(d)
        return pa.array(list(out), pa.list_(pa.int64()))

    return codes


def _compare(least: float):
    """Over rows sorted by bucket and tile: link counts, and the forest of links, of each run of equal keys."""
    key = ["label", "place", "code", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]).combine_chunks() if held is not None else now
            change = np.zeros(len(now) - 1, bool)
            for c in key:
                column = now[c].combine_chunks()
                change |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], np.flatnonzero(change) + 1))
            yield _links(now, bounds, least)
            held = now.slice(bounds[-1])
        if held is not None:
            yield _links(held, np.array([0, len(held)]), least)

    return compare


def _links(rows: pa.Table, bounds: np.ndarray, least: float) -> pa.RecordBatch:
    ids, size, own = (rows[c].to_numpy() for c in ("class", "n", "own"))
    place, cross = rows["place"].to_numpy(), rows["i"].to_numpy() != rows["j"].to_numpy()
    counts: dict[int, int] = {}
    forest: list[tuple[int, int]] = []
    for k in np.flatnonzero(np.diff(bounds) > 1):
        a, b = int(bounds[k]), int(bounds[k + 1])
        part = rows.slice(a, b - a)
        vectors, codes = (_matrix(part[c]) for c in ("vector", "codes"))
        if len({len(v) for v in vectors}) > 1:  # buckets of two lengths with one code
            continue
        x, codes = unit(np.stack(vectors)), np.stack(codes)
        p, q = np.nonzero(np.triu(x @ x.T >= least, 1))
        t = int(place[a])
        met = (codes[p, :t] == codes[q, :t]).any(1)
        if cross[a]:
            met |= own[a + p] == own[a + q]
        p, q = p[~met], q[~met]
        if not len(p):
            continue
        links = np.bincount(p, size[a + q], b - a) + np.bincount(q, size[a + p], b - a)
        for i in np.flatnonzero(links):
            counts[int(ids[a + i])] = counts.get(int(ids[a + i]), 0) + int(links[i])
        forest += [(int(ids[a + i]), int(ids[a + j])) for i, j in _spanning(p, q, b - a)]
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*counts, *(e[0] for e in forest)], pa.int64()),
            pa.array([*[None] * n, *(e[1] for e in forest)], pa.int64()),
            pa.array([*counts.values(), *[None] * len(forest)], pa.int64()),
        ],
        ["a", "b", "links"],
    )


def _matrix(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.asarray(v.values) for v in column]


def _spanning(p: np.ndarray, q: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Of links between n vectors those that connect two parts not connected yet."""
    part = np.arange(n)
    for i, j in zip(p.tolist(), q.tolist(), strict=True):
        while part[i] != i:
            part[i] = i = part[part[i]]
        while part[j] != j:
            part[j] = j = part[part[j]]
        if i != j:
            part[max(i, j)] = min(i, j)
            yield i, j


def near_duplicates(
    df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST
) -> DataFrame:
    """``id``, ``n_links`` (other vectors linked directly) and ``component_id`` (least id reachable) of every row."""
    rows = df.select(
        F.col(key).alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    # Two hashes of 64 bits stand for label and vector.
    rows = rows.withColumns(
        {"k": F.when(usable, F.xxhash64("label", "vector")), "l": F.when(usable, F.xxhash64("vector", "label"))}
    )
    classes = materialise(
        rows.where("k is not null").groupBy("k", "l")
        .agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("n"), F.min("id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    found = _search(classes, least, *shape(largest, least))
    links = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b")).toDF("class", "root")
    named = classes.select("k", "l", "class", "n", "least").join(links, "class", "left").join(roots, "class", "left")
    named = named.withColumn("root", F.coalesce("root", "class"))
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(component, "root").select(
        "k", "l", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    return rows.select("id", "k", "l").join(known, ["k", "l"], "left").select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )


def _search(classes: DataFrame, least: float, projections: int, tables: int) -> DataFrame:
    """Rows a, links: that many vectors linked to class a; rows a, b: links that connect whatever is linked."""
    hashed = classes.select("class", "n", "label", "vector", _hasher(projections, tables)("vector").alias("codes"))
    at = hashed.select("*", F.posexplode("codes").alias("place", "code"))
    bucket = ["label", "place", "code"]
    crowded = materialise(
        at.groupBy(bucket).count().where(F.col("count") > TILE)
        .select(*bucket, F.ceil(F.col("count") / TILE).cast("int").alias("parts")),
        "crowded",
    )
    parts = F.coalesce("parts", F.lit(1))
    dealt = (
        at.join(crowded, bucket, "left").withColumn("own", F.pmod(F.xxhash64("class"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")
    )
    tile = [*bucket, "i", "j"]
    return materialise(
        dealt.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(_compare(least), "a long, b long, links long"),
        "vector_links",
    )
