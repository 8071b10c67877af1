"""Exact and approximate nearest neighbours over a table of vectors.

Items and queries meet in cells, in Spark: items are dealt over the rows of a grid and queries
over its columns, by hash. A cell holds a bounded block of each, whose scores are matrix products;
it keeps k rows per query, so no pair table exists and only k rows per query and cell go on. Both
tables are read once, whatever their sizes, and no query passes through the driver. Without k all
pairs are the result; cells are smaller then, and the ranks come from one order over all tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.operators.checkpoints import materialise
from shopgrain.operators.ordering import ranked_within, topk

#: Queries and items of a cell, and items scored at once; pairs of a cell that returns them all.
BLOCK, ITEM_BLOCK, SLICE, PAIRS = 4096, 16_384, 2048, 1 << 20

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}

# The helpers travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Array column as an (n, d) matrix; a null array is a row of NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=float)
    if column.null_count:
        some = flat.reshape(len(column) - column.null_count, -1) if len(flat) else np.zeros((0, 0))
        out = np.full((len(column), some.shape[1]), np.nan)
        out[column.is_valid().to_numpy(zero_copy_only=False)] = some
        return out
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores at 6 digits, equal ones by id; -inf and NaN never."""
    key = np.round(scores, 6)
    key = np.where(np.isnan(key), -np.inf, key)
    if len(key) > k:
        floor = np.partition(key, len(key) - k)[len(key) - k]
        spots = np.flatnonzero((key >= floor) & (key > -np.inf))
    else:
        spots = np.flatnonzero(key > -np.inf)
    order = np.lexsort((ids[spots], -key[spots]))
    return spots[order[:k]]


def _paired(queries: DataFrame, items: DataFrame, task, schema: str, block: int, pairs: int | None = None) -> DataFrame:
    """``task(items, queries)`` over all cells, of about ``pairs`` pairs at most; each item meets each query in one cell.

    Sizes are counted first. An item goes to as many cells as there are blocks of queries, a query to as
    many as there are blocks of items; both ids spread evenly by hash.
    """
    asked = queries.count()
    item_block = min(ITEM_BLOCK, max(pairs // max(min(asked, block), 1), 1)) if pairs else ITEM_BLOCK
    across, down = -(-asked // block), -(-items.count() // item_block)
    if not across or not down:
        return items.sparkSession.createDataFrame([], schema)
    # Places have one type on both sides: a long and an int of the same value hash to different tasks.
    row = F.pmod(F.xxhash64("item_id"), F.lit(down)).cast("int")
    col = F.pmod(F.xxhash64("query_id"), F.lit(across)).cast("int")
    left = items.withColumns({"_row": row, "_col": F.explode(F.sequence(F.lit(0), F.lit(across - 1)))})
    right = queries.withColumns({"_col": col, "_row": F.explode(F.sequence(F.lit(0), F.lit(down - 1)))})
    return left.groupBy("_row", "_col").cogroup(right.groupBy("_row", "_col")).applyInArrow(task, schema)


def _scorer(asked: pa.Table, columns: Sequence[str], k: int | None, metric: str, sim_weight: float,
            other_category: float | None, query_type, item_type):
    """Function from an iterator of item batches to the k best rows per query, or to all rows."""
    qids = asked["query_id"].to_pylist()
    qvec = _matrix(asked["vector"])
    cats = asked["category"].to_pylist() if "category" in asked.column_names else None
    low = asked["low"].to_numpy() if "low" in asked.column_names else None
    high = asked["high"].to_numpy() if "high" in asked.column_names else None
    place = {q: i for i, q in enumerate(qids)}
    if metric == "cosine":
        qvec = _unit(qvec)

    def score(table: dict) -> np.ndarray:
        items = _matrix(table["vector"])
        if any(len(v) and v.null_count == len(v) for v in (asked["vector"], table["vector"])):
            sims = np.full((len(qvec), len(items)), np.nan)
        else:
            sims = qvec @ (_unit(items) if metric == "cosine" else items).T
        if low is not None:
            spread = (high - low)[:, None]
            safe = np.where(spread < 1e-8, 1.0, spread)
            sims = np.where(spread < 1e-8, 0.5, (sims - low[:, None]) / safe)
        out = sim_weight * sims
        if "bonus" in columns:
            out = out + np.asarray(table["bonus"].to_numpy(zero_copy_only=False), dtype=float)
        if "hidden_from" in columns:
            for j, users in enumerate(table["hidden_from"].to_pylist()):
                for user in users or ():
                    if user in place:
                        out[place[user], j] = -np.inf
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = {c: batch.column(c) for c in columns}
            ids = table["item_id"].to_numpy(zero_copy_only=False)
            scores = score(table)
            found = np.array(table["category"].to_pylist(), dtype=object) if cats is not None and "category" in columns else None
            for qi in range(len(qids)):
                lists = [(0, scores[qi])]
                if found is not None and cats[qi] is not None:
                    same = np.equal(found, cats[qi]).astype(bool)
                    if other_category is None:
                        lists.append((1, np.where(same, scores[qi], -np.inf)))
                    else:
                        lists = [(0, np.where(same, scores[qi], scores[qi] * other_category))]
                for tag, values in lists:
                    kept = best.get((qi, tag))
                    pool, pool_ids = values, ids
                    if kept is not None:
                        pool = np.concatenate([kept[0], values])
                        pool_ids = np.concatenate([kept[1], ids])
                    spots = _best(pool, pool_ids, k)
                    best[(qi, tag)] = (pool[spots], pool_ids[spots])
        q, t, i, s = [], [], [], []
        for (qi, tag), (values, kept_ids) in best.items():
            q += [qids[qi]] * len(values)
            t += [tag] * len(values)
            i += kept_ids.tolist()
            s += values.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, query_type), pa.array(t, pa.int32()), pa.array(i, item_type), pa.array(s, pa.float64())],
            names=names,
        )

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each pair but hidden ones; where one of the vectors is null, so is the score."""
        gone = pc.is_null(asked["vector"]).to_numpy()
        asked_ids = asked["query_id"].combine_chunks().cast(query_type)
        for batch in batches:
            none = gone[:, None] | batch.column("vector").is_null().to_numpy(zero_copy_only=False)
            scores = score({c: batch.column(c) for c in columns})
            tags = np.zeros(scores.shape, np.int32)
            if cats is not None and "category" in columns:
                found = np.array(batch.column("category").to_pylist(), dtype=object)
                for qi, cat in enumerate(cats):
                    same = np.equal(found, cat).astype(bool)
                    if cat is not None and other_category is None:
                        tags[qi] = same
                    elif cat is not None:
                        scores[qi] = np.where(same, scores[qi], scores[qi] * other_category)
            qi, ii = np.nonzero(scores != -np.inf)
            yield pa.RecordBatch.from_arrays(
                [
                    asked_ids.take(pa.array(qi)), pa.array(tags[qi, ii]), batch.column("item_id").take(pa.array(ii)).cast(item_type),
                    pa.array(scores[qi, ii], mask=none[qi, ii]),
                ],
                names=names,
            )

    names = ["query_id", "matched", "item_id", "raw"]
    return run if k is not None else run_all


def vector_search(
    queries: DataFrame, items: DataFrame, k: int | None, metric: str = "cosine",
    sim_weight: float = 1.0, other_category: float | None = 1.0, digits: int = 4,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, item_id, score, rank): the k best items per query, or all of them (``k`` None).

    queries: ``query_id, vector`` and optionally ``category`` and ``low, high`` (range
    that similarities are scaled by). items: ``item_id, vector`` and optionally
    ``category``, ``bonus`` (added to the weighted similarity) and ``hidden_from``
    (query ids the item must not be shown to).

    ``other_category`` multiplies the score of items outside the query's category;
    None restricts to the category, or to nothing when the category has no items.
    Filter ``items`` first for any other condition.
    """
    columns = items.columns
    query_kind = queries.schema["query_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    query_type = ARROW[query_kind]
    schema = f"query_id {query_kind}, matched int, item_id {item_kind}, raw double"

    def task(mine: pa.Table, asked: pa.Table) -> pa.Table:
        # A cell can lack one side where ids are few; it has no pairs.
        batches = mine.to_batches(max_chunksize=SLICE) if asked.num_rows else []
        item_type = mine.schema.field("item_id").type
        run = _scorer(asked, columns, k, metric, sim_weight, other_category, query_type, item_type)
        names = {"query_id": query_type, "matched": pa.int32(), "item_id": item_type, "raw": pa.float64()}
        return pa.Table.from_batches(list(run(batches)), pa.schema(names))

    out = _paired(queries, items, task, schema, block, PAIRS if k is None else None)
    order = [F.desc(F.round("raw", 6)), F.asc("item_id")]
    if k is None:
        if other_category is None and "category" in queries.columns and "category" in columns:
            out = materialise(out, "pairs")
            most = out.groupBy(F.col("query_id").alias("_q")).agg(F.max("matched").alias("_tag"))
            out = out.join(most, F.col("query_id").eqNullSafe(F.col("_q")) & (F.col("matched") == F.col("_tag")))
        ranked = ranked_within(out.select("query_id", "item_id", "raw"), "query_id", order)
        return ranked.select("query_id", "item_id", F.round("raw", digits).alias("score"), "rank")
    # k rows per query and tag first, so the last window sees at most 2k rows per query.
    best = topk(out, ["query_id", "matched"], order, k)
    tag = F.max("matched").over(Window.partitionBy("query_id"))
    return best.withColumn("_tag", tag).where("matched = _tag").select(
        "query_id", "item_id", F.round("raw", digits).alias("score"), "rank"
    )


def similarity_range(queries: DataFrame, items: DataFrame, block: int = BLOCK) -> DataFrame:
    """queries with ``low`` and ``high``: the smallest and largest dot product with any item."""
    kind = queries.schema["query_id"].dataType.simpleString()
    query_type = ARROW[kind]

    def task(mine: pa.Table, asked: pa.Table) -> pa.Table:
        qvec = _matrix(asked["vector"])
        low, high = np.full(len(qvec), np.inf), np.full(len(qvec), -np.inf)
        for batch in mine.to_batches(max_chunksize=SLICE) if asked.num_rows else []:
            sims = qvec @ _matrix(batch.column("vector")).T
            low, high = np.minimum(low, sims.min(axis=1, initial=np.inf)), np.maximum(high, sims.max(axis=1, initial=-np.inf))
        seen = np.isfinite(low)
        return pa.table({
            "query_id": asked["query_id"].cast(query_type).filter(pa.array(seen)),
            "low": low[seen], "high": high[seen],
        })

    rows = queries.select("query_id", "vector")
    out = _paired(rows, items.select("item_id", "vector"), task, f"query_id {kind}, low double, high double", block)
    ends = out.groupBy("query_id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return queries.join(ends, "query_id")


def cosine(a, b):
    """Cosine of two array columns, for pairs that are already joined."""
    def dot(x, y):
        return F.aggregate(
            F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
            F.lit(0.0), lambda s, v: s + v,
        )
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _signatures(df: DataFrame, key: str, tables: int, bits: int, dims: int, seed: int,
                probe: bool) -> DataFrame:
    """(key, vector, table, signature); probing adds the neighbours one bit away."""
    planes = np.random.default_rng(seed).standard_normal((dims, tables * bits))
    powers = 1 << np.arange(bits, dtype=np.int64)
    kind = df.schema[key].dataType.simpleString()
    vec = df.schema["vector"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            signs = (_matrix(batch.column(1)) @ planes > 0).reshape(-1, tables, bits)
            codes = signs @ powers
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes.tolist(), pa.list_(pa.int64()))],
                names=[key, "vector", "codes"],
            )

    coded = df.select(key, "vector").mapInArrow(task, f"{key} {kind}, vector {vec}, codes array<bigint>")
    rows = coded.select(key, "vector", F.posexplode("codes").alias("table", "signature"))
    if not probe:
        return rows
    near = F.concat(
        F.array("signature"), *[F.array(F.col("signature").bitwiseXOR(F.lit(1 << b))) for b in range(bits)]
    )
    return rows.select(key, "vector", "table", F.explode(near).alias("signature"))


def approx_vector_search(
    queries: DataFrame, items: DataFrame, k: int, dims: int,
    tables: int = 8, bits: int = 6, seed: int = 42, digits: int = 4,
) -> DataFrame:
    """Nearest neighbours among items that share a hash bucket, ranked by exact cosine.

    Random hyperplanes give each vector one signature per table. A query looks into
    its own bucket and those one bit away; every item found is ranked, none is capped.
    """
    q = _signatures(
        queries.select("query_id", "vector"), "query_id", tables, bits, dims, seed, probe=True
    ).withColumnRenamed("vector", "_q")
    q = materialise(q, "signatures")
    i = _signatures(items.select("item_id", "vector"), "item_id", tables, bits, dims, seed, probe=False)
    found = q.join(i, ["table", "signature"])
    scored = found.select("query_id", "item_id", cosine(F.col("_q"), F.col("vector")).alias("raw"))
    # The same pair met in several tables has the same score: keep one.
    pairs = scored.groupBy("query_id", "item_id").agg(F.max("raw").alias("raw"))
    best = topk(pairs, ["query_id"], [F.desc(F.round("raw", 6)), F.asc("item_id")], k)
    return best.select("query_id", "item_id", F.round("raw", digits).alias("score"), "rank")


def mean_vectors(memberships: DataFrame, vectors: DataFrame, group: str) -> DataFrame:
    """Mean vector per group from (group, item_id, n) and (item_id, vector).

    Counts come in pre-aggregated, and dimensions are averaged as separate keys, so a
    group with very many members still combines on the map side.
    """
    parts = memberships.join(vectors, "item_id").select(
        group, "n", F.posexplode("vector").alias("pos", "x")
    )
    dims = parts.groupBy(group, "pos").agg(
        (F.sum(F.col("x").cast("double") * F.col("n")) / F.sum("n")).alias("x")
    )
    # One entry per dimension: bounded by the vector length.
    packed = dims.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("p"))
    return packed.select(group, F.transform("p", lambda e: e["x"]).alias("vector"))
