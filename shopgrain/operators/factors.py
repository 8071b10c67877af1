"""Truncated, uncentred SVD of a sparse table by randomised subspace iteration.

The ids of both sides are dealt into blocks by hash, and the entries are packed once into the cells of the grid of
blocks. A product deals the blocks of its result to tasks: a task holds the dense rows of one block, reads the cells of
that row or column of the grid and the dense rows that they meet from the shared folder, a bounded piece at a time, and
writes its rows. No dense row is shuffled, and a product writes its result once, so shuffled and written bytes grow as
entries and ids do; what is read from the shared folder are all dense rows, once for each block of the result. Only Gram
matrices of ``rank + oversample`` squared numbers reach the driver.

If the dense rows of one side fit in one cell's bytes (a bounded vocabulary), cells hold whole rows of the other
side, tasks read the dense rows of the small side from the shared folder, and a product and its way back are one
pass: the dense rows of the large side are never written, and only sums as large as the small side are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.operators.checkpoints import materialise, new_path

# Bytes of dense rows that the entries of a packed cell need, if every entry needs a row of its own. A block of a
# product's result, which a task holds, is at most BLOCK times as large.
CELL_BYTES = 64 << 20
BLOCK = 4
# Packed cells that a product brings together before it reads the dense rows for them.
TOGETHER = 8
# Cells in a file: a reader holds whole batches of them.
CELLS_PER_FILE = 16
# Partial Gram matrices that reach the driver.
MERGED = 8
# Entries multiplied at a time within a cell.
CHUNK = 1 << 14
# Dense rows in a packed row of their table, and packed rows that a product multiplies at a time.
PACKED = 1024
PIECE = 16


@dataclass
class Factors:
    """``rows``: U*S, ``cols``: V, both (id, vector); the share of variance they keep."""

    rows: DataFrame
    cols: DataFrame
    singular_values: list[float]
    explained_variance: list[float]


def _names(width: int) -> list[str]:
    return [f"d{j}" for j in range(width)]


def _whitening(gram: np.ndarray) -> np.ndarray:
    """The matrix that makes columns with this Gram matrix orthonormal; directions of no weight go."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > max(values.max(), 0.0) * 1e-12
    return vectors[:, keep] / np.sqrt(values[keep])


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system and the path in it."""
    return pafs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def _read(path: str, columns: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of the Parquet files of a folder, read a piece at a time; none if there is no such folder."""
    at, folder = _opened(path)
    for file in sorted(f.path for f in at.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet")):
        with pq.ParquetFile(file, filesystem=at, buffer_size=1 << 20) as f:
            yield from f.iter_batches(rows, columns=columns)


@dataclass
class Side:
    """The distinct ids of rows or columns: a folder for each block that holds any; an id's place is that in its folder."""

    path: str
    blocks: int
    table: DataFrame  # block, id

    def ids(self):
        """A function that reads the ids of a block, for use in tasks."""
        path = self.path

        def read(block: int) -> pa.Array:
            found = [b.column(0) for b in _read(f"{path}/block={block}", ["id"], 1 << 16)]
            return pa.concat_arrays(found) if found else pa.array([])

        return read


@dataclass
class Cells:
    """A sparse matrix in packed cells of a grid: a folder for each cell that holds any entry."""

    path: str
    table: DataFrame  # rb, cb, and entries by their places in the blocks
    sides: dict[str, Side]

    def reader(self, to: str):
        """A function that reads the packed cells of one block of ``to`` and one of the other side: places in both, values."""
        path, columns = self.path, ["row_at", "col_at", "value"] if to == "row" else ["col_at", "row_at", "value"]

        def read(block: int, other: int) -> Iterator[list[np.ndarray]]:
            rb, cb = (block, other) if to == "row" else (other, block)
            for batch in _read(f"{path}/rb={rb}/cb={cb}", columns, 1):
                yield [np.frombuffer(batch[c][0].as_buffer(), t) for c, t in zip(columns, (np.int32, np.int32, float))]

        return read

    def across(self, side: str) -> DataFrame:
        """The numbers of the blocks of a side, one in a task."""
        blocks = self.sides[side].blocks
        return self.table.sparkSession.range(0, blocks, 1, blocks)


@dataclass
class Blocks:
    """Dense rows of one side as a table of packed rows in the shared folder, few blocks to a file."""

    path: str
    width: int
    kind: str

    def reader(self):
        """A function that reads the packed rows of a block, ``PIECE`` at a time: their first places, their rows."""
        path, width, kind, groups = self.path, self.width, self.kind, []

        def read(block: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
            at, folder = _opened(path)
            if not groups:
                for fragment in pads.dataset(folder, filesystem=at, format="parquet").get_fragments():
                    groups.extend((fragment.path, g.id, g.statistics["block"]) for g in fragment.row_groups)
            wanted = {}
            for file, group, found in groups:
                if found["min"] <= block <= found["max"]:
                    wanted.setdefault(file, []).append(group)
            for file, some in wanted.items():
                with pq.ParquetFile(file, filesystem=at, buffer_size=1 << 20) as f:
                    for batch in f.iter_batches(PIECE, row_groups=some, columns=["block", "start", "x"]):
                        batch = batch.filter(pc.and_(batch["start"].is_valid(), pc.equal(batch["block"], block)))
                        if batch.num_rows:
                            yield batch["start"].to_numpy(), [
                                np.frombuffer(x.as_buffer(), kind).reshape(-1, width) for x in batch["x"]
                            ]

        return read


DENSE = pa.schema([("block", pa.int32()), ("start", pa.int32()), ("x", pa.binary()), ("sums", pa.binary())])
DENSE_SQL = "block int, start int, x binary, sums binary"


def _packed_rows(block: int, x: np.ndarray, packed: int, sums: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Packed rows of a block, and a row with the sums over them."""
    for start in range(0, len(x), packed):
        piece = np.ascontiguousarray(x[start : start + packed]).tobytes()
        yield pa.RecordBatch.from_pydict({"block": [block], "start": [start], "x": [piece], "sums": [None]}, DENSE)
    if sums is not None:
        yield pa.RecordBatch.from_pydict({"block": [block], "start": [None], "x": [None], "sums": [sums.tobytes()]}, DENSE)


def _written_blocks(packed: DataFrame, width: int, kind: str = "f8") -> Blocks:
    path = new_path(packed.sparkSession, "dense")
    packed.write.option("compression", "uncompressed").option("parquet.block.size", 32 << 20).parquet(path)
    return Blocks(path, width, kind)


def _side(entries: DataFrame, side: str, n: int, width: int) -> Side:
    """About as many blocks as a side's dense rows need, or as tasks can run; ``n`` changes balance, never results."""
    spark = entries.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    blocks = min(max(n, 1), tasks * max(1, ceil(n * 8 * width / (BLOCK * CELL_BYTES * tasks))))
    ids = entries.select(_block(side, blocks).alias("block"), F.col(side).alias("id")).distinct()
    path = new_path(spark, "ids")
    ids.repartition("block").sortWithinPartitions("block", "id").write.partitionBy("block").parquet(path)
    return Side(path, blocks, spark.read.schema(ids.select("id", "block").schema).parquet(path))


def _block(side: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(side), F.lit(blocks)).cast("int")


def pack_cells(entries: DataFrame, width: int) -> Cells:
    """Cells of (row, col, value) for products with ``width`` columns. What a cell holds beyond ``CELL_BYTES``, for a
    hot row or column, goes to further packed rows of it."""
    size = max(1, CELL_BYTES // (8 * width))
    counts = entries.agg(F.approx_count_distinct("row").alias("row"), F.approx_count_distinct("col").alias("col")).first()
    sides = {side: _side(entries, side, counts[side], width) for side in ("row", "col")}
    row_ids, col_ids = sides["row"].ids(), sides["col"].ids()
    schema = pa.schema([("rb", pa.int32()), ("cb", pa.int32()), *[(c, pa.binary()) for c in ("row_at", "col_at", "value")]])

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rb, cb = (k.as_py() for k in key)
        known = {"row": pd.Index(row_ids(rb).to_pandas()), "col": pd.Index(col_ids(cb).to_pandas())}
        held, n = [], 0

        def packed(t: pa.Table) -> pa.RecordBatch:
            at = {f"{c}_at": [known[c].get_indexer(t[c].to_pandas()).astype(np.int32).tobytes()] for c in known}
            return pa.RecordBatch.from_pydict({"rb": [rb], "cb": [cb], **at, "value": [t["value"].to_numpy().tobytes()]}, schema)

        for batch in batches:
            for start in range(0, batch.num_rows, size):
                piece = batch.slice(start, size)
                if n + piece.num_rows > size:
                    yield packed(pa.Table.from_batches(held))
                    held, n = [], 0
                held.append(piece)
                n += piece.num_rows
        if held:
            yield packed(pa.Table.from_batches(held))

    placed = entries.select(
        _block("row", sides["row"].blocks).alias("rb"), _block("col", sides["col"].blocks).alias("cb"), "row", "col", "value"
    )
    packed = placed.groupBy("rb", "cb").applyInArrow(pack, "rb int, cb int, row_at binary, col_at binary, value binary")
    path = new_path(entries.sparkSession, "cells")
    packed.write.partitionBy("rb", "cb").parquet(path)
    return Cells(path, entries.sparkSession.read.schema(packed.schema).parquet(path), sides)


def _dense_blocks(cells: Cells, side: str, dense: DataFrame, key: str, width: int, kind: str, values) -> Blocks:
    """Dense rows of a table in blocks; ``values`` makes rows of numbers from a frame of its other columns."""
    read = cells.sides[side].ids()

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = key[0].as_py()
        known = pd.Index(read(block).to_pandas())
        x = np.zeros((len(known), width), kind)
        for batch in batches:
            pdf = batch.to_pandas()
            at = known.get_indexer(pdf["id"])
            x[at[at >= 0]] = values(pdf[at >= 0])
        yield from _packed_rows(block, x, PACKED)

    rows = dense.withColumn("block", _block(key, cells.sides[side].blocks)).withColumnRenamed(key, "id")
    return _written_blocks(rows.groupBy("block").applyInArrow(pack, DENSE_SQL), width, kind)


def _sign_blocks(cells: Cells, side: str, width: int, seed: int) -> Blocks:
    """The random signs of a side, in a byte each: the same as ``_signs``."""
    hashes = [f"h{block}" for block in range((width + 63) // 64)]

    def values(pdf: pd.DataFrame) -> np.ndarray:
        h = pdf[hashes].to_numpy(np.int64)
        return np.stack([1 - 2 * (h[:, j // 64] >> (j % 64) & 1) for j in range(width)], axis=1)

    ids = cells.sides[side].table.select("id", *[F.xxhash64("id", F.lit(seed + i)).alias(h) for i, h in enumerate(hashes)])
    return _dense_blocks(cells, side, ids, "id", width, "i1", values)


def _product(
    cells: Cells, on: str, to: str, dense: Blocks, matrix: np.ndarray | None = None
) -> tuple[Blocks, np.ndarray, np.ndarray, int]:
    """The sparse matrix (or its transpose) times (dense times matrix), and of its rows y the sum of y y^T, of y, and their number."""
    width = dense.width if matrix is None else matrix.shape[1]
    ids, entries, rows, others = cells.sides[to].ids(), cells.reader(to), dense.reader(), cells.sides[on].blocks
    inner = dense.width

    def add(target: np.ndarray, source: np.ndarray, value: np.ndarray, other: int, out: np.ndarray) -> None:
        """Add what the entries of cells give, a piece of the dense rows at a time."""
        order = np.argsort(source // PACKED, kind="stable")
        ends = np.searchsorted(source[order] // PACKED, np.arange(source.max() // PACKED + 2))
        for starts, x in rows(other):
            wanted = [i for i, s in enumerate(starts) if s // PACKED + 1 < len(ends)]
            some = [order[ends[starts[i] // PACKED] : ends[starts[i] // PACKED + 1]] for i in wanted]
            if not sum(map(len, some)):
                continue
            places = np.cumsum([0, *map(len, x)])
            at = np.concatenate([source[s] + (places[i] - starts[i]) for s, i in zip(some, wanted)])
            some = np.concatenate(some)
            by = np.argsort(target[some], kind="stable")
            some, at = some[by], at[by]
            _sums(target[some], at, value[some], np.concatenate(x).astype(float, copy=False), out)

    def multiply(batches):
        for batch in batches:
            for block in batch["id"].to_pylist():
                out = np.zeros((len(ids(block)), inner))
                for other in range(others):
                    held = []
                    for cell in entries(block, other):
                        held.append(cell)
                        if len(held) == TOGETHER:
                            add(*map(np.concatenate, zip(*held)), other, out)
                            held = []
                    if held:
                        add(*map(np.concatenate, zip(*held)), other, out)
                sums = np.zeros((width + 2, width))
                for start in range(0, len(out), PACKED):
                    y = out[start : start + PACKED] if matrix is None else out[start : start + PACKED] @ matrix
                    out[start : start + PACKED, :width] = y
                    sums[:width] += y.T @ y
                    sums[width] += y.sum(axis=0)
                    sums[width + 1] += len(y)
                yield from _packed_rows(block, out[:, :width], PACKED, sums)

    def merge(batches):
        total = np.zeros((width + 2) * width)
        for batch in batches:
            for x in batch["sums"]:
                total += np.frombuffer(x.as_buffer())
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    out = _written_blocks(cells.across(to).mapInArrow(multiply, DENSE_SQL), width)
    sums = cells.table.sparkSession.read.schema("sums binary").parquet(out.path).where("sums is not null")
    parts = sums.coalesce(MERGED).mapInArrow(merge, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"]) for r in parts), np.zeros((width + 2) * width)).reshape(width + 2, width)
    return out, total[:width], total[width], int(total[-1, 0]) if width else 0


def _block_vectors(cells: Cells, side: str, dense: Blocks, matrix: np.ndarray, name: str) -> DataFrame:
    """(id, vector) of the dense rows times a matrix."""
    ids, rows, kind = cells.sides[side].ids(), dense.reader(), cells.sides[side].table.schema["id"].dataType

    def vectors(batches):
        for batch in batches:
            for block in batch["id"].to_pylist():
                known = ids(block)
                for starts, x in rows(block):
                    for start, y in zip(starts.tolist(), x):
                        yield _vectors(known.slice(start, len(y)), y @ matrix, known.type)

    return cells.across(side).mapInArrow(vectors, f"id {kind.simpleString()}, vector array<double>").withColumnRenamed("id", name)


def _multiply(
    cells: Cells, on: str, to: str, dense: DataFrame, names: list[str], matrix: np.ndarray | None = None
) -> tuple[DataFrame, list[str]]:
    """The sparse matrix (or its transpose) times (dense times matrix), of and as tables of rows: rows named by ``to``."""
    blocks = _dense_blocks(cells, on, dense.select(on, *names), on, len(names), "f8", lambda pdf: pdf[names].to_numpy(float))
    out = _product(cells, on, to, blocks, matrix)[0]
    found = _block_vectors(cells, to, out, np.eye(out.width), to)
    return found.select(to, *[F.col("vector")[j].alias(n) for j, n in enumerate(_names(out.width))]), _names(out.width)


def _signs(ids: DataFrame, key: str, names: list[str], seed: int) -> DataFrame:
    """Random signs from bits of a hash of the id: the same in every attempt."""
    signs = ids.select(key)
    for block in range((len(names) + 63) // 64):
        signs = signs.withColumn(f"h{block}", F.xxhash64(key, F.lit(seed + block)))

    def sign(j: int):
        bit = F.shiftrightunsigned(F.col(f"h{j // 64}"), j % 64).bitwiseAND(F.lit(1))
        return 1 - 2 * bit.cast("double")

    return signs.select(key, *[sign(j).alias(n) for j, n in enumerate(names)])


@dataclass
class Strips:
    """A sparse matrix of which one side is small: packed cells of whole rows of the large side, and the small side's places."""

    table: DataFrame  # ids and entries of the large side's rows, in order of rows; entries name the small side by place
    ids: DataFrame  # id and place


@dataclass
class Small:
    """Dense rows of the small side, times a matrix: a table of packed rows in the shared folder."""

    path: str
    table: DataFrame
    matrix: np.ndarray

    def load(self) -> np.ndarray:
        path = self.path
        at, folder = _opened(path)
        rows = pads.dataset(folder, filesystem=at, format="parquet").to_table(filter=pads.field("start") >= 0)
        order = np.argsort(rows["start"].to_numpy())
        x = [np.frombuffer(rows["x"][int(i)].as_buffer()).reshape(-1, len(self.matrix)) for i in order]
        return np.concatenate(x) @ self.matrix


def _strips(entries: DataFrame, n: int, rows: int, width: int) -> Strips:
    """Columns are the small side. Cells of as many rows and entries as a quarter of ``CELL_BYTES`` holds, and as many cells as tasks can run."""
    spark, quarter = entries.sparkSession, CELL_BYTES // 4
    cells = max(1, ceil(n * 16 / quarter), ceil(rows * 8 * width / quarter), min(rows, spark.sparkContext.defaultParallelism))
    ids = entries.select(F.col("col").alias("id")).distinct()
    ids = materialise(ids.select("id", (F.row_number().over(Window.orderBy("id")) - 1).alias("place")), "places")
    placed = entries.join(F.broadcast(ids), F.col("col") == F.col("id")).select(
        F.pmod(F.xxhash64("row"), F.lit(cells)).cast("int").alias("cell"), "row", "place", "value"
    )

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        at, found = pd.factorize(pdf["row"], use_na_sentinel=False)
        order = np.argsort(at, kind="stable")
        return pd.DataFrame({
            "ids": [found.tolist()], "at": [at[order].astype(np.int32).tobytes()],
            "place": [pdf["place"].to_numpy(np.int32)[order].tobytes()], "value": [pdf["value"].to_numpy(float)[order].tobytes()],
        })

    kind = entries.schema["row"].dataType.simpleString()
    packed = placed.groupBy("cell").applyInPandas(pack, f"ids array<{kind}>, at binary, place binary, value binary")
    path = new_path(spark, "strips")
    packed.write.option("maxRecordsPerFile", CELLS_PER_FILE // 4).parquet(path)
    return Strips(spark.read.schema(packed.schema).parquet(path), ids)


def _sums(at: np.ndarray, of: np.ndarray, value: np.ndarray, dense: np.ndarray, out: np.ndarray) -> None:
    """Add value times row ``of`` of dense to row ``at`` of out, for places ``at`` in order."""
    for start in range(0, len(at), CHUNK):
        some = slice(start, start + CHUNK)
        first = np.flatnonzero(np.diff(at[some], prepend=-1))
        out[at[some][first]] += np.add.reduceat(dense[of[some]] * value[some, None], first)


def _cell(batch: pa.RecordBatch, i: int) -> list[np.ndarray]:
    return [np.frombuffer(batch[c][i].as_buffer(), t) for c, t in (("at", np.int32), ("place", np.int32), ("value", float))]


def _there_and_back(strips: Strips, small: Small) -> tuple[Small, np.ndarray, np.ndarray, int]:
    """A^T (A V), and of the rows y of A V the sum of y y^T, of y, and their number."""
    width = small.matrix.shape[1]
    load, kind = Small(small.path, None, small.matrix).load, pa.schema([("start", pa.int32()), ("x", pa.binary())])

    def partial(batches):
        back = None
        for batch in batches:
            for i in range(batch.num_rows):
                if back is None:
                    v = load()
                    back, total = np.zeros((len(v), width)), np.zeros((width + 2, width))
                at, place, value = _cell(batch, i)
                y = np.zeros((at[-1] + 1, width))
                _sums(at, place, value, v, y)
                order = np.argsort(place, kind="stable")
                _sums(place[order], at[order], value[order], y, back)
                total[:width] += y.T @ y
                total[width] += y.sum(axis=0)
                total[width + 1] += len(y)
        if back is not None:
            for start in range(0, len(back), PACKED):
                yield pa.RecordBatch.from_pydict({"start": [start], "x": [back[start : start + PACKED].tobytes()]}, kind)
            yield pa.RecordBatch.from_pydict({"start": [-1], "x": [total.tobytes()]}, kind)

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for x in batch["x"]:
                total = total + np.frombuffer(x.as_buffer())
        yield pa.RecordBatch.from_pydict({"start": [key[0].as_py()], "x": [total.tobytes()]}, kind)

    parts = strips.table.select("at", "place", "value").mapInArrow(partial, "start int, x binary")
    out = _stored(parts.groupBy("start").applyInArrow(add, "start int, x binary"), np.eye(width))
    found = out.table.where("start < 0").first()
    total = np.frombuffer(found["x"]).reshape(width + 2, width) if found else np.zeros((width + 2, width))
    return out, total[:width], total[width], int(total[-1, 0])


def _stored(packed: DataFrame, matrix: np.ndarray) -> Small:
    path = new_path(packed.sparkSession, "small")
    packed.write.parquet(path)
    return Small(path, packed.sparkSession.read.schema(packed.schema).parquet(path).where("start is not null"), matrix)


def _small_signs(ids: DataFrame, names: list[str], seed: int) -> Small:
    """The random signs of the small side, packed."""
    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"start": [key[0] * PACKED], "x": [pdf.sort_values("place")[names].to_numpy(float).tobytes()]})

    rows = _signs(ids, "id", names, seed).join(ids, "id").withColumn("chunk", F.floor(F.col("place") / PACKED).cast("int"))
    return _stored(rows.groupBy("chunk").applyInPandas(pack, "start int, x binary"), np.eye(len(names)))


def _small_gram(small: Small) -> np.ndarray:
    """V^T V; as many partial results reach the driver as the bounded table has packed rows, ``MERGED`` at most."""
    matrix = small.matrix

    def partial(batches):
        total = np.zeros((matrix.shape[1],) * 2)
        for batch in batches:
            for x in batch["x"]:
                v = np.frombuffer(x.as_buffer()).reshape(-1, len(matrix)) @ matrix
                total += v.T @ v
        yield pa.RecordBatch.from_pydict({"x": [total.tobytes()]})

    parts = small.table.where("start >= 0").select("x").coalesce(MERGED).mapInArrow(partial, "x binary").collect()
    return sum((np.frombuffer(r["x"]) for r in parts), np.zeros(matrix.shape[1] ** 2)).reshape((matrix.shape[1],) * 2)


def _vectors(ids: pa.Array, x: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    flat = pa.array(np.ascontiguousarray(x).ravel())
    offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
    return pa.RecordBatch.from_arrays([ids.cast(kind), pa.ListArray.from_arrays(offsets, flat)], ["id", "vector"])


def _svd_of_strips(
    strips: Strips, names: list[str], rank: int, tolerance: float, rounds: int, seed: int
) -> tuple[DataFrame, DataFrame, list[float], np.ndarray, np.ndarray, int] | None:
    """U*S and V as (id, vector), singular values, and of U*S its Gram matrix, sum and number of rows."""
    before = None
    v = _small_signs(strips.ids, names, seed)
    for step in range(max(rounds, 1)):
        back, gram, total, n = _there_and_back(strips, v)
        basis = _whitening(gram)
        if not basis.size:
            return None
        projected = Small(back.path, back.table, basis)
        inner = _small_gram(projected)
        values, vectors = np.linalg.eigh(inner)
        # Directions of no weight are dropped, so a small matrix has fewer than `rank`.
        top = np.argsort(values)[::-1][:rank]
        top = top[values[top] > max(values.max(initial=0.0), 0.0) * 1e-12]
        sigma = np.sqrt(values[top])
        if before is not None and len(before) == len(sigma) and abs(sigma - before).max() <= tolerance * sigma[0]:
            break
        if step < rounds - 1:
            before, v = sigma, Small(back.path, back.table, basis @ _whitening(inner))
    turn = basis @ (vectors[:, top] * sigma)
    load_v, load_p = Small(v.path, None, v.matrix @ turn).load, Small(back.path, None, basis @ (vectors[:, top] / sigma)).load
    large_id = strips.table.schema["ids"].dataType.elementType
    small_id = strips.ids.schema["id"].dataType

    def multiply(batches):
        dense = None
        for batch in batches:
            for i in range(batch.num_rows):
                dense = load_v() if dense is None else dense
                at, place, value = _cell(batch, i)
                y = np.zeros((at[-1] + 1, dense.shape[1]))
                _sums(at, place, value, dense, y)
                ids = batch["ids"][i].values
                for start in range(0, len(y), PACKED):
                    yield _vectors(ids[start : start + PACKED], y[start : start + PACKED], ids.type)

    def look_up(batches):
        dense = None
        for batch in batches:
            dense = load_p() if dense is None else dense
            yield _vectors(batch["id"], dense[batch["place"].to_numpy()], batch["id"].type)

    rows = strips.table.mapInArrow(multiply, f"id {large_id.simpleString()}, vector array<double>")
    cols = strips.ids.mapInArrow(look_up, f"id {small_id.simpleString()}, vector array<double>")
    return rows, cols, sigma.tolist(), turn.T @ gram @ turn, total @ turn, n


def truncated_svd(
    entries: DataFrame, row: str, col: str, value: str, rank: int,
    oversample: int = 10, tolerance: float = 0.02, rounds: int = 30, seed: int = 42,
) -> Factors:
    """Rank-k factors of the sparse matrix given as (row, col, value), one entry per cell.

    Rounds go on until no singular value moves by more than ``tolerance`` of the largest, ``rounds`` at most.
    Rows, columns and values that are null are no entries; a matrix without weight has vectors of length 0.
    """
    a = entries.select(
        F.col(row).alias("row"), F.col(col).alias("col"), F.col(value).cast("double").alias("value")
    ).dropna()
    a = materialise(a, "entries")
    names = _names(rank + oversample)
    none = F.array().cast("array<double>").alias("vector")
    n, n_rows, n_cols = a.agg(F.count("*"), F.approx_count_distinct("row"), F.approx_count_distinct("col")).first()
    if n_cols * 8 * len(names) <= CELL_BYTES:
        strips = _strips(a, n, n_rows, len(names))
        found = _svd_of_strips(strips, names, rank, tolerance, rounds, seed)
        if found is None:
            return Factors(
                strips.table.select(F.explode("ids").alias(row), none), strips.ids.select(F.col("id").alias(col), none), [], []
            )
        row_table, col_table, sigma, squares, total, n_rows = found
        share = _shares(_column_variance(a, n_rows), squares, total, n_rows)
        return Factors(row_table.withColumnRenamed("id", row), col_table.withColumnRenamed("id", col), sigma, share)
    cells = pack_cells(a, len(names))
    sample, gram, total, n_rows = _product(cells, "col", "row", _sign_blocks(cells, "col", len(names), seed))
    before = None
    for step in range(max(rounds, 1)):
        basis = _whitening(gram)
        if not basis.size:
            return Factors(
                cells.sides["row"].table.select(F.col("id").alias(row), none),
                cells.sides["col"].table.select(F.col("id").alias(col), none), [], [],
            )
        projected, inner, _, _ = _product(cells, "row", "col", sample, basis)
        values, vectors = np.linalg.eigh(inner)
        # Directions of no weight are dropped, so a small matrix has fewer than `rank`.
        top = np.argsort(values)[::-1][:rank]
        top = top[values[top] > max(values.max(initial=0.0), 0.0) * 1e-12]
        sigma = np.sqrt(values[top])
        if before is not None and len(before) == len(sigma) and abs(sigma - before).max() <= tolerance * sigma[0]:
            break
        if step < rounds - 1:
            before = sigma
            sample, gram, total, n_rows = _product(cells, "col", "row", projected, _whitening(inner))
    turn = basis @ (vectors[:, top] * sigma)
    return Factors(
        _block_vectors(cells, "row", sample, turn, row),
        _block_vectors(cells, "col", projected, vectors[:, top] / sigma, col),
        sigma.tolist(), _shares(_cell_variance(cells, n_rows), turn.T @ gram @ turn, total @ turn, n_rows),
    )


def _shares(full: float | None, squares: np.ndarray, total: np.ndarray, n_rows: int) -> list[float]:
    """Variance over rows of each kept direction against that of all columns."""
    kept_var = np.diag(squares) / max(n_rows, 1) - (total / max(n_rows, 1)) ** 2
    return (kept_var / full).tolist() if full else [0.0] * len(kept_var)


def _column_variance(a: DataFrame, n_rows: int) -> float | None:
    """Variance over rows, summed over columns."""
    return a.groupBy("col").agg(
        F.sum(F.col("value") * F.col("value")).alias("sq"), F.sum("value").alias("s")
    ).agg(
        F.sum(F.col("sq") / max(n_rows, 1) - (F.col("s") / max(n_rows, 1)) * (F.col("s") / max(n_rows, 1)))
    ).first()[0]


def _cell_variance(cells: Cells, n_rows: int) -> float | None:
    """The same from packed cells: all entries of a column are in one column of the grid, so none is shuffled."""
    ids, entries, others, n = cells.sides["col"].ids(), cells.reader("col"), cells.sides["row"].blocks, max(n_rows, 1)

    def variance(batches):
        for batch in batches:
            for block in batch["id"].to_pylist():
                squares, total = np.zeros((2, len(ids(block))))
                for other in range(others):
                    for target, _, value in entries(block, other):
                        squares += np.bincount(target, value * value, len(squares))
                        total += np.bincount(target, value, len(total))
                yield pa.RecordBatch.from_pydict({"v": [float((squares / n - (total / n) ** 2).sum())]})

    return cells.across("col").mapInArrow(variance, "v double").agg(F.sum("v")).first()[0]
