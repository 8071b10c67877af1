"""Trie of conversation prefixes, rolled up in bands of depth.

Each distinct sequence of first turns is a node. A node is told by a digest of its sequence: every turn's
SHA-256 is mixed with its place and the values of a prefix are combined by exclusive or, 128 bits in all, so
prefixes come from running sums over a range-partitioned sort and no task has to hold a conversation.

Subtree sums would take as many rounds as the trie is deep, or as many rows a node as it has ancestors. Bands
of ``BAND`` depths bound both: a node is exploded only to its ancestors within its band, which completes the
totals of a band. The tops of the bands form a trie that is less deep by the factor ``BAND``; the same is done
with it, and the completed totals of band tops then go to the band above, to the ancestors there of the node
that the top hangs on. Rounds grow with the logarithm of the depth, rows per node are at most ``BAND`` a round.

Defined results: rows without a conversation id belong to no conversation and are left out; a null role or
text counts as empty; turns are ordered by number, null first, and turns of one number by the digest of role
and text (repeated rows are turns of their own); a conversation without turns is a member of the root alone;
an empty table has no node. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from shopgrain.llm.common import text_or_empty
from shopgrain.operators.checkpoints import materialise

#: Depths in a band, and bytes of ids that travel as one row.
BAND, CHUNK = 4, 1 << 16
ROOT = "0" * 32


def running(df: DataFrame, key: str, order: Sequence[str], to: str, xors: Sequence[str] = ()) -> DataFrame:
    """df with each row's place (from 0) among those of its key, and the running exclusive or of some columns.

    Rows are sorted by ranges of key and order, so a key with many rows lies in many ranges. Each task counts on
    from the start of its range; only the first key of a range can have rows before it, so what is carried
    over is one row a range at most.
    """
    names = [*df.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, count = TaskContext.get().partitionId(), None, 0
        before = [np.int64(0)] * len(xors)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            on = keys[0].as_py() == last
            starts = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            place = np.arange(n) - starts[run_of]
            place[run_of == 0] += count if on else 0
            made = []
            for i, column in enumerate(xors):
                sums = np.bitwise_xor.accumulate(batch.column(column).to_numpy())
                sums = sums ^ np.concatenate([[np.int64(0)], sums])[starts][run_of]
                sums[run_of == 0] ^= before[i] if on else np.int64(0)
                before[i] = sums[-1]
                made.append(pa.array(sums))
            last, count = keys[n - 1].as_py(), int(place[-1]) + 1
            ranges = pa.array(np.full(n, task, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, ranges, pa.array(place), *made], schema.names)

    schema = StructType(
        [*df.schema.fields, StructField("range_", IntegerType()), StructField(to, LongType()), *(StructField(f"{x}_run", LongType()) for x in xors)]
    )
    by = [F.col(c).asc_nulls_first() for c in (key, *order)]
    rows = materialise(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema), "running")
    ends = rows.groupBy(key, "range_").agg(
        (F.max(to) + 1).alias("n_"), *(F.max_by(f"{x}_run", to).alias(f"{x}_end") for x in xors)
    )
    earlier = Window.partitionBy(key).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        key, "range_", F.sum("n_").over(earlier).alias("n_"),
        *(F.bit_xor(f"{x}_end").over(earlier).alias(f"{x}_end") for x in xors),
    ).where(F.col("n_") > 0)
    # One row a range at most, so the size of this side is bounded by the number of tasks.
    found = rows.join(F.broadcast(carried), [key, "range_"], "left")
    return found.select(
        *names, (F.col(to) + F.coalesce("n_", F.lit(0))).alias(to),
        *(F.col(f"{x}_run").bitwiseXOR(F.coalesce(f"{x}_end", F.lit(0).cast("long"))).alias(f"{x}_run") for x in xors),
    )


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def _path(first: Column, second: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(first), 16, "0"), F.lpad(F.hex(second), 16, "0")))


def paths(turns: DataFrame) -> DataFrame:
    """One row a turn: conversation ``c``, ``depth`` (from 1), ``key`` of the prefix that it ends, ``parent``, ``size``.

    ``size`` is the code points of the turn's text.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    small = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("t"), digest.alias("d"), F.length(text).cast("long").alias("size")
    ).select("c", "t", _half(F.col("d"), 1).alias("h"), _half(F.col("d"), 17).alias("g"), "size")
    placed = running(small, "c", ["t", "h", "g"], "place")
    mixed = placed.select(
        "c", (F.col("place") + 1).alias("depth"), "size",
        F.xxhash64("h", "g", "place").alias("a"), F.xxhash64("g", "place", "h").alias("b"),
    )
    found = running(mixed, "c", ["depth"], "at", ["a", "b"])
    a, b = F.col("a_run"), F.col("b_run")
    return found.select(
        "c", "depth", "size", _path(a, b).alias("key"),
        _path(a.bitwiseXOR(F.col("a")), b.bitwiseXOR(F.col("b"))).alias("parent"),
    )


def _chains(rows: DataFrame, band: int) -> tuple[DataFrame, DataFrame]:
    """Of (c, depth, key): the path of each node within its band, and of each band's top the path it hangs on.

    A group holds one conversation's prefixes in one band and the top of the next: band + 1 rows at most.
    """
    depth = F.col("depth")
    own = F.floor(depth / band).cast("long")
    bands = F.when((depth > 0) & (depth % band == 0), F.array(own, own - 1)).otherwise(F.array(own))
    groups = (
        rows.select("c", "depth", "key", F.explode(bands).alias("band"))
        .groupBy("c", "band").agg(F.sort_array(F.collect_list(F.struct("depth", "key"))).alias("p"))
    )
    keys = F.transform("p", lambda p: p["key"])
    entry = F.transform(
        "p", lambda p, i: F.struct(
            p["key"].alias("key"), (p["depth"] == (F.col("band") + 1) * band).alias("next"),
            F.when(p["depth"] == (F.col("band") + 1) * band, F.slice(keys, 1, band)).otherwise(F.slice(keys, 1, i + 1)).alias("chain"),
        )
    )
    # All members of a node have the same path to it.
    found = materialise(groups.select(F.inline(entry)).groupBy("key", "next").agg(F.first("chain").alias("chain")), "chains")
    return found.where(~F.col("next")).drop("next"), found.where("next").drop("next")


def roll_up(values: DataFrame, rows: DataFrame, sums: Sequence[str], deepest: int, band: int = BAND) -> DataFrame:
    """Sums over the subtree of every node: ``values`` has (key, sums...), ``rows`` (c, depth, key) of all prefixes."""
    inside, above = _chains(rows, band)
    total = [F.sum(s).alias(s) for s in sums]

    def spread(df: DataFrame, chains: DataFrame) -> DataFrame:
        return df.join(chains, "key").select(F.explode("chain").alias("key"), *sums)

    complete = spread(values, inside).groupBy("key").agg(*total)
    if deepest < band:
        return complete
    complete = materialise(complete, "bands")
    tops = materialise(
        rows.where(F.col("depth") % band == 0).select("c", (F.col("depth") / band).cast("long").alias("depth"), "key"), "tops"
    )
    of_tops = complete.join(tops.select("key").distinct(), "key", "left_semi")
    passed = roll_up(of_tops, tops, sums, deepest // band, band)
    return complete.unionByName(spread(passed, above)).groupBy("key").agg(*total)


def _listed(ends: DataFrame) -> DataFrame:
    """Of (key, c): SHA-256 of the numbers of each key in order, joined by commas.

    Sorted by ranges of key and number, tasks join neighbours into texts of up to ``CHUNK`` bytes; a key's
    texts then pass through one hash one after another, and no list is ever held.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, 0, [], 0
        for batch in batches:
            out = []
            for k, c in zip(batch.columns[0].to_pylist(), batch.columns[1].to_pylist(), strict=True):
                if held and (k != key or size > CHUNK):
                    out.append((key, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    key, first = k, c
                held.append(str(c))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["key", "first", "ids"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([first]), pa.array([",".join(held)])], ["key", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.columns[0].to_pylist(), batch.columns[2].to_pylist(), strict=True):
                if k != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["key", "digest"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "digest"])

    texts = ends.repartitionByRange("key", "c").sortWithinPartitions("key", "c").mapInArrow(join, "key string, first long, ids string")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key string, digest string")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, band: int = BAND) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role and text; ``conversations`` the conv_id of all conversations, also those
    without a turn (left out: all that have one). n_leaves counts the childless nodes of the subtree.
    saved_tokens adds up, over the subtree, each node's members but one times the code points of its last text.
    ends_sha256 digests the members that end at the node.
    """
    rows = materialise(paths(turns), "paths")
    if conversations is None:
        ids = rows.select("c").distinct()
    else:
        ids = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("c")).distinct()
    top = ids.select("c", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"))
    rows = materialise(rows.unionByName(top), "prefixes")
    nodes = rows.groupBy("key").agg(
        F.min("c").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        F.max("size").alias("size"), F.count("*").alias("n_convs"),
    )
    nodes = materialise(nodes, "nodes")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "children")
    values = nodes.select(
        "key", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    )
    deepest = nodes.agg(F.max("depth")).collect()[0][0] or 0
    sums = roll_up(values, rows.select("c", "depth", "key"), ["n_leaves", "saved_tokens"], deepest, band)
    ends = _listed(rows.groupBy("c").agg(F.max_by("key", "depth").alias("key")).select("key", "c"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(sums, "key").join(ends, "key", "left").join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.lit(none)).alias("ends_sha256"),
    )
