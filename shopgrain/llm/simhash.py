"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits, each set if it is set in more than half of the XXH64 hashes of a text's word
shingles. Two fingerprints with at most four differing bits have one 32-bit half with at most two. The
anchors of a half are the words of a covering code: the [31, 26] Hamming code and one free bit, 2^27 words
with covering radius 1. The midpoint of a close pair of halves lies within one bit of both, and an anchor
lies within the radius of the midpoint; so each half goes to every anchor within radius plus one (17 at
most), and every close pair meets at an anchor. There the whole fingerprints are compared.

Only distinct fingerprints are compared, never their copies. Anchors with many fingerprints are dealt in
tiles to several tasks, and a tile returns a spanning forest of its links, not its pairs.

Defined results: a null text is the empty text; one without words has fingerprint zero, linked like any
other; one with fewer words than a shingle is one shingle; repeated rows share a component; a component
whose ids are all null has null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import columns_of, free_name, text_or_empty
from shopgrain.llm.components import components
from shopgrain.operators.checkpoints import materialise

SEED, BITS = 42, 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Hashes summed at a time, and fingerprints of an anchor compared in one task.
_BLOCK, TILE = 1 << 16, 2048


def fingerprint(text: str, width: int) -> int:
    """Signed 64-bit value of the text's fingerprint over shingles of ``width`` words."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()  # bytes: ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    ones, n = np.zeros(64, np.int64), len(ends)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, _BLOCK):
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[i : i + _BLOCK], ends[i : i + _BLOCK])), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``fp``, one row per row of df."""
    return df.select(F.col(key).alias("id"), _printer(width)(text_or_empty(text)).alias("fp"))


def _printer(width: int):
    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), width) for t in texts], pa.int64())

    return fp


def _flips() -> list[list[int]]:
    """For each syndrome of the Hamming code the bits to change to reach every anchor within distance two.

    Bit i - 1 of a half stands for place i of the code (1 to 31); bit 31 is free.
    """
    free, out = 1 << 31, []
    for s in range(32):
        flips = [0, free] if s == 0 else [1 << (s - 1), 1 << (s - 1) | free]
        flips += [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, 32) if s and i < i ^ s]
        out.append(flips)
    return out


def anchors(fp: Column) -> Column:
    """Keys of all anchors, of both halves, within covering radius plus one of a fingerprint."""
    flips = F.array(*(F.array(*(F.lit(x).cast("long") for x in row)) for row in _flips()))
    found = []
    for half in (0, 1):
        word = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        syndrome = F.lit(0)
        for k in range(5):
            mask = sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1)
            syndrome += F.bit_count(word.bitwiseAND(F.lit(mask).cast("long"))) % 2 * (1 << k)
        found.append(_reach(word, F.element_at(flips, (syndrome + 1).cast("int")), half << 32))
    return F.concat(*found)


def _reach(word: Column, flips: Column, half: int) -> Column:
    return F.transform(flips, lambda x: word.bitwiseXOR(x) + F.lit(half).cast("long"))


def _forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints, at most one link fewer than there are."""
    out, open_, unsigned = [], np.ones(len(fps), bool), fps.view(np.uint64)  # of a negative number, numpy counts other bits
    while open_.any():
        frontier = [int(open_.argmax())]
        open_[frontier[0]] = False
        while frontier:
            i = frontier.pop()
            near = np.flatnonzero(open_ & (np.bitwise_count(unsigned ^ unsigned[i]) <= bits))
            open_[near] = False
            out += [(int(fps[i]), int(fps[j])) for j in near]
            frontier += near.tolist()
    return out


def _compare(bits: int):
    """Over rows sorted by anchor and tile: the links found in each run of equal keys."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros((4, 0), np.int64)]
        for batch in batches:
            now = np.stack([batch[c].to_numpy() for c in ("anchor", "i", "j", "fp")])
            rows = np.concatenate((*held, now), axis=1)
            change = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(0)) + 1
            if not len(change):
                held = [*held, now] if len(held) > 1 or held[0].size else [now]
                continue
            yield _runs(rows[:, : change[-1]], np.concatenate(([0], change)), bits)
            held = [rows[:, change[-1] :]]
        rows = np.concatenate(held, axis=1)
        yield _runs(rows, np.array([0, rows.shape[1]]), bits)

    return links


def _runs(rows: np.ndarray, bounds: np.ndarray, bits: int) -> pa.RecordBatch:
    found, fps = set(), np.ascontiguousarray(rows[3]).view(np.uint64)
    for k in np.flatnonzero(np.diff(bounds) > 1):
        a, b = bounds[k], bounds[k + 1]
        if b - a == 2:
            if (int(fps[a]) ^ int(fps[a + 1])).bit_count() <= bits:
                found.add((int(rows[3, a]), int(rows[3, a + 1])))
        else:
            found.update(_forest(np.ascontiguousarray(rows[3, a:b]), bits))
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def close_pairs(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct values of ``fp`` at most ``bits`` (4 or fewer) bits apart.

    Not every close pair is a link, but every close pair is connected.
    """
    if not 0 <= bits <= BITS:
        raise ValueError("the anchors cover distances of up to 4")
    at = fps.select("fp", F.explode(anchors(F.col("fp"))).alias("anchor"))
    crowded = materialise(
        at.groupBy("anchor").count().where(F.col("count") > TILE)
        .select("anchor", F.ceil(F.col("count") / TILE).cast("int").alias("parts")),
        "crowded",
    )
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = (
        at.join(crowded, "anchor", "left")
        .select("anchor", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
        .select("anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    return (
        dealt.select(*(F.col(c).cast("long") for c in ("anchor", "i", "j", "fp")))
        .repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
        .mapInArrow(_compare(bits), "a long, b long").distinct()
    )


def groups(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """``fp``, ``group`` and ``component_id`` (the group's least id) for each distinct fp of ``id``, ``fp`` rows."""
    classes = materialise(fps.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(close_pairs(classes.select("fp"), bits)).toDF("fp", "root")
    named = classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"), "least")
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    return named.join(least, "group").select("fp", "group", "component_id")


def near_duplicates(
    df: DataFrame, width: int, bits: int = BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id``, ``fp`` and ``component_id`` (the least id reachable by links) for every row of df."""
    marked = materialise(fingerprints(df, width, key, text), "fingerprints")
    return marked.join(groups(marked, bits), "fp").select("id", "fp", "component_id")


def keep_one(df: DataFrame, width: int, bits: int = BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df without near-duplicates: of each group one row with the least id stays.

    Repeated rows are one group, of which one stays.
    """
    fp, group, least = free_name(df, "fp"), free_name(df, "group"), free_name(df, "least")
    marked = materialise(df.withColumn(fp, _printer(width)(text_or_empty(text))), "marked")
    found = groups(marked.select(F.col(key).alias("id"), F.col(fp).alias("fp")), bits)
    found = found.select(F.col("fp").alias(fp), F.col("group").alias(group), F.col("component_id").alias(least))
    first = marked.join(found, fp).where(F.col(key).eqNullSafe(F.col(least)))
    return first.dropDuplicates([group]).select(*columns_of(df))
