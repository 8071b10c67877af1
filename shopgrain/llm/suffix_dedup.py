"""Text that occurs elsewhere too, found by longest-previous-factor arrays and removed byte by byte.

A repeat is a string of ``depth`` bytes that starts at more than one place of the corpus. Comparing all
suffixes of a corpus would move each of its bytes many times, so repeats are first enclosed:

1. Of every window of ``depth`` bytes the gram of ``GRAM`` bytes with the least hash is its anchor. Equal
   windows have equal anchors at equal offsets, so a repeat's anchor is itself repeated. About one byte
   in ninety is an anchor; only anchors are counted across the corpus.
2. The stretch of all windows that share a repeated anchor is brought to the anchor's other stretches, equal
   ones added up in each task first.
3. There the suffixes of the stretches are put in order by their first ``depth`` bytes (prefix
   doubling), equal ones by place. In that order the previous smaller position of a suffix, if it has
   the same ``depth`` bytes, is an earlier match: its longest previous factor reaches ``depth``.
4. The matches return to the documents as spans.

``keep="none"`` removes every byte of every repeat, ``keep="first"`` all but what the first place (by id, then
position) holds of each. Anchors with very many different stretches (``CROWD``) are not gathered: their windows
are counted as 128-bit digests, spread over all tasks.

Defined results: a null text is empty; texts shorter than ``depth`` keep everything; matches never cross
documents; equal rows repeat each other; rows with one id and different texts are different documents; an
empty table gives no rows; other columns are ignored. Ids are integers; null comes first.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import text_or_empty
from shopgrain.llm.rolling import stretch_hashes
from shopgrain.operators.checkpoints import materialise

DEPTH, GRAM = 200, 32
#: Windows looked at together, bytes of stretches ordered together, stretches added up in a task before
#: they are handed on, and different stretches of an anchor above which windows are counted instead.
BLOCK, CHUNK, HELD, CROWD = 1 << 18, 1 << 21, 1 << 15, 1 << 12


def anchors(data: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Rows of gram hash, position, first and last window start, for the anchors of all windows of data."""
    out = [np.zeros((4, 0), np.int64)]
    width = depth - GRAM + 1
    for at in range(0, len(data) - depth + 1, BLOCK):
        part = data[at : at + BLOCK + depth - 1]
        place = np.arange(len(part) - GRAM + 1)
        hashes = stretch_hashes(part, place, place + GRAM)
        # The place in the low bits: the least value of a window tells where it is, the leftmost of equals.
        low = np.uint64(BLOCK.bit_length() + 1)
        least = (hashes >> low << low) | place.astype(np.uint64)
        reach = 1
        while reach * 2 <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if width > reach:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        chosen = (least & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = np.append(first[1:], len(chosen)) - 1
        p = chosen[first]
        out.append(np.stack((hashes[p].view(np.int64), p + at, first + at, last + at)))
    return np.concatenate(out, axis=1)


def _bytes(text: pa.StringScalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer() or b"", np.uint8)


def _find_anchors(depth: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                found = [anchors(_bytes(t), depth)[:2] for t in part["text"]]
                rows = np.repeat(np.arange(len(found)), [f.shape[1] for f in found])
                found = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0]), part["id"].take(pa.array(rows)), pa.array(found[1].astype(np.int32))],
                    ["anchor", "id", "pos"],
                )

    return find


STRETCH = "anchor long, name long, n long, first_id long, first_at long, bytes binary, id long, mark long, at long"
_STRETCH = pa.schema(
    [(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in STRETCH.split(", ")]
)


def _cut_stretches(depth: int):
    """From texts and their repeated anchors: a row per stretch and place, and added-up stretches with their bytes."""

    def flush(held: dict) -> pa.RecordBatch:
        rows = [
            {"anchor": a, "name": b, "n": n, "first_id": i, "first_at": p, "bytes": raw}
            for (a, b), (n, (_, i, p), raw) in held.items()
        ]
        held.clear()
        return pa.RecordBatch.from_pylist(rows, _STRETCH)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for i in range(batch.num_rows):
                wanted = np.unique(np.asarray(batch["places"][i].values))
                data, key, mark = _bytes(batch["text"][i]), batch["id"][i].as_py(), batch["mark"][i].as_py()
                found = anchors(data, depth)
                places = []
                for a, pos, lo, hi in found[:, np.isin(found[1], wanted)].T.tolist():
                    raw = data[lo : hi + depth].tobytes()
                    name = xxhash.xxh64_intdigest(raw, pos - lo) - (1 << 63)
                    order = (key is not None, key, lo)
                    n, first, _ = held.get((a, name), (0, order, b""))
                    held[a, name] = n + 1, min(first, order, key=lambda x: (x[0], x[1] or 0, x[2])), raw
                    places.append((a, name, lo))
                if places:
                    a, name, lo = zip(*places, strict=True)
                    yield _places(a, name, key, mark, lo)
                if len(held) > HELD:
                    yield flush(held)
        yield flush(held)

    return cut


def _places(anchor, name, key, mark, at) -> pa.RecordBatch:
    n = len(at)
    none = pa.nulls(n, pa.int64())
    columns = [
        pa.array(anchor, pa.int64()), pa.array(name, pa.int64()), none, none, none, pa.nulls(n, pa.binary()),
        pa.array([key] * n, pa.int64()), pa.array([mark] * n, pa.int64()), pa.array(at, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_STRETCH)


def suffix_classes(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes at ``starts`` by their first ``depth`` bytes; equal exactly if these are equal."""
    if depth < 8:
        raise ValueError("depth must be 8 at least")
    padded = np.concatenate((data, np.zeros(2 * depth, np.uint8))).astype(np.uint64)
    n, rank, reach = len(data) + depth, np.zeros(len(data) + depth, np.uint64), 8
    for k in range(8):
        rank = (rank << np.uint64(8)) | padded[k : k + n]
    rank = np.unique(rank, return_inverse=True)[1]
    while reach * 2 <= depth:
        ahead = np.concatenate((rank[reach:], np.zeros(reach, np.int64)))
        rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1]
        reach *= 2
    return np.unique(rank[starts] * (n + 1) + rank[starts + depth - reach], return_inverse=True)[1]


RUNS = "array<struct<start:bigint,end:bigint>>"
FLAGS = f"anchor long, name long, first_id long, first_at long, runs {RUNS}, rest {RUNS}"


def match(rows: list[tuple], depth: int) -> list[tuple]:
    """Of stretches (anchor, name, n, first_id, first_at, bytes): the runs of bytes that are repeats.

    The rows hold all stretches of their anchors. ``runs`` are windows that start anywhere else too; ``rest`` are
    those of them that also have an earlier place than this stretch's first. Places count from the stretch.
    """
    # A stretch none of whose windows has the hash of another is no part of a match between stretches.
    single = {i for i, same in enumerate(_share_a_window([r[5] for r in rows], depth)) if not same}
    whole = [(*r[:2], *r[3:5], [(0, len(r[5]))], []) for i, r in enumerate(rows) if i in single and r[2] > 1]
    rows = [r for i, r in enumerate(rows) if i not in single]
    if not rows:
        return whole
    raw = [r[5] for r in rows]
    sizes = np.array([len(b) for b in raw])
    windows = sizes - depth + 1
    owner = np.repeat(np.arange(len(rows)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    data = np.frombuffer(b"".join(raw), np.uint8)
    cls = suffix_classes(data, (np.cumsum(sizes) - sizes)[owner] + offset, depth)
    known = np.array([r[3] is not None for r in rows])[owner]
    first = np.array([r[3] or 0 for r in rows])[owner]
    at = np.array([r[4] for r in rows])[owner] + offset
    # Suffix order, equal suffixes by place: one whose predecessor is equal has a previous factor of full depth.
    order = np.lexsort((at, first, known, cls))
    equal = cls[order][1:] == cls[order][:-1]
    previous, following = np.zeros(len(order), bool), np.zeros(len(order), bool)
    previous[order[1:]] = equal
    following[order[:-1]] = equal
    repeated = previous | following | (np.array([r[2] for r in rows]) > 1)[owner]
    ends = np.cumsum(windows)
    found = zip(rows, _runs(repeated, ends, depth), _runs(previous, ends, depth), strict=True)
    return whole + [(*r[:2], *r[3:5], runs, rest) for r, runs, rest in found if runs]


def _share_a_window(raw: list[bytes], depth: int) -> np.ndarray:
    """Whether any window of each stretch has the hash of another window of them all."""
    sizes = np.array([len(b) for b in raw])
    windows = sizes - depth + 1
    owner = np.repeat(np.arange(len(raw)), windows)
    starts = np.arange(len(owner)) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(windows) - windows), windows)
    hashes = stretch_hashes(np.frombuffer(b"".join(raw), np.uint8), starts, starts + depth)
    _, at, n = np.unique(hashes, return_inverse=True, return_counts=True)
    return np.bincount(owner[n[at] > 1], minlength=len(raw)) > 0


def _runs(flagged: np.ndarray, ends: np.ndarray, depth: int) -> list[list[tuple[int, int]]]:
    """For each part of the flagged windows, up to its end, the runs of bytes that they cover."""
    out: list[list[tuple[int, int]]] = [[] for _ in ends]
    before = np.concatenate(([0], ends[:-1]))
    opens = flagged.copy()
    opens[1:] &= ~flagged[:-1]
    opens[before] = flagged[before]
    closes = flagged.copy()
    closes[:-1] &= ~flagged[1:]
    closes[ends - 1] = flagged[ends - 1]
    lo, hi = np.flatnonzero(opens), np.flatnonzero(closes)
    part = np.searchsorted(ends, lo, side="right")
    for k, a, b in zip(part.tolist(), (lo - before[part]).tolist(), (hi - before[part] + depth).tolist(), strict=True):
        out[k].append((a, b))
    return out


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FLAGS = pa.schema([*((c, pa.int64()) for c in ("anchor", "name", "first_id", "first_at")), ("runs", _RUN), ("rest", _RUN)])


def _flag_batch(flags: list[tuple]) -> pa.RecordBatch:
    plain = [pa.array([f[i] for f in flags], pa.int64()) for i in range(4)]
    return pa.RecordBatch.from_arrays([*plain, *(_run_array([f[i] for f in flags]) for i in (4, 5))], schema=_FLAGS)


def _run_array(lists: list[list[tuple[int, int]]]) -> pa.Array:
    flat = np.array([x for runs in lists for x in runs], np.int64).reshape(-1, 2)
    offsets = np.concatenate(([0], np.cumsum([len(runs) for runs in lists]))).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def _match_groups(depth: int):
    """Over stretches sorted by anchor and name; an anchor has at most CROWD of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple] = []
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("anchor", "name", "n", "first_id", "first_at", "bytes")), strict=True):
                if group and group[-1][:2] == r[:2]:
                    group[-1] = _added(group[-1], r)
                    continue
                if group and group[-1][0] != r[0]:
                    chunk += _open_group(group)
                    group = []
                    if size > CHUNK:
                        yield _flag_batch(match(chunk, depth))
                        chunk, size = [], 0
                group.append(r)
                size += len(r[5])
        chunk += _open_group(group)
        yield _flag_batch(match(chunk, depth) if chunk else [])

    return run


def _open_group(group: list[tuple]) -> list[tuple]:
    """A single stretch at a single place is no repeat."""
    return group if len(group) > 1 or (group and group[0][2] > 1) else []


def _added(a: tuple, b: tuple) -> tuple:
    first = min(a[3:5], b[3:5], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    return (*a[:2], a[2] + b[2], *first, a[5])


def _count_windows(stretches: DataFrame, depth: int) -> DataFrame:
    """The same flags for anchors with any number of stretches, from digests of single windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch["bytes"][i].as_py()
                digests = [blake2b(raw[j : j + depth], digest_size=16).digest() for j in range(len(raw) - depth + 1)]
                take = pa.array(np.full(len(digests), i))
                columns = [batch[c].take(take) for c in ("anchor", "name", "n", "first_id", "first_at")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(range(len(digests)), pa.int64()), *columns],
                    ["digest", "offset", "anchor", "name", "n", "first_id", "first_at"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                bits = np.zeros((2, max(r["offsets"]) + 1), bool)
                bits[:, r["offsets"]] = True
                bits[1, r["leads"]] = False
                end = np.array([bits.shape[1]])
                runs = (_runs(b, end, depth)[0] for b in bits)
                out.append((r["anchor"], r["name"], r["first_id"], r["first_at"], *runs))
            yield _flag_batch(out)

    one = stretches.groupBy("anchor", "name").agg(
        F.sum("n").alias("n"), F.min(F.struct("first_id", "first_at")).alias("first"), F.first("bytes").alias("bytes")
    ).select("anchor", "name", "n", "first.*", "bytes")
    each = one.mapInArrow(
        windows, "digest binary, offset long, anchor long, name long, n long, first_id long, first_at long"
    ).withColumn("place", F.struct("first_id", (F.col("first_at") + F.col("offset")).alias("at")))
    twice = each.groupBy("digest").agg(F.sum("n").alias("n"), F.min("place").alias("leader")).where("n > 1").drop("n")
    found = each.join(twice, "digest").groupBy("anchor", "name", "first_id", "first_at").agg(
        F.collect_list("offset").alias("offsets"),
        F.collect_list(F.when(F.col("place").eqNullSafe(F.col("leader")), F.col("offset"))).alias("leads"),
    )
    return found.mapInArrow(pack, FLAGS)


def merged(runs: list[dict]) -> list[tuple[int, int]]:
    """Runs in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((r["start"], r["end"]) for r in runs):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


RESULT = "struct<kept:binary,spans:array<struct<start:long,end:long>>>"


def _remover():
    @F.arrow_udf(RESULT)
    def remove(texts: pa.Array, runs: pa.Array) -> pa.Array:
        kind = pa.struct([("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        out = []
        for t, r in zip(texts, runs, strict=True):
            if not r.is_valid:
                out.append(None)
                continue
            raw, at, parts, spans = t.as_py().encode(), 0, [], merged(r.as_py())
            for s, e in spans:
                parts.append(raw[at:s])
                at = e
            out.append({"kept": b"".join([*parts, raw[at:]]), "spans": [{"start": s, "end": e} for s, e in spans]})
        return pa.array(out, kind)

    return remove


def repeats(df: DataFrame, depth: int = DEPTH, keep: str = "none", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Links from documents to runs of repeated bytes: ``id``, ``mark`` (hash of the text), ``runs``."""
    if depth <= GRAM or keep not in ("none", "first"):
        raise ValueError(f"depth must exceed {GRAM}; keep is none or first")
    docs = _documents(df, key, text)
    found = materialise(docs.select("id", "text").mapInArrow(_find_anchors(depth), "anchor long, id long, pos int"), "anchors")
    # Stored, so that its side of the join is a shuffle of its own and Spark can split a common anchor.
    twice = materialise(found.groupBy("anchor").count().where("count > 1").select("anchor"), "twice")
    # Places of repeated anchors by id; whether an id has one text or several makes no difference to what is found.
    places = found.join(twice, "anchor").groupBy("id").agg(F.collect_set("pos").alias("places"))
    known = places.withColumnRenamed("id", "key")
    marked = docs.join(known, F.col("id").eqNullSafe(F.col("key"))).select("id", "mark", "text", "places")
    stretches = materialise(marked.mapInArrow(_cut_stretches(depth), STRETCH), "stretches")
    added = stretches.where("n is not null").select("anchor", "name", "n", "first_id", "first_at", "bytes")
    crowded = materialise(added.groupBy("anchor").count().where(F.col("count") > CROWD).select("anchor"), "crowded")
    usual = added.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "name")
    flags = usual.mapInArrow(_match_groups(depth), FLAGS)
    if crowded.head(1):
        flags = flags.unionByName(_count_windows(added.join(crowded, "anchor", "left_semi"), depth))
    leads = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("at") == F.col("first_at"))
    at = stretches.where("n is null").select("anchor", "name", "id", "mark", "at").join(flags, ["anchor", "name"])
    runs = F.when(leads, F.col("rest")).otherwise(F.col("runs")) if keep == "first" else F.col("runs")
    placed = F.transform(runs, lambda r: F.struct((r["start"] + F.col("at")).alias("start"), (r["end"] + F.col("at")).alias("end")))
    return at.select("id", "mark", placed.alias("runs")).groupBy("id", "mark").agg(
        F.flatten(F.collect_set("runs")).alias("runs")
    )


def _documents(df: DataFrame, key: str, text: str) -> DataFrame:
    body = text_or_empty(text)
    return df.select(F.col(key).cast("long").alias("id"), body.alias("text"), F.xxhash64(body).alias("mark"))


def remove_repeats(
    df: DataFrame, depth: int = DEPTH, keep: str = "none", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id``, ``n_bytes``, ``kept`` (the remaining bytes) and ``spans`` (removed runs) of every row of df."""
    docs = _documents(df, key, text)
    runs = repeats(df, depth, keep, key, text).select(F.col("id").alias("key"), F.col("mark").alias("same"), "runs")
    joined = docs.join(runs, F.col("id").eqNullSafe(F.col("key")) & (F.col("mark") == F.col("same")), "left")
    cut = _remover()(F.when(F.col("runs").isNotNull(), F.col("text")), F.col("runs"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return joined.withColumn("cut", cut).select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.coalesce(F.col("cut.kept"), F.col("text").cast("binary")).alias("kept"), F.coalesce(F.col("cut.spans"), none).alias("spans"),
    )
