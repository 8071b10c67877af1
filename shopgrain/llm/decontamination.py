"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact containment.

An item is contained in a document if at least a share (0.8) of the item's distinct five-word shingles
occur in it. Items are partitioned by their number of shingles into classes that double. An item's sketch
is its least shingle hashes (bottom-k MinHash); k is set by the class, so that a document which contains
the share must contain several members of the sketch: of n shingles it can lack (1 - share) * n at most.
The search is therefore complete, for however long a document, where banded signatures would miss nearly
all: the Jaccard similarity of an item of 40 words and a document of 20,000 is about 0.002. Candidates
are verified on the shingles themselves.

Words are runs of ASCII letters and digits and of all signs beyond ASCII; A-Z count as a-z. A text with
fewer words than a shingle is one shingle of all its words; one without words contains nothing and is
contained in nothing.

Defined results: null texts are empty; repeated documents or items give repeated rows; an empty table
gives no rows; other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import slices, text_or_empty
from shopgrain.llm.rolling import ODD, mix, stretch_hashes

WIDTH, SHARE = 5, 0.8
#: Sketch members that a containing document must have at least, items searched in one pass, text hashed at a time.
EVIDENCE, PASS_ITEMS, BATCH_BYTES = 4, 20_000, 1 << 20
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def shingles(text: str, width: int = WIDTH) -> set[bytes]:
    words = _WORD.findall(text.encode("utf-8", "replace").translate(_LOWER))
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def shingle_hashes(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of some texts, and for each the place of its text; the same for equal shingles."""
    raw = [t.encode("utf-8", "replace").translate(_LOWER) for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    edge = np.diff(np.concatenate(([False], _IN_WORD[data], [False])).astype(np.int8))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = stretch_hashes(data, a, b)
    doc = np.searchsorted(ends, a, side="right")
    n = np.bincount(doc, minlength=len(texts))
    out = np.zeros(len(words), np.uint64)
    for k in range(min(width, len(words))):
        part = words[k:] * np.uint64(pow(ODD, 3 * k + 1, 1 << 64))
        same = doc[k:] == doc[: len(doc) - k]
        out[: len(part)] += np.where(same, part, np.uint64(0))
    rank = np.arange(len(words)) - (np.cumsum(n) - n)[doc]
    kept = rank <= np.maximum(n[doc] - width, 0)
    return mix(out[kept]), doc[kept]


def size_class(n: int) -> int:
    """The largest number of shingles in the item's size partition: the next power of two."""
    return 1 << max(0, (n - 1).bit_length())


@dataclass(frozen=True)
class Items:
    """Some items, bounded by ``PASS_ITEMS``: their shingles, and an index from sketch hashes to items."""

    ids: list
    shingles: list[set[bytes]]
    hashes: np.ndarray  # sorted; may repeat
    owner: np.ndarray  # the item of each
    needed: np.ndarray  # by item: members of its sketch that a containing document has
    least: np.ndarray  # by item: shingles that a containing document has
    marks: np.ndarray  # of the hashes' last 16 bits

    @classmethod
    def of(cls, rows: list, share: float, width: int) -> Items:
        ids, sets, hashes, owner, needed, least = [], [], [], [], [], []
        for r in rows:
            if own := shingles(r["text"], width):
                n, lack = len(own), math.floor((1 - share) * len(own) + 1e-9)
                sketch = np.unique(shingle_hashes([r["text"]], width)[0])
                sketch = sketch[: math.floor((1 - share) * size_class(n) + 1e-9) + EVIDENCE]
                hashes.append(sketch)
                owner.append(np.full(len(sketch), len(ids)))
                # Equal hashes of different shingles, were there any, only lower what is asked for.
                needed.append(max(1, len(sketch) - lack))
                least.append(n - lack)
                ids.append(r["id"])
                sets.append(own)
        hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(hashes, kind="stable")
        marks = np.zeros(1 << 16, bool)
        marks[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
        return cls(
            ids, sets, hashes[order], np.concatenate([np.zeros(0, np.int64), *owner])[order],
            np.array(needed, np.int64), np.array(least, np.int64), marks,
        )

    def candidates(self, texts: list[str], width: int) -> Iterator[tuple[int, int]]:
        """Pairs of a text and an item of which the text has enough of the sketch."""
        found, doc = shingle_hashes(texts, width)
        sizes = np.bincount(doc, minlength=len(texts))
        hit = np.flatnonzero(self.marks[(found & np.uint64(0xFFFF)).astype(np.int64)])
        found, doc = found[hit], doc[hit]
        a, b = np.searchsorted(self.hashes, found), np.searchsorted(self.hashes, found, side="right")
        times = b - a
        place = np.repeat(a - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        pairs = np.stack((np.repeat(doc, times), self.owner[place], place)).T
        pairs = np.unique(pairs, axis=0)[:, :2]  # a member counts once for a text
        pairs, members = np.unique(pairs, axis=0, return_counts=True)
        for (t, i), m in zip(pairs.tolist(), members.tolist(), strict=True):
            if m >= self.needed[i] and sizes[t] >= self.least[i]:
                yield t, i

    def verified(self, texts: list[str], share: float, width: int) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, the item's shingles and how many of them the text has, for every pair with the share."""
        last, own = None, set()
        for t, i in self.candidates(texts, width):
            if last != t:
                last, own = t, shingles(texts[t], width)
            n, shared = len(self.shingles[i]), len(self.shingles[i] & own)
            if shared >= share * n - 1e-9:
                yield t, i, n, shared




def contained(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", item_key: str = "item_id", text: str = "text",
    share: float = SHARE, width: int = WIDTH, pass_items: int = PASS_ITEMS,
) -> DataFrame:
    """``id``, ``item``, ``n_shingles`` of the item, ``n_shared`` and ``containment`` of every pair with the share.

    The documents are read in place, once for every ``pass_items`` items; only such a pass's items are
    sent to the tasks.
    """
    wanted = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("text"))
    kinds = wanted.schema["id"].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    found = [
        wanted.mapInArrow(_search(p, share, width), f"id {kinds[0]}, item {kinds[1]}, n_shingles long, n_shared long")
        for p in _passes(items, item_key, text, share, width, pass_items)
    ]
    return reduce(DataFrame.unionByName, found).withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def without(
    docs: DataFrame, items: DataFrame, *, item_key: str = "item_id", text: str = "text",
    share: float = SHARE, width: int = WIDTH, pass_items: int = PASS_ITEMS,
) -> DataFrame:
    """The rows of docs that contain no item, with all their columns."""
    for p in _passes(items, item_key, text, share, width, pass_items):
        docs = docs.where(~_tainted(p, share, width)(text_or_empty(text)))
    return docs


def _passes(items: DataFrame, item_key: str, text: str, share: float, width: int, pass_items: int) -> list:
    """Broadcast parts of the items, each of about ``pass_items``; at least one, which may be empty."""
    asked = items.select(F.col(item_key).alias("id"), text_or_empty(text).alias("text"))
    passes = max(1, math.ceil(asked.count() / pass_items))
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("id", "text"), F.lit(passes)))
    send = items.sparkSession.sparkContext.broadcast
    return [send(Items.of(asked.where(F.col("pass") == k).collect(), share, width)) for k in range(passes)]


def _tainted(index, share: float, width: int):
    @F.arrow_udf("boolean")
    def tainted(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts, BATCH_BYTES):
            hit = {t for t, *_ in index.value.verified(part.to_pylist(), share, width)}
            out += [t in hit for t in range(len(part))]
        return pa.array(out, pa.bool_())

    return tainted


def _search(index, share: float, width: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = index.value
        for batch in batches:
            start = 0
            for part in slices(batch["text"], BATCH_BYTES):
                rows = [
                    (start + t, items.ids[i], n, m) for t, i, n, m in items.verified(part.to_pylist(), share, width)
                ]
                if rows:
                    at, item, n, shared = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch["id"].take(pa.array(at)), pa.array(item), pa.array(n, pa.int64()), pa.array(shared, pa.int64())],
                        ["id", "item", "n_shingles", "n_shared"],
                    )
                start += len(part)

    return search
