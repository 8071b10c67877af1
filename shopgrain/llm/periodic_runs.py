"""Runs of repeated words, found by internal pattern matching.

A run is a stretch that has a smallest period q, is at least max(24, 3q) words long and can't be extended.
All documents of a part are searched at once, as one sequence of (document, word) numbers:

- Prefix doubling sorts the suffixes; after step k the rank of a place names its next 2^k words, so the
  places with the same block of 2^k words are one interval of the suffix array.
- A run of period q >= 8 holds an aligned dyadic block of 2^k words, 2^k <= q < 2^(k+1), whose copy lies q
  words on, inside the run; for q < 8 a block of 8 does. So each aligned block that occurs twice asks for its
  occurrences in the window behind it: range successor queries on a wavelet tree over the suffix array.
- Up to two occurrences in a window are candidates themselves. More form one arithmetic progression, as they
  overlap; its difference p is the period of the block. If a run has period q and not p, an end of the
  p-periodic stretch around the block must recur q words on, at the end of the stretch around the
  progression: the distances of left ends and of right ends are the only candidates.
- A candidate is extended both ways by longest common extensions over the ranks, which are exact.

A part of the texts is as large as ``BATCH_BYTES``, or one text; memory per word is a rank for each doubling
step until all suffixes of a document differ. Only documents in which a block of eight words occurs twice go
beyond the third step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopgrain.llm.common import columns_of, free_name, slices, text_or_empty

#: Shortest run in words and in periods, by the definition; text searched at once.
LEAST_WORDS, LEAST_PERIODS, BATCH_BYTES = 24, 3, 1 << 20
#: The smallest dyadic block: the largest that every run of a shorter period is sure to hold, aligned, with its copy.
BLOCK = 8
RUNS = "array<struct<start:long,length:long,period:long>>"


def _ranks(first: np.ndarray, steps: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array and, for k = 0, 1, ..., the ranks of the next 2^k numbers of every place.

    A rank is the number of places whose block sorts before. Doubling ends when all ranks differ, or after
    ``steps``. Blocks that reach over a document's end differ from all others, as its end sorts first there;
    ``first`` numbers the words so that different documents share none.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    key = first[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[order] = head
    out, size = [rank], 1
    while steps is None or len(out) < steps:
        # Slots whose place shares its rank with a neighbour are sorted anew, all others stay.
        lone = new.copy()
        lone[:-1] &= new[1:]
        slots = np.flatnonzero(~lone)
        if not len(slots):
            break
        places = order[slots]
        after = np.zeros(len(places), np.int64)
        inside = places + size < n
        after[inside] = rank[places[inside] + size].astype(np.int64) + 1
        both = rank[places].astype(np.int64) * (n + 1) + after
        by = np.argsort(both, kind="stable")
        both = both[by]
        order[slots] = places[by]
        differs = np.ones(len(slots), bool)
        differs[1:] = both[1:] != both[:-1]
        new[slots] = differs
        rank = rank.copy()
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(differs, np.arange(len(slots)), 0))]
        out.append(rank)
        size *= 2
    return order, out


class WaveletTree:
    """Levels of bits over a sequence: how many values of an interval are below a bound, and its k-th smallest value."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int64))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Of each interval [left, right) the number of values < bound."""
        found = np.zeros(len(left), np.int64)
        beyond = bound >= 1 << self.bits
        found[beyond] = (right - left)[beyond]
        left, right = left.copy(), right.copy()
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ((bound >> (self.bits - 1 - i)) & 1).astype(bool)
            l1, r1 = ones[left], ones[right]
            found += np.where(one & ~beyond, (right - left) - (r1 - l1), 0)
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        return found

    def kth(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Of each interval the value with k smaller ones before it."""
        value, left, right, k = np.zeros(len(left), np.int64), left.copy(), right.copy(), k.copy()
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            l1, r1 = ones[left], ones[right]
            small = (right - left) - (r1 - l1)
            one = k >= small
            value += np.where(one, 1 << (self.bits - 1 - i), 0)
            k -= np.where(one, small, 0)
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        return value


def _forward(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a on equal those from b on, for a < b in one document."""
    n, length = len(ranks[0]), np.zeros(len(a), np.int64)
    for k in reversed(range(len(ranks))):
        at = b + length
        ok = at < n
        ok[ok] = ranks[k][(a + length)[ok]] == ranks[k][at[ok]]
        length += ok.astype(np.int64) << k
    return length


def _backward(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before a equal those before b."""
    length = np.zeros(len(a), np.int64)
    for k in reversed(range(len(ranks))):
        at = a - length - (1 << k)
        ok = at >= 0
        ok[ok] = ranks[k][at[ok]] == ranks[k][(b - length - (1 << k))[ok]]
        length += ok.astype(np.int64) << k
    return length


def _candidates(order: np.ndarray, ranks: list[np.ndarray], doc: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and the periods that the words there may have."""
    n, tree = len(order), WaveletTree(order - begin[doc[order]])
    places, periods = [], []
    for k in range(BLOCK.bit_length() - 1, len(ranks)):
        size, rank = 1 << k, ranks[k].astype(np.int64)
        starts = np.arange(0, n, size)
        counts = np.bincount(rank, minlength=n)
        starts = starts[counts[rank[starts]] > 1]
        if not len(starts):
            continue
        left = rank[starts]
        right = left + counts[left]
        own = starts - begin[doc[starts]]
        # The interval holds places of one document only, so its values are places in that document.
        low, high = own + (1 if size == BLOCK else size), own + 2 * size
        from_, to = tree.below(left, right, low), tree.below(left, right, high)
        found = to - from_
        few = found > 0 if size == BLOCK else (found > 0) & (found < 3)
        which = np.repeat(np.flatnonzero(few), found[few])
        nth = np.arange(len(which)) - np.repeat(np.cumsum(found[few]) - found[few], found[few])
        places.append(starts[which])
        periods.append(tree.kth(left[which], right[which], from_[which] + nth) - own[which])
        many = np.flatnonzero((found >= 3) & (size > BLOCK))
        if len(many):
            a, b = left[many], right[many]
            one = tree.kth(a, b, from_[many]) - own[many]
            p = tree.kth(a, b, from_[many] + 1) - own[many] - one
            here = starts[many]
            there = here + one
            ends = there + _forward(ranks, there, there + p) - here - _forward(ranks, here, here + p)
            heads = there - _backward(ranks, there, there + p) - here + _backward(ranks, here, here + p)
            for distance in (ends, heads):
                good = (distance >= size) & (distance < 2 * size)
                places.append(here[good])
                periods.append(distance[good])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and period of all runs, by document, start and period.

    ``words`` are numbers of the words of all documents one after another, ``counts`` how many each has.
    """
    none = (np.empty(0, np.int64),) * 4
    numbers = np.arange(len(counts))
    doc = np.repeat(numbers, counts)
    short = counts < LEAST_WORDS
    steps = BLOCK.bit_length()
    keep = np.zeros(len(counts), bool)
    if not short.all():
        # First the documents in which an aligned block of eight words occurs twice.
        in_long = ~short[doc]
        named = doc[in_long] * (int(words.max()) + 1) + words[in_long]
        _, ranks = _ranks(named, steps)
        if len(ranks) == steps:
            of = doc[in_long]
            twice = np.bincount(ranks[-1], minlength=len(of))[ranks[-1][::BLOCK]] > 1
            keep[of[::BLOCK][twice]] = True
    if not keep.any():
        return none
    chosen = np.flatnonzero(keep)
    inside = keep[doc]
    words, sizes = words[inside], counts[chosen]
    doc = np.repeat(np.arange(len(chosen)), sizes)
    begin = np.cumsum(sizes) - sizes
    order, ranks = _ranks(doc * (int(words.max()) + 1) + words)
    place, period = _candidates(order, ranks, doc, begin)
    # The copy lies in the same document, as blocks of different documents differ.
    start = place - _backward(ranks, place, place + period)
    end = place + period + _forward(ranks, place, place + period)
    good = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, end, period = start[good], end[good], period[good]
    # Multiples of the smallest period give the same stretch.
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    start, end, period = start[by], end[by], period[by]
    of = doc[start]
    return chosen[of], start - begin[of], end - start, period


def _word_numbers(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of texts, between blanks and the signs from tab to carriage return, and equal numbers for equal words."""
    words = [t.encode().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = [w for ws in words for w in ws]
    return words, pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64), counts


def periodic_runs(df: DataFrame, text: str = "text", to: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """All columns of df, its texts' runs (start, length, period; by start, then period) and the collapsed texts.

    A collapsed text keeps each run's first period, and the words outside runs, joined by one blank. Defined
    results: a null or empty text, or one of blanks, has no run and an empty collapsed text; texts of any length
    are searched whole; repeated rows give repeated results; an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices(batch.columns[-1], BATCH_BYTES):
                rows = batch.slice(done, len(part))
                done += len(part)
                words, numbers, counts = _word_numbers(part.to_pylist())
                doc, start, length, period = find_runs(numbers, counts)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=len(part)))).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"]),
                )
                # Words that any run drops: a running sum of where dropping starts and ends.
                first = np.cumsum(counts) - counts
                change = np.zeros(len(numbers) + 1, np.int64)
                np.add.at(change, first[doc] + start + period, 1)
                np.add.at(change, first[doc] + start + length, -1)
                kept = np.cumsum(change[:-1]) == 0
                for d in np.unique(doc).tolist():
                    words[d] = [w for w, k in zip(words[d], kept[first[d] : first[d] + counts[d]], strict=True) if k]
                texts = pa.array([b" ".join(ws).decode() for ws in words], pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], lists, texts], inner)

    runs = df.sparkSession.createDataFrame([], f"r {RUNS}").schema[0].dataType
    schema = StructType([*df.schema.fields, StructField(free_name(df, to), runs), StructField(free_name(df, collapsed), StringType())])
    inner = [f"c{i}" for i in range(len(schema))]
    plain = StructType([StructField(n, f.dataType) for n, f in zip(inner, schema, strict=True)])
    rows = df.select(*columns_of(df), text_or_empty(text).alias("body")).toDF(*inner[: len(df.columns)], "body")
    return rows.mapInArrow(run, plain).toDF(*schema.fieldNames())
