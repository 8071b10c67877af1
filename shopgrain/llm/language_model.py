"""Log-bilinear language model, trained in numpy by noise-contrastive estimation, and unigram scores.

Tokens are words between ASCII white space (A-Z as a-z) and one end for each text. All training tokens are
counted. What the model predicts from the two units before are units: the end, every word seen ``LEAST`` times
that is among the ``FREQUENT`` most frequent, and buckets of all other words by their last three bytes; their
number grows with the words of the corpus. Units of like frequency form classes, about the root of the units
many, and P(unit) = P(class) P(unit in its class), both softmaxes of (A r1 + B r2) . q + b. A word of a bucket
has the bucket's probability times its own share of it, (c + 0.5) / (n + 0.5 (v + 1)), with one share for all
words of the bucket never seen.

Trainers take the training texts where they lie, and weights are averaged after each round.

The ``FREQUENT`` most frequent tokens travel to the tasks; rarer ones are joined with the counts by shuffle.

Defined results: a null or empty text is its end alone; rows with a null id are not held out; without any
training token all units are equally likely and base scores are 0; repeated rows get a score each; an
empty table gives no rows; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import slices, text_or_empty
from shopgrain.operators.checkpoints import materialise

FREQUENT = 100_000
#: How often a word must be seen for a unit of its own, words that share a bucket at least, and most buckets.
LEAST, SHARING, BUCKETS = 8, 16, 4096
#: The unit before a text; others follow by frequency.
START = 0
DIMS, NOISE, WITHIN, BATCH, RATE, ROUNDS, TRAINERS, SEED = 24, 64, 4, 2048, 0.1, 4, 8, 11
#: Tokens that are trained on at least, by repeated passes, and most passes; tokens of a trainer's part.
LEAST_DRAWS, MOST_PASSES, PART = 8_000_000, 24, 1 << 24
_BLOCK = 1 << 16
_BATCH_BYTES, _HELD = 1 << 20, 150_000
#: Numbers of a block that stays in a core's cache.
_CACHED = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LOWERED = np.frombuffer(_LOWER, np.uint8)
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: The table of CRC-32: what a byte makes of the checksum before it.
_CRC = np.array([zlib.crc32(bytes([b ^ 255])) ^ 0xFF000000 for b in range(256)], np.uint32)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_LOWER).split()  # bytes: ASCII white space only


def parsed(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the number of each word's entry there, and how many words each text has."""
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    packed = np.cumsum(inside, dtype=np.int32)
    ends = np.append(packed[starts] - 1, packed[-1:] if len(packed) else 0).astype(np.int32)
    found = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(_LOWERED[data[inside]])]
    ).dictionary_encode()
    upto = np.searchsorted(starts, offsets)
    return found.dictionary, found.indices.to_numpy(), np.diff(upto)


def count_tokens(texts: DataFrame) -> DataFrame:
    """``token`` (empty for the end) and ``n`` over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0
        for batch in batches:
            for part in slices(batch["text"], _BATCH_BYTES):
                distinct, at, _ = parsed(part)
                held.append(pa.table({"token": distinct, "n": np.bincount(at, minlength=len(distinct)).astype(np.int64)}))
                size, ends = size + len(distinct), ends + len(part)
                if size > 2 * _HELD:
                    held, size = [merged := _summed(held)], len(merged)
                    if size > _HELD:
                        yield from _counted(merged)
                        held, size = [], 0
        held.append(pa.table({"token": pa.array([b""], pa.binary()), "n": pa.array([ends], pa.int64())}))
        yield from _counted(_summed(held))

    counts = texts.select("text").mapInArrow(count, "token string, n long")
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


def _summed(counts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(counts).group_by("token").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})


def _counted(counts: pa.Table) -> list[pa.RecordBatch]:
    return counts.set_column(0, "token", counts["token"].cast(pa.string())).to_batches()


def bucket(word: bytes, buckets: int) -> int:
    return zlib.crc32(word[-3:]) % buckets


def buckets_of(words: pa.Array, buckets: int) -> np.ndarray:
    """``bucket`` of every word of an array without nulls."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data, size, ends = np.frombuffer(words.buffers()[2] or b"", np.uint8), np.diff(offsets), offsets[1:]
    crc = np.full(len(words), 0xFFFFFFFF, np.uint32)
    for back in (3, 2, 1):
        there = np.flatnonzero(size >= back)
        before = crc[there]
        crc[there] = _CRC[(before ^ data[ends[there] - back]) & 255] ^ (before >> 8)
    return (~crc).astype(np.int64) % buckets


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent tokens, bounded by ``FREQUENT``, the units, and totals over all training tokens."""

    tokens: pa.Array  # in the order of the arrays n and unit
    n: np.ndarray
    unit: np.ndarray
    end: int  # its unit
    bucket_unit: np.ndarray
    bucket_of: np.ndarray  # by unit; -1 for the end and words with a unit of their own
    within: np.ndarray  # smoothed occurrences of each bucket's words
    mass: np.ndarray  # occurrences by unit
    total: int
    distinct: int
    ends: int

    @classmethod
    def of(cls, counts: DataFrame) -> Vocabulary:
        total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        known = counts.where("token <> ''")
        rows = _most_frequent(known, FREQUENT)
        ends = counts.where("token = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        buckets = max(1, min(BUCKETS, distinct // SHARING))
        last = F.crc32(F.substring(F.col("token").cast("binary"), -3, 3)) % buckets
        n, v = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for r in known.groupBy(last.alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
            n[r["b"]], v[r["b"]] = r["n"], r["v"]
        tokens, seen = [r["token"].encode() for r in rows], np.array([r["n"] for r in rows], np.int64)
        own = int((seen >= LEAST).sum())
        of = np.array([bucket(w, buckets) for w in tokens], np.int64)
        np.subtract.at(n, of[:own], seen[:own])
        np.subtract.at(v, of[:own], 1)
        mass = np.concatenate(([ends], seen[:own], n))
        order = np.argsort(-mass, kind="stable")
        unit = np.empty(len(mass), np.int64)
        unit[order] = 1 + np.arange(len(mass))
        bucket_of = np.full(len(mass) + 1, -1)
        bucket_of[unit[1 + own :]] = np.arange(buckets)
        return cls(
            pa.array(tokens, pa.binary()), seen, np.append(unit[1 : 1 + own], unit[1 + own + of[own:]]),
            int(unit[0]), unit[1 + own :], bucket_of, n + 0.5 * (v + 1), np.append(0, mass[order]),
            total, distinct, ends,
        )

    @property
    def size(self) -> int:
        return len(self.mass)

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def share(self) -> np.ndarray:
        """log10 of each frequent token's part of its unit."""
        of = self.bucket_of[self.unit]
        return np.where(of < 0, 0.0, np.log10((self.n + 0.5) / self.within[of]))

    def places(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of some words their places in the arrays (-1: not there), and their buckets."""
        place = pc.index_in(distinct, value_set=self.tokens).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        buckets, rare = np.full(len(place), -1), np.flatnonzero(place < 0)
        buckets[rare] = buckets_of(distinct.take(pa.array(rare)), len(self.within))
        return place, buckets

    def triples(self, units: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """The two units before every token of some texts, ends included, its unit, and its text."""
        long = counts + 1
        doc, after = np.repeat(np.arange(len(counts)), long), np.cumsum(long)
        target = np.empty(len(doc), np.int64)
        target[after - 1] = self.end
        word = np.ones(len(doc), bool)
        word[after - 1] = False
        target[word] = units
        rank = np.arange(len(doc)) - (after - long)[doc]
        one = np.where(rank > 0, np.roll(target, 1), START)
        two = np.where(rank > 1, np.roll(target, 2), START)
        return two, one, target, doc

    def units(self, place: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Units of words by place or else bucket."""
        return np.where(place < 0, self.bucket_unit[buckets], np.append(self.unit, 0)[place])


def _most_frequent(counts: DataFrame, most: int) -> list:
    """Tokens above a frequency, in order, ``most`` at most; only these come to the driver.

    The frequency is found on a histogram of logarithms, of a few thousand rows however large the table.
    """
    level = F.floor(F.log2("n") * 64)
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("tokens")).collect()
    above, cut = 0, None
    for r in sorted(sizes, key=lambda r: -r["level"]):
        if above + r["tokens"] > most:
            break
        above, cut = above + r["tokens"], r["level"]
    if cut is None:
        return []
    return sorted(counts.where(level >= cut).collect(), key=lambda r: (-r["n"], r["token"]))


def cuts(p: np.ndarray) -> np.ndarray:
    """First units of the classes, and the end of the last: like sums of the roots of probabilities.

    So frequent units stand in small classes, and the work for a token grows with the root of the units.
    """
    upto = np.cumsum(np.sqrt(p[1:]))
    wanted = math.ceil(math.sqrt(len(p) / 3))
    middle = (upto - np.sqrt(p[1:]) / 2) / max(upto[-1], 1e-300)
    return np.append(1 + np.unique((middle * wanted).astype(np.int64), return_index=True)[1], len(p))


def _add_rows(at: np.ndarray, *weights: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """AdaGrad for the rows ``at``, which may repeat: of each of some weights, their sums of squares and gradients."""
    order = np.argsort(at)
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    at, size = at[first], np.diff(np.append(first, len(at)))
    # Only rows that repeat are summed.
    many = np.flatnonzero(size > 1)
    rows, starts = order[np.repeat(size > 1, size)], np.cumsum(size[many]) - size[many]
    for values, seen, grad in weights:
        total = grad.take(order[first], axis=0)
        if len(many):
            total[many] = np.add.reduceat(grad.take(rows, axis=0), starts, axis=0)
        scale = seen.take(at, axis=0)
        scale += total * total
        seen[at] = scale
        np.sqrt(scale, out=scale)
        total /= scale
        total *= np.float32(RATE)
        total += values.take(at, axis=0)
        values[at] = total


def _chosen(h: np.ndarray, weights: np.ndarray, at: np.ndarray, length: np.ndarray, reach: float, level: float) -> np.ndarray:
    """Log-softmax of one entry of each row of h times weights; no product is beyond ``length`` of h times reach + level."""
    out, ones = np.empty(len(h), np.float32), np.ones(len(weights), np.float32)
    rows = max(64, _CACHED // len(weights))
    for i in range(0, len(h), rows):
        s = h[i : i + rows] @ weights.T
        if length[i : i + rows].max() * reach + level >= 80:  # the exponential may overflow, or all be 0
            s -= s.max(1, keepdims=True)
        mine = s[np.arange(len(s)), at[i : i + rows]]
        out[i : i + rows] = mine - np.log(np.exp(s, out=s) @ ones)
    return out


def _log_softmax(s: np.ndarray) -> np.ndarray:
    s -= s.max(1, keepdims=True)
    return s - np.log(np.exp(s).sum(1, keepdims=True))


@dataclass
class LogBilinear:
    """Weights for ``size`` units in classes that start at ``first``; all in one flat array, to be sent and averaged."""

    size: int
    flat: np.ndarray
    first: np.ndarray

    @classmethod
    def new(cls, size: int, bias: np.ndarray) -> LogBilinear:
        """At first each unit has the probability that its bias says, in any context."""
        rng = np.random.default_rng(SEED)
        p, near = np.append(0, np.exp(bias[1:])), np.eye(DIMS).ravel()
        first = cuts(p)
        classes = np.log(np.add.reduceat(p, first[:-1]))
        parts = (
            rng.normal(0, 0.1, size * DIMS), rng.normal(0, 0.1, size * DIMS), near, near * 0.5, bias,
            rng.normal(0, 0.1, len(classes) * DIMS), classes,
        )
        return cls(size, np.concatenate(parts).astype(np.float32), first)

    def parts(self, flat: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Views: vectors of contexts and of targets, the two matrices, biases, and classes' vectors and biases."""
        n, d, k = self.size * DIMS, DIMS * DIMS, len(self.first) - 1
        at = np.cumsum([n, n, d, d, self.size, k * DIMS])
        r, q, a, b, bias, qc, bc = np.split(self.flat if flat is None else flat, at)
        return r.reshape(-1, DIMS), q.reshape(-1, DIMS), a.reshape(DIMS, DIMS), b.reshape(DIMS, DIMS), bias, qc.reshape(-1, DIMS), bc

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """To be sent: vectors of units in half precision, all else in full."""
        n = 2 * self.size * DIMS
        return self.flat[:n].astype(np.float16), self.flat[n:]

    @classmethod
    def unpacked(cls, size: int, packed: tuple[np.ndarray, np.ndarray], first: np.ndarray) -> LogBilinear:
        return cls(size, np.concatenate([x.astype(np.float32) for x in packed]), first)

    def log10_rows(self, contexts: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of all units after each context; nothing is followed by a start."""
        r, q, a, b, bias, qc, bc = self.parts()
        h = r[contexts % self.size] @ a + r[contexts // self.size] @ b
        out, classes = np.full((len(h), self.size), -np.inf), _log_softmax(h @ qc.T + bc)
        for c, (x, y) in enumerate(zip(self.first[:-1], self.first[1:], strict=True)):
            out[:, x:y] = classes[:, c : c + 1] + _log_softmax(h @ q[x:y].T + bias[x:y])
        return out / math.log(10)

    def scorer(self):
        """A function: log10 probability of each target after its two units before."""
        r, q, a, b, bias, qc, bc = self.parts()
        # Biases go along as one more dimension.
        ra, rb, first = np.pad(r @ a, ((0, 0), (0, 1)), constant_values=1), np.pad(r @ b, ((0, 0), (0, 1))), self.first
        units, classes = np.column_stack((q, bias)), np.column_stack((qc, bc))
        levels = [float(abs(x).max(initial=0)) for x in (bc, bias)]
        reach_classes = math.sqrt(np.square(qc).sum(1).max())
        reaches = np.sqrt(np.maximum.reduceat(np.square(q).sum(1), first[:-1])).tolist()
        class_of = np.repeat(np.arange(len(classes)), np.diff(first)).astype(np.uint16)

        def logs(two: np.ndarray, one: np.ndarray, target: np.ndarray) -> np.ndarray:
            c = class_of[target - first[0]]
            order = np.argsort(c, kind="stable")
            t, c = target[order], c[order]
            h = ra.take(one[order], axis=0)
            h += rb.take(two[order], axis=0)
            length = np.sqrt(np.einsum("ij,ij->i", h[:, :-1], h[:, :-1]))
            out = _chosen(h, classes, c, length, reach_classes, levels[0])
            edges = np.append(0, np.cumsum(np.bincount(c, minlength=len(classes))))
            for k in np.flatnonzero((np.diff(edges) > 0) & (np.diff(first) > 1)):
                i, j = edges[k], edges[k + 1]
                out[i:j] += _chosen(h[i:j], units[first[k] : first[k + 1]], t[i:j] - first[k], length[i:j], reaches[k], levels[1])
            back = np.empty(len(t))
            back[order] = out
            return back / math.log(10)

        return logs

    def trainer(self, noise: np.ndarray):
        """A function that makes one step over some triples: noise of classes is drawn, that in a class is its others."""
        weights, first = self.parts(), self.first
        r, q, a, b, bias, qc, bc = weights
        sr, sq, sa, sb, sbias, sqc, sbc = self.parts(np.full_like(self.flat, 1e-8))
        classes = np.add.reduceat(noise, first[:-1])
        upto = np.cumsum(classes)
        class_offset = np.log(NOISE * classes).astype(np.float32)
        in_class = np.append(1.0, noise[1:] / np.repeat(classes, np.diff(first)))
        offset = np.log(WITHIN * in_class.clip(1e-30)).astype(np.float32)

        def step(two: np.ndarray, one: np.ndarray, target: np.ndarray, rng) -> None:
            order = np.argsort(target)
            t, c1, c2 = target[order], one[order], two[order]
            n, c = len(t), np.searchsorted(first, t, side="right") - 1
            r1, r2 = r.take(c1, axis=0), r.take(c2, axis=0)
            h = r1 @ a + r2 @ b
            # The chance of being data, taken from what is, and of what is noise; the batch shares its noise.
            drawn = np.searchsorted(upto, rng.random(NOISE) * upto[-1], side="right").clip(0, len(upto) - 1)
            mine, others = qc.take(c, axis=0), qc.take(drawn, axis=0)
            true = (1 - _chance(_dots(h, mine) + bc[c] - class_offset[c])) / n
            false = h @ others.T
            false += bc[drawn] - class_offset[drawn]
            false = _chance(false)
            false *= np.float32(-1 / n)
            back = true[:, None] * mine
            back += false @ others
            # Within a class the noise of a triple is the target of others of the batch in its class.
            edges = np.searchsorted(c, np.arange(len(first)))
            sizes = np.diff(edges)
            start, size = edges[c], sizes[c]
            vectors, place = q.take(t, axis=0), np.arange(n) - start
            level = (bias[t] - offset[t]).astype(np.float32)
            alone = (size == 1) | (first[c + 1] - first[c] == 1)
            own = np.where(alone, np.float32(0), (1 - _chance(_dots(h, vectors) + level)) / n)
            back += own[:, None] * vectors
            grad, grad_bias = own[:, None] * h, own.copy()
            for _ in range(WITHIN):
                shift = (1 + (rng.random(len(first))[:-1] * (sizes - 1)).astype(np.int64))[c]
                other = place + shift
                other -= size * (other >= size)
                other += start
                u = vectors.take(other, axis=0)
                f = np.where(alone, np.float32(0), _chance(_dots(h, u) + level[other]) / np.float32(-n))
                u *= f[:, None]
                back += u
                at = place - shift  # whose noise this triple's target is
                at += size * (at < 0)
                at += start
                theirs, g = h.take(at, axis=0), f[at]
                theirs *= g[:, None]
                grad += theirs
                grad_bias += g
            ga, gb = r1.T @ back, r2.T @ back
            class_grad, context_grad = np.empty((n + NOISE, DIMS), np.float32), np.empty((2 * n, DIMS), np.float32)
            np.multiply(true[:, None], h, out=class_grad[:n])
            np.matmul(false.T, h, out=class_grad[n:])
            np.matmul(back, a.T, out=context_grad[:n])
            np.matmul(back, b.T, out=context_grad[n:])
            _add_rows(
                np.concatenate((c, drawn)), (qc, sqc, class_grad), (bc, sbc, np.concatenate((true, false.sum(0))))
            )
            _add_rows(t, (q, sq, grad), (bias, sbias, grad_bias))
            _add_rows(np.concatenate((c1, c2)), (r, sr, context_grad))
            for w, s, g in ((a, sa, ga), (b, sb, gb)):
                s += g * g
                w += np.float32(RATE) * g / np.sqrt(s)

        return step


def _chance(logit: np.ndarray) -> np.ndarray:
    """The logistic function; ``logit`` is overwritten."""
    np.negative(logit, out=logit)
    np.minimum(logit, 80, out=logit)
    np.exp(logit, out=logit)
    logit += 1
    return np.reciprocal(logit, out=logit)


def _dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, y)


def passes(total: int) -> tuple[int, int]:
    """Parts that the texts are cut into, one for each round, and passes over the part in a round.

    Every text is passed over: once where there are many tokens, and in every round where there are few.
    """
    if total >= LEAST_DRAWS:
        return ROUNDS, 1
    return 1, min(MOST_PASSES, -(-LEAST_DRAWS // max(total, 1))) // ROUNDS or 1


def fit(texts: DataFrame, vocabulary) -> LogBilinear:
    """Train on all tokens: every trainer passes over its part in full, and the weights are averaged each round."""
    v: Vocabulary = vocabulary.value
    noise = (v.mass + 0.5 * (np.arange(v.size) != START)) / (v.mass.sum() + 0.5 * (v.size - 1))
    model = LogBilinear.new(v.size, np.log(np.maximum(noise, 1e-12)))
    if not v.total:
        return model
    for step in range(ROUNDS):
        moved = moves(texts, vocabulary, model, noise, step)
        flat = model.flat.copy()
        for r in moved.groupBy("block").applyInArrow(_average, "block int, moved binary").collect():
            by = np.frombuffer(r["moved"], np.float32)
            flat[r["block"] * _BLOCK : r["block"] * _BLOCK + len(by)] += by
        model = LogBilinear(v.size, flat, model.first)
    return model


def moves(texts: DataFrame, vocabulary, model: LogBilinear, noise: np.ndarray, step: int) -> DataFrame:
    """From each trainer of a round its tokens and how far the weights moved, in blocks."""
    total = vocabulary.value.total
    parts, again = passes(total)
    start = texts.sparkSession.sparkContext.broadcast(model.packed()) if step else None  # tasks can make the first
    mine = texts.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == step % parts)
    return mine.coalesce(max(TRAINERS, total // PART)).mapInArrow(
        _trainer(vocabulary, start, model.first, noise, step, again), "block int, trainer int, n long, moved binary"
    )


def _trainer(vocabulary, start, first: np.ndarray, noise: np.ndarray, step: int, again: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocabulary.value
        trainer = TaskContext.get().partitionId()
        if start is None:
            own = LogBilinear.new(v.size, np.log(np.maximum(noise, 1e-12)))
        else:
            own = LogBilinear.unpacked(v.size, start.value, first)
        before, rng = own.flat.copy(), np.random.default_rng([SEED, step, trainer])
        forward, n, held = own.trainer(noise), 0, []

        def run(triples: tuple[np.ndarray, ...]) -> None:
            order = rng.permutation(len(triples[0]))
            for i in range(0, len(order), BATCH):
                forward(*(x[order[i : i + BATCH]] for x in triples), rng)

        for batch in batches:
            for part in slices(batch["text"], _BATCH_BYTES):
                distinct, at, counts = parsed(part)
                triples = v.triples(v.units(*v.places(distinct))[at], counts)[:3]
                n += len(triples[0])
                if again == 1:
                    run(triples)
                else:  # fewer than LEAST_DRAWS in all
                    held.append(triples)
        for _ in range(again if held else 0):
            run(tuple(np.concatenate(x) for x in zip(*held, strict=True)))
        moved = (own.flat - before).astype(np.float16)
        for i in range(0, len(moved) if n else 0, _BLOCK):
            yield pa.RecordBatch.from_pydict(
                {"block": [i // _BLOCK], "trainer": [trainer], "n": [n], "moved": [moved[i : i + _BLOCK].tobytes()]},
                pa.schema([("block", pa.int32()), ("trainer", pa.int32()), ("n", pa.int64()), ("moved", pa.binary())]),
            )

    return train


def _average(key, rows):
    """How far each weight of a block moved, on average over the tokens of the trainers that moved it."""
    total = weight = 0
    for r in sorted(rows.to_pylist(), key=lambda r: r["trainer"]):
        by = np.frombuffer(r["moved"], np.float16).astype(np.float64)
        total, weight = total + by * r["n"], weight + (by != 0) * r["n"]
    moved = (total / np.maximum(weight, 1)).astype(np.float32)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "moved": pa.array([moved.tobytes()], pa.binary())})


_RARE = pa.list_(pa.struct([("token", pa.string()), ("tf", pa.int32()), ("within", pa.float64())]))
_PARTIAL = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rare", _RARE)])
PARTIAL = "n_tokens:long,n_known:long,base:double,score:double,rare:array<struct<token:string,tf:int,within:double>>"


def _partial(vocabulary, model, first: np.ndarray):
    """What a text's frequent tokens and units add up to, and its rare words with the size of their bucket."""

    @F.arrow_udf(f"struct<{PARTIAL}>")
    def partial(texts: pa.Array) -> pa.Array:
        v = vocabulary.value
        logs = LogBilinear.unpacked(v.size, model.value, first).scorer()
        base, share = np.append(v.base(v.n), 0.0), np.append(v.share(), 0.0)
        end = float(v.base(np.array([v.ends]))[0])
        out = []
        for part in slices(texts, 2 * _BATCH_BYTES):  # the words of each are looked up together
            distinct, at, counts = parsed(part)
            place, buckets = v.places(distinct)
            two, one, target, doc = v.triples(v.units(place, buckets)[at], counts)
            n, of = len(part), np.repeat(np.arange(len(part)), counts)

            def total(values: np.ndarray, n=n, of=of, at=at) -> np.ndarray:
                return np.bincount(of, values[at], n)

            # Rare words of each text, with how often they occur there.
            rare = np.flatnonzero(place[at] < 0)
            pairs, tf = np.unique(of[rare] * max(len(distinct), 1) + at[rare], return_counts=True)
            text_of, word = np.divmod(pairs, max(len(distinct), 1))
            entries = pa.StructArray.from_arrays(
                [distinct.take(pa.array(word)).cast(pa.string()), pa.array(tf, pa.int32()), pa.array(v.within[buckets[word]], pa.float64())],
                fields=list(_RARE.value_type),
            )
            ends = np.append(0, np.cumsum(np.bincount(text_of, minlength=n))).astype(np.int32)
            out.append(pa.StructArray.from_arrays(
                [
                    pa.array(counts + 1, pa.int64()), pa.array(total(place >= 0).astype(np.int64) + (v.ends > 0)),
                    pa.array(total(base[place]) + end),
                    pa.array(np.bincount(doc, logs(two, one, target), n) + total(share[place])),
                    pa.ListArray.from_arrays(pa.array(ends), entries).cast(_RARE),
                ],
                fields=list(_PARTIAL),
            ))
        return pa.concat_arrays(out) if out else pa.array([], _PARTIAL)

    return partial


def score(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, n_tokens, n_known, train_tokens, base_score and score of every row; learned where ``learn`` holds."""
    spark, body = df.sparkSession, text_or_empty(text)
    training = df.where(learn).select(body.alias("text"))
    counts = materialise(count_tokens(training), "token_counts")
    known = Vocabulary.of(counts)
    shared = spark.sparkContext.broadcast(known)
    model = fit(training, shared)
    weights = spark.sparkContext.broadcast(model.packed())
    rows = materialise(
        df.select(F.col(key).alias("id"), _partial(shared, weights, model.first)(body).alias("p")).select(
            F.monotonically_increasing_id().alias("row"), "id", "p.*"
        ),
        "partial_scores",
    )
    rare = rows.select("row", F.inline("rare")).join(counts, "token", "left")
    n, tf = F.coalesce("n", F.lit(0)), F.col("tf")
    added = rare.groupBy("row").agg(
        F.sum(F.when(n > 0, tf).otherwise(0)).alias("more"),
        F.sum(tf * F.log10((n + 0.5) / F.lit(known.total + 0.5 * (known.distinct + 1)))).alias("base_more"),
        F.sum(tf * F.log10((n + 0.5) / F.col("within"))).alias("score_more"),
    )
    return rows.drop("rare").join(added, "row", "left").select(
        "id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("score_more", F.lit(0.0))).alias("score"),
    )
