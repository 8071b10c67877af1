"""Token sequences of a fixed size, filled by vector best fit.

``cut`` turns texts into token ids and cuts what is longer than a sequence. ``pack`` gives every piece a
sequence and an offset there. A piece asks for a vector: its tokens, one document, and its attention cost
(tokens squared). A sequence has a capacity in each of the three; a piece goes to the open sequence that can
take it under all of them and is left with the least weighted residual norm (or, by choice, whose residual
has the largest weighted dot product with the piece), longest pieces first.

A piece's vector follows from its length, so pieces of one length are alike, and so are sequences with the
same content. The choice is made for groups of them: the driver sees how many pieces there are of each
length, never more rows than a sequence has tokens, and makes a plan of steps "so many pieces of this length
into this range of sequences at this offset". Each step uses up a length or a group of sequences. Where a
piece stands among those of its length comes from counts by task and a running sum over them; no task
gathers the pieces of a length, however many rows one length has.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from shopgrain.llm.common import columns_of, free_name, slices, text_or_empty
from shopgrain.operators.checkpoints import materialise

#: Text per table of words, and words kept from one table for the next (as many again are kept if asked for lately).
BATCH_BYTES, KEPT_WORDS = 2 << 20, 150_000

# The normaliser and splitter that the short way for plain words stands for.
_PLAIN_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PLAIN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: What a byte is: white space, a letter, a digit, another sign, or none that the short way takes.
_BLANK, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_LEAD = 0xC3  # first byte of the signs from U+00C0 to U+00FF; the second byte tells them apart


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kinds of the bytes of ASCII, and of the second bytes after ``_LEAD``.

    An apostrophe may start a contraction and "<" an added token, so words with them are not plain.
    """
    one, two = np.full(256, _OTHER, np.uint8), np.full(256, _OTHER, np.uint8)
    one[33:127] = _SIGN
    for first, last in ((48, 58), (65, 91), (97, 123)):
        one[first:last] = _DIGIT if first == 48 else _LETTER
    one[[39, 60]] = _OTHER
    one[[32, 9, 10, 11, 12, 13]] = _BLANK
    two[0x80:0xC0] = _LETTER
    two[[0x97, 0xB7]] = _SIGN  # the signs of multiplication and division
    return one, two


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in the vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Token ids of words, worked out once each.

    White space is dropped by the tokenizer and no token reaches over it, so a text's ids are those of its
    words. Words of plain signs are cut into runs of letters, single digits and runs of signs, as the splitter
    does, and the library's merges are asked for each run; all others, and words of tokenizers with another
    normaliser or splitter, go through the whole library.
    """

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            said = json.load(f)
        split, *rest = (said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if split.get("type") != "Split" or not split.get("invert") or "\\s" not in json.dumps(split["pattern"]):
            raise ValueError("this tokenizer does not drop white space; words can't be encoded alone")
        special = [t["content"] for t in said.get("added_tokens", ())]
        if any(re.search(r"\s", t) for t in special):
            raise ValueError("an added token of this tokenizer holds white space")
        plain = (
            (said.get("normalizer") or {}).get("normalizers") == _PLAIN_NORMALIZER
            and split["pattern"] == {"Regex": _PLAIN_SPLIT}
            and [r["type"] for r in rest] == ["ByteLevel"] and not rest[0]["use_regex"]
            and not rest[0]["add_prefix_space"] and not said["model"].get("dropout")
            and all("<" in t for t in special)
        )
        self.one, self.two = _kinds()
        if not plain:
            self.one[self.one != _BLANK] = _OTHER
        self.signs = _byte_signs()
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, words: Sequence[bytes], plain: Sequence[bool]) -> list[bytes]:
        """Of each word the ids, four bytes each, little end first."""
        if len(self.new) > KEPT_WORDS:
            self.new, self.old = {}, self.new
        known, slow = self.new, []
        tokenize = self.tokenizer.model.tokenize
        for word, short in zip(words, plain, strict=True):
            if word in known:
                continue
            if word in self.old:
                known[word] = self.old[word]
            elif short:
                spelt = word.decode("latin-1")
                codes = [t.id for t in tokenize(spelt if word.isascii() else spelt.translate(self.signs))]
                known[word] = struct.pack(f"<{len(codes)}I", *codes)
            else:
                slow.append(word)
        coded = self.tokenizer.encode_batch_fast([w.decode() for w in slow], add_special_tokens=False) if slow else []
        for word, code in zip(slow, coded, strict=True):
            known[word] = struct.pack(f"<{len(code.ids)}I", *code.ids)
        return [known[w] for w in words]


@lru_cache(maxsize=2)
def word_ids(file: str) -> WordIds:
    return WordIds(file)


def token_ids(texts: pa.Array, table: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after another, and how many each text has."""
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
    kind = table.one[data]
    lead = np.flatnonzero(data[:-1] == _LEAD)
    if (table.one[33:127] != _OTHER).any():
        kind[lead] = kind[lead + 1] = table.two[data[lead + 1]]
    second = np.zeros(len(data), bool)
    second[lead + 1] = True
    # Words begin after white space and where a text does.
    blank = kind == _BLANK
    begins = ~blank
    begins[1:] &= blank[:-1]
    at_text = offsets[:-1][np.diff(offsets) > 0]
    begins[at_text] = ~blank[at_text]
    words = np.flatnonzero(begins)
    plain = np.ones(len(words), bool)
    odd = np.flatnonzero(kind == _OTHER)
    plain[np.searchsorted(words, odd, side="right") - 1] = False
    # Parts of plain words begin where the kind changes, and at every digit; other words are one part.
    of_byte = np.cumsum(begins, dtype=np.int32) - 1
    free = ~blank
    free[free] = plain[of_byte[free]]
    changes = np.ones(len(data), bool)
    changes[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    starts = np.flatnonzero(begins | (changes & free & ~second))
    short = plain[of_byte[starts]]
    small = data.copy()
    upper = free & (data >= 65) & (data <= 90)
    upper |= free & second & (data <= 0x9E) & (data != 0x97)
    small[upper] += 32
    packed = np.cumsum(~blank, dtype=np.int32)
    parts = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(np.append(packed[starts] - 1, packed[-1]).astype(np.int32)), pa.py_buffer(small[~blank])]
    ).dictionary_encode()
    at = parts.indices.to_numpy()
    flags = np.zeros(len(parts.dictionary), bool)
    flags[at] = short
    coded = table.ids(parts.dictionary.to_pylist(), flags.tolist())
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    flat = np.frombuffer(b"".join(coded), "<u4")
    first, long = np.cumsum(sizes) - sizes, sizes[at]
    ids = flat[np.arange(long.sum()) + np.repeat(first[at] - (np.cumsum(long) - long), long)]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return ids, np.bincount(doc, weights=long, minlength=len(texts)).astype(np.int64)


def cut(df: DataFrame, file: str, size: int, id_column: str, text: str = "text", end: int = 0) -> DataFrame:
    """One row for each piece of a document: id, piece (from 0), start, length, and ids as bytes (four a token).

    A document's ids are those of its whole text (null: empty) and then ``end``; if they are more than
    ``size``, they are cut into pieces of ``size``, of which the last may be shorter. Rows with the same id, or
    a null id, are documents of their own. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spark shares the cores out among tasks; the library's own threads stay off.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        table = word_ids(file)
        for batch in batches:
            done = 0
            for part in slices(batch.columns[1], BATCH_BYTES):
                keys = batch.columns[0].slice(done, len(part))
                done += len(part)
                ids, counts = token_ids(part, table)
                made = np.empty(len(ids) + len(part), "<u4")
                ends = np.cumsum(counts + 1)
                made[ends - 1] = end
                inner_ids = np.ones(len(made), bool)
                inner_ids[ends - 1] = False
                made[inner_ids] = ids
                n = -(-(counts + 1) // size)
                row = np.repeat(np.arange(len(part)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum((counts + 1)[row] - start, size)
                at = (np.append(0, np.cumsum(length)) * 4).astype(np.int32)
                blob = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at), pa.py_buffer(made)])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), blob],
                    ["id", "piece", "start", "length", "ids"],
                )

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), text_or_empty(text).alias("body"))
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary")


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold: tokens, documents and attention cost (the sum of squared lengths); weights of the residuals."""

    tokens: int
    documents: int
    attention: int
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def demand(self, length: int) -> np.ndarray:
        return np.array([length, 1, length * length], np.int64)

    def score(self, residual: np.ndarray, demand: np.ndarray) -> np.ndarray:
        """Of residuals (before the piece is placed) the preference, larger is better."""
        whole = np.array([self.tokens, self.documents, self.attention], float)
        weights = np.array(self.weights)
        if self.rule == "dot":
            left = residual / whole
            return (left * (demand / whole) * weights).sum(1) / np.sqrt((left**2 * weights).sum(1))
        return -(((residual - demand) / whole) ** 2 * weights).sum(1)


def plan(lengths: Sequence[int], counts: Sequence[int], capacity: Capacity) -> np.ndarray:
    """Steps of the packing: rows of (length, first rank, first sequence, offset, how many).

    ``counts[i]`` pieces of ``lengths[i]`` tokens are placed. Sequences with equal content form a group, a range
    of numbers; a step moves the first ones of a group into a new group.
    """
    if capacity.rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    whole = np.array([capacity.tokens, capacity.documents, capacity.attention], np.int64)
    room = 1024
    residual, first, many = np.zeros((room, 3), np.int64), np.zeros(room, np.int64), np.zeros(room, np.int64)
    groups = sequences = 0
    steps: list[tuple[int, int, int, int, int]] = []
    for length, count in sorted(zip(map(int, lengths), map(int, counts), strict=True), reverse=True):
        need, rank = capacity.demand(length), 0
        if (need > whole).any():
            raise ValueError(f"a piece of {length} tokens exceeds an empty sequence")
        while rank < count:
            open_ = np.flatnonzero((many[:groups] > 0) & (residual[:groups] >= need).all(1))
            if len(open_):
                g = int(open_[np.argmax(capacity.score(residual[open_], need))])
                n = min(count - rank, int(many[g]))
                start, left = int(first[g]), residual[g].copy()
                first[g] += n
                many[g] -= n
                slot = g if many[g] == 0 else groups
            else:
                # As many as the rest of this length needs; the next step goes on filling them.
                n, start, left, slot = -(-(count - rank) // int((whole // need).min())), sequences, whole, groups
                sequences += n
            steps.append((length, rank, start, capacity.tokens - int(left[0]), n))
            if slot == groups:
                groups += 1
                if groups > len(many):
                    residual, first, many = (np.concatenate([a, np.zeros_like(a)]) for a in (residual, first, many))
            residual[slot], first[slot], many[slot] = left - need, start, n
            if residual[slot].min() <= 0:
                many[slot] = 0  # full: it needs no look any more
            rank += n
    return np.array(steps, np.int64).reshape(-1, 5)


def _numbered(df: DataFrame, length: Column, part: str, nth: str) -> DataFrame:
    """df with the task that wrote a row and how many rows of the same length came before it there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        task = TaskContext.get().partitionId()
        for batch in batches:
            values = batch.columns[-1].fill_null(0).to_numpy()
            kinds, of = np.unique(values, return_inverse=True)
            order = np.argsort(of, kind="stable")
            sizes = np.bincount(of, minlength=len(kinds))
            at = np.empty(len(values), np.int64)
            at[order] = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at += np.array([seen.get(int(k), 0) for k in kinds], np.int64)[of] if len(kinds) else 0
            for k, n in zip(kinds.tolist(), sizes.tolist(), strict=True):
                seen[k] = seen.get(k, 0) + n
            made = [pa.array(np.full(len(values), task, np.int64)), pa.array(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], inner)

    schema = StructType([*df.schema.fields, StructField(part, LongType()), StructField(nth, LongType())])
    inner = [f"c{i}" for i in range(len(schema))]
    plain = StructType([StructField(n, f.dataType) for n, f in zip(inner, schema, strict=True)])
    rows = df.select(*columns_of(df), length.alias("len")).toDF(*inner[: len(df.columns)], "len")
    return rows.mapInArrow(run, plain).toDF(*schema.fieldNames())


def _placer(steps: np.ndarray):
    """Sequence and offset of the piece of a length with a rank, by the steps of a plan."""
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    keys = (steps[:, 0] << 40) + steps[:, 1]

    @F.pandas_udf("sequence long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rank = rank.to_numpy(np.int64)
        at = np.searchsorted(keys, (length.to_numpy(np.int64) << 40) + rank, side="right") - 1
        return pd.DataFrame({"sequence": steps[at, 2] + rank - steps[at, 1], "offset": steps[at, 3]})

    return place


def pack(df: DataFrame, capacity: Capacity, length: str = "length") -> DataFrame:
    """All columns of df, the sequence each row goes to and its offset there (``sequence_id``, ``offset``).

    Offsets of a sequence are without gaps. Rows whose length is null or not positive take no room and get
    nulls; a row longer than a sequence is an error. Equal rows are packed one by one. An empty table gives
    an empty table.
    """
    part, nth, size, before = (free_name(df, n) for n in ("part_", "nth_", "size_", "before_"))
    sequence, offset, placed = (free_name(df, n) for n in ("sequence_id", "offset", "placed_"))
    whole = F.col("`" + length.replace("`", "``") + "`").cast("long")
    items = materialise(_numbered(df, whole, part, nth), "pieces").withColumn(size, F.when(whole > 0, whole))
    counts = materialise(items.where(F.col(size).isNotNull()).groupBy(part, size).agg(F.count("*").alias("n")), "lengths")
    longest = counts.agg(F.max(size)).collect()[0][0] or 0
    if longest > capacity.tokens:
        raise ValueError(f"a row of {longest} tokens exceeds an empty sequence")
    # As many rows as there are lengths, at most the tokens of a sequence.
    totals = counts.groupBy(size).agg(F.sum("n").alias("n")).collect()
    place = _placer(plan([r[size] for r in totals], [r["n"] for r in totals], capacity))
    earlier = Window.partitionBy(size).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(part, size, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    rows = items.join(base, [part, size], "left")
    rank = F.coalesce(F.col(before) + F.col(nth), F.lit(0))
    found = rows.withColumn(placed, place(F.coalesce(F.col(size), F.lit(0)), rank)) if totals else rows.withColumn(
        placed, F.lit(None).cast("struct<sequence:long,offset:long>")
    )
    known = F.col(size).isNotNull()
    return found.select(
        *columns_of(df), F.when(known, F.col(placed)["sequence"]).alias(sequence),
        F.when(known, F.col(placed)["offset"]).alias(offset),
    )
