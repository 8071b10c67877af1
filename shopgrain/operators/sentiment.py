"""Rule-based sentiment with a lexicon table.

The lexicon is a DataFrame ``(word, valence)``, so its size is free. One of up to
``FILTER_WORDS`` words travels with the tasks and is looked up inside each row, without a shuffle.
One of up to ``PACKED_WORDS`` is packed once into a table of numbers in the shared folder, which tasks read and look up
for many texts at a time, also without a shuffle.
Tokens meet a larger one in a join that drops all other words at once; only sentiment words reach the aggregate,
never whole texts.

An entry may have several words, with one blank between them. Where entries start at the same word the longest
counts, and none counts that starts within an earlier match; a match counts as one sentiment word that is as long
as its entry, at the place of its first word.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shopgrain.functions import dictionaries as D
from shopgrain.functions.matching import in_slices
from shopgrain.functions.textual import sentiment_label, words
from shopgrain.operators.checkpoints import new_path
from shopgrain.sources.files import local_table

# The helpers travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the published method (Hutto and Gilbert, 2014).
ALPHA = 15
NEGATED = -0.74
DEGREE = 0.293
DAMPING = (1.0, 0.95, 0.9)
BANG = 0.292


LEXICON_SCHEMA = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("valence", T.DoubleType())]
)


def lexicon_table(spark: SparkSession, lexicon: Mapping[str, float] | None = None) -> DataFrame:
    entries = dict(D.SEED_LEXICON if lexicon is None else lexicon)
    return local_table(spark, list(entries.items()), LEXICON_SCHEMA)


def scan_lexicon(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(word, valence) from files of lines ``entry, valence, ...``; further fields are notes.

    Entries are brought into the form of tokens: lower case, without punctuation around words, one blank between
    words. Those without a token and lines without a finite valence are left out; an entry that is named more
    than once gets the mean.
    """
    lines = spark.read.schema("entry string, valence string").options(sep=sep, quote="").csv(path)
    entry = F.array_join(sentiment_tokens(F.lower("entry")), " ")
    valence = F.expr("try_cast(trim(valence) AS double)")
    rows = lines.select(entry.alias("word"), valence.alias("valence"))
    finite = F.abs("valence") < float("inf")
    return rows.where((F.col("word") != "") & finite).groupBy("word").agg(F.avg("valence").alias("valence"))


def _longest(lexicon: DataFrame) -> int:
    """Words of the longest entry."""
    return max(lexicon.agg(F.max(F.size(F.split("word", " ")))).first()[0] or 1, 1)


def sentiment_tokens(text: Column) -> Column:
    """Words without the punctuation around them; single characters drop out."""
    bare = F.transform(words(text), lambda w: F.btrim(w, F.lit(".,!?")))
    return F.filter(bare, lambda w: F.length(w) > 1)


def lexicon_join(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Valence of each token found. Spark broadcasts the lexicon when it is small enough."""
    return tokens.join(lexicon, "word")


#: Bits that stand for the entries of a lexicon that is joined.
BITS = 1 << 26

# Lexicons up to this many words go to the rows; larger ones are packed, up to so many words and bytes, or else joined.
FILTER_WORDS = 20_000
PACKED_WORDS, PACKED_BYTES = 1 << 23, 1 << 27
# Bytes of text that are looked up in a packed lexicon at a time.
TEXT_BYTES = 4 << 20
# Bits of the hash by which keys that no entry has are put aside before the search.
HASH_BITS = 24


def _known(lexicon: DataFrame) -> dict[str, float] | None:
    """Words and valences of a lexicon of up to ``FILTER_WORDS`` words, else None."""
    found = lexicon.select("word", "valence").limit(FILTER_WORDS + 1).collect()
    return None if len(found) > FILTER_WORDS else {r["word"]: r["valence"] for r in found}


def _tokens(df: DataFrame, key: str, text: str, known: list[str] | None, longest: int = 1) -> DataFrame:
    """One row per token, and stretch of up to ``longest``, with the three before it; only ``known`` words."""
    prepared = df.withColumn("_t", sentiment_tokens(F.col(text)))
    prepared = prepared.select(key, "_t", F.array_position("_t", "but").alias("_but"))

    def before(i: Column, back: int) -> Column:
        return F.when(i - back >= 0, F.get(F.col("_t"), i - back))

    def entry(word: Column, pos: Column, size: int) -> Column:
        near = [before(pos, n).alias(f"w{n}") for n in (1, 2, 3)]
        return F.struct(word.alias("word"), pos.alias("pos"), F.lit(size).alias("len"), *near)

    def phrase(i: Column, size: int) -> Column:
        if size == 1:
            return F.get(F.col("_t"), i)
        return F.array_join(F.slice("_t", i + 1, F.lit(size)), " ")

    def found(size: int) -> Column:
        spots = F.when(F.size("_t") >= size, F.sequence(F.lit(0), F.size("_t") - size)).otherwise(
            F.array().cast("array<int>")
        )
        if known is not None:
            spots = F.filter(spots, lambda i: phrase(i, size).isin(known))
        return F.transform(spots, lambda i: entry(phrase(i, size), i, size))

    entries = found(1) if longest == 1 else F.concat(*[found(size) for size in range(1, longest + 1)])
    return prepared.select(key, "_but", F.inline(entries))


def _uncovered(hits: DataFrame, text: str, longest: int) -> DataFrame:
    """Matches that count: the longest at a place, none that starts within an earlier one."""
    if longest == 1:
        return hits
    before = Window.partitionBy(text).orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    rows = hits.withColumns(
        {
            "_reach": F.max(F.col("pos") + F.col("len")).over(before),
            "_most": F.max("len").over(Window.partitionBy(text, "pos")),
        }
    )
    kept = (F.coalesce("_reach", F.lit(0)) <= F.col("pos")) | (F.col("pos") < 0)
    return rows.where(kept & (F.col("len") == F.col("_most"))).drop("_reach", "_most")


def _moved(valence: Column, before: Sequence[Column], spot: Column, but: Column) -> Column:
    """Valence of a token after degree words, negations and "but" (places from 1, 0: none)."""
    value, sign = valence, F.signum(valence)
    for w, damp in zip(before, DAMPING, strict=True):
        step = (
            F.when(w.isin(D.INTENSIFIERS), DEGREE * damp)
            .when(w.isin(D.DAMPENERS), -DEGREE * damp)
            .otherwise(0.0)
        )
        value = value + sign * step
        negated = F.coalesce(w.isin(D.NEGATIONS), F.lit(False))
        value = F.when(negated, value * NEGATED).otherwise(value)
    return (
        F.when((but > 0) & (spot < but), value * 0.5)
        .when((but > 0) & (spot > but), value * 1.5)
        .otherwise(value)
    )


def _valence() -> Column:
    return _moved(F.col("valence"), [F.col(f"w{n}") for n in (1, 2, 3)], F.col("pos") + 1, F.col("_but"))


def token_valences(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(key, pos, valence) per sentiment word, with negations, degree words and "but".

    With entries of several words ``key`` must tell the texts apart.
    """
    known, longest = _known(lexicon), _longest(lexicon)
    tokens = _tokens(df, key, text, None if known is None else sorted(known), longest=longest)
    hits = _uncovered(lexicon_join(tokens, lexicon), key, longest)
    return hits.select(key, "pos", _valence().alias("valence"))


SUMS = "n int, total double, positive double, negative double, hits int"


def _scorer(known: Mapping[str, float]):
    """Sums over the sentiment words of a text, as one opaque value per row.

    The rules read every word next to the three before it, so as columns they become a tree that
    each use copies: a filter on any column derived from it made plans of millions of signs. One
    Arrow UDF keeps plans small, and as it counts as nondeterministic Spark computes it once per row
    and moves no filter through it. The lexicon travels with the tasks, not in the plan.
    """
    negations, up, down = frozenset(D.NEGATIONS), frozenset(D.INTENSIFIERS), frozenset(D.DAMPENERS)
    damping, degree, turned = DAMPING, DEGREE, NEGATED
    # A word trie: each node maps the next word to a node, and None to the valence of the entry that ends there.
    trie: dict = {}
    for phrase, valence in known.items():
        if phrase is not None and valence is not None:
            node = trie
            for word in phrase.split(" "):
                node = node.setdefault(word, {})
            node[None] = float(valence)
    kinds = {"int": pa.int32(), "double": pa.float64()}
    fields = {name: kinds[kind] for name, kind in (f.split() for f in SUMS.split(", "))}

    def sums(text: str | None) -> tuple:
        bare = (w.strip(".,!?") for w in re.split("[ \t\n\x0b\f\r]+", text or ""))
        tokens = [w for w in bare if len(w) > 1]
        but = tokens.index("but") if "but" in tokens else -1
        total, positive, negative, hits, found = 0.0, 0.0, 0.0, 0, False
        reach = 0
        for i, word in enumerate(tokens):
            node, end, size, valence = trie.get(word), i + 1, 0, None
            while node is not None:
                if None in node:
                    size, valence = end - i, node[None]
                node = node.get(tokens[end]) if end < len(tokens) else None
                end += 1
            if valence is None:
                continue
            covered, reach = i < reach, max(reach, i + size)
            if covered:
                continue
            found, value, sign = True, valence, (valence > 0) - (valence < 0)
            for back, damp in enumerate(damping, start=1):
                if back > i:
                    break
                near = tokens[i - back]
                if near in up:
                    value += sign * degree * damp
                elif near in down:
                    value -= sign * degree * damp
                if near in negations:
                    value *= turned
            if but >= 0 and i != but:
                value *= 0.5 if i < but else 1.5
            total += value
            if value > 0:
                positive += value + 1
            elif value < 0:
                negative += 1 - value
            hits += size * (value != 0)
        return len(tokens), total if found else None, positive, negative, hits

    @F.arrow_udf(SUMS)
    def score(texts: pa.Array) -> pa.Array:
        rows = [sums(t) for some in in_slices(texts) for t in some]
        columns = zip(*rows) if rows else [[]] * len(fields)
        return pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, fields.values())], list(fields))

    return score.asNondeterministic()


def _cut_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of texts, as ``sentiment_tokens`` has them, one after the other, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    bare = pc.ascii_trim(split.flatten(), characters=".,!?")
    long = pc.greater(pc.utf8_length(bare), 1)
    before = np.concatenate([[0], np.cumsum(long.to_numpy(zero_copy_only=False))])
    ends = split.offsets.to_numpy()
    return bare.filter(long), np.diff(before[ends - ends[0]])


def _in_bytes(texts: pa.Array) -> Iterator[pa.Array]:
    """The array in pieces of about ``TEXT_BYTES``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        reached = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, reached + TEXT_BYTES, "right")), start + 1)
        yield texts.slice(start, stop - start)
        start = stop


def token_lists(text: Column) -> Column:
    """``sentiment_tokens`` of whole texts by one Arrow UDF, computed once per row."""

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        parts = []
        for some in _in_bytes(texts):
            tokens, sizes = _cut_tokens(some)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            parts.append(pa.ListArray.from_arrays(ends, tokens.cast(pa.string()), mask=some.is_null()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return cut.asNondeterministic()(text)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system and the path in it."""
    return pafs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def _packed(lexicon: DataFrame) -> str | None:
    """Path of the lexicon as a packed trie, or None where it is too large, or an entry is repeated or not a number.

    Level 1 has the words of all entries in order of their hashes, which are its keys. Each further level has the keys ``node * words +
    word`` of its nodes in order, for a node of the level before; a node's number is its place. A node has the valence
    of the entry that ends there, or NaN.
    """
    usable = lexicon.where(F.col("word").isNotNull() & F.col("valence").isNotNull())
    facts = usable.agg(
        F.sum(F.size(F.split("word", " "))), F.sum(F.octet_length("word")), F.count("*"), F.count_distinct("word"),
        F.count_if(F.isnan("valence")),
    ).first()
    if (facts[0] or 0) > PACKED_WORDS or (facts[1] or 0) > PACKED_BYTES or facts[2] != facts[3] or facts[4]:
        return None
    schema = pa.schema([("level", pa.int32()), ("part", pa.int32()), ("word", pa.string()), ("key", pa.int64()), ("valence", pa.float64())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches))
        split = pc.split_pattern(found["word"].combine_chunks(), " ")
        ends, valence = split.offsets.to_numpy(), found["valence"].to_numpy()
        coded = split.flatten().dictionary_encode()
        codes, known, level = coded.indices.to_numpy().astype(np.int64), coded.dictionary, 1
        hashes = _word_hashes(known)
        order = np.argsort(hashes, kind="stable")
        place, known, keys = np.argsort(order), known.take(pa.array(order)), hashes[order]
        codes = place[codes]
        sizes, starts, n = np.diff(ends), ends[:-1] - ends[0], len(known)
        value = np.full(n, np.nan)
        value[codes[starts[sizes == 1]]] = valence[sizes == 1]
        left = np.flatnonzero(sizes > 1)
        node, columns = codes[starts[left]], {"word": known, "key": pa.array(keys)}
        while True:
            columns = {"word": pa.nulls(len(value), pa.string())} | columns
            columns |= {"level": pa.array(np.full(len(value), level, np.int32)), "valence": pa.array(value)}
            columns["part"] = pa.array(np.arange(len(value), dtype=np.int32))
            yield from pa.table([columns[f.name] for f in schema], schema).to_batches(max_chunksize=1 << 16)
            if not len(left):
                return
            keys, place = np.unique(node * n + codes[starts[left] + level], return_inverse=True)
            level += 1
            value = np.full(len(keys), np.nan)
            last = sizes[left] == level
            value[place[last]] = valence[left[last]]
            left, node, columns = left[~last], place[~last], {"key": pa.array(keys)}

    path = new_path(lexicon.sparkSession, "packed-lexicon")
    one = usable.select("word", "valence").coalesce(1)
    one.mapInArrow(pack, "level int, part int, word string, key bigint, valence double").write.partitionBy("level").parquet(path)
    return path


def _load(path: str) -> tuple[pa.Array, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """A packed lexicon: its words, their hashes and valences, and for each further level keys, valences, and which hashes of keys occur."""
    at, folder = _opened(path)
    levels = sorted(int(f.base_name[6:]) for f in at.get_file_info(pafs.FileSelector(folder)) if f.base_name.startswith("level="))
    words, hashes, first, further = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0), []
    for level in levels:
        rows = pads.dataset(f"{folder}/level={level}", filesystem=at, format="parquet").to_table(
            columns=["part", "key", "valence", *["word"] * (level == 1)]
        )
        order = np.argsort(rows["part"].to_numpy(), kind="stable")
        keys, valence = rows["key"].to_numpy()[order], rows["valence"].to_numpy()[order]
        if level == 1:
            words, hashes, first = rows["word"].combine_chunks().take(pa.array(order)), keys, valence
        else:
            occurs = np.zeros(1 << HASH_BITS, bool)
            occurs[_hashed(keys)] = True
            further.append((keys, valence, occurs))
    return words, hashes, first, further


def _word_hashes(words: pa.Array) -> np.ndarray:
    parts = [words.slice(i, 1 << 16).to_numpy(zero_copy_only=False) for i in range(0, len(words), 1 << 16)]
    return np.concatenate([np.zeros(0, np.int64), *[pd.util.hash_array(p, categorize=False).view(np.int64) for p in parts]])


def _places(found: pa.Array, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """Places of the found words among ``words``, which are in order of their hashes; -1 for others."""
    if (hashes[1:] == hashes[:-1]).any() or not len(words):
        return pc.fill_null(pc.index_in(found, words), -1).to_numpy().astype(np.int64)
    own = _word_hashes(found)
    near = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    same = pc.equal(words.take(pa.array(near)), found).to_numpy(zero_copy_only=False)
    return np.where(same, near, -1)


def _hashed(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)


def _packed_scorer(path: str):
    """The sums of ``_scorer``, from a packed lexicon in the shared folder: the words of many texts at a time."""
    negations, up, down = (pa.array(sorted(w)) for w in (D.NEGATIONS, D.INTENSIFIERS, D.DAMPENERS))
    damping, degree, turned = DAMPING, DEGREE, NEGATED
    kinds = {"int": pa.int32(), "double": pa.float64()}
    fields = {name: kinds[kind] for name, kind in (f.split() for f in SUMS.split(", "))}
    held: list = []

    def matches(ids: np.ndarray, last: np.ndarray, further: Sequence, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words and valence of the longest entry at each place; ``last``: the last place of its text."""
        size = (~np.isnan(value)).astype(np.int64)
        spots = np.flatnonzero(ids >= 0)
        node, n = ids[spots], len(held[0][0])
        for level, (keys, valence, occurs) in enumerate(further, start=1):
            go = spots + level <= last[spots]
            spots, node = spots[go], node[go]
            following = ids[spots + level]
            key = node * n + following
            go = following >= 0
            go[go] = occurs[_hashed(key[go])]
            spots, key = spots[go], key[go]
            node = np.searchsorted(keys, key)
            go = keys[np.minimum(node, len(keys) - 1)] == key
            spots, node = spots[go], node[go]
            ends = ~np.isnan(valence[node])
            value[spots[ends]], size[spots[ends]] = valence[node[ends]], level + 1
        return size, value

    def sums(texts: pa.Array) -> list[pa.Array]:
        known, hashes, first, further = held[0]
        tokens, sizes = _cut_tokens(texts)
        coded = tokens.dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())

        def told(found: pa.Array) -> np.ndarray:
            return found.to_numpy(zero_copy_only=False)[codes]

        ids = _places(distinct, known, hashes)[codes]
        text = np.repeat(np.arange(len(sizes)), sizes)
        starts = np.cumsum(sizes) - sizes
        value = np.full(len(ids), np.nan)
        value[ids >= 0] = first[ids[ids >= 0]]
        size, value = matches(ids, (starts + sizes - 1)[text], further, value)
        at = np.flatnonzero(size)
        # None counts that starts within an earlier match; no match reaches into the next text.
        reach = np.maximum.accumulate(at + size[at])
        at = at[at >= np.concatenate([[0], reach[:-1]])] if len(at) else at
        v, of = value[at], text[at]
        sign = np.sign(v)
        raised, lowered, denied = (told(pc.is_in(distinct, w)) for w in (up, down, negations))
        for back, damp in enumerate(damping, start=1):
            there = at - back >= starts[of]
            near = np.where(there, at - back, 0)
            v = np.where(there & raised[near], v + sign * degree * damp, np.where(there & lowered[near], v - sign * degree * damp, v))
            v = np.where(there & denied[near], v * turned, v)
        buts = np.flatnonzero(told(pc.equal(distinct, "but")))
        but = np.full(len(sizes), -1)
        but[text[buts[::-1]]] = buts[::-1]
        spot = but[of]
        v = np.where((spot >= 0) & (at < spot), v * 0.5, np.where((spot >= 0) & (at > spot), v * 1.5, v))

        def total(w: np.ndarray) -> np.ndarray:
            return np.bincount(of, w, len(sizes))

        columns = [
            sizes, total(v), total(np.where(v > 0, v + 1, 0.0)), total(np.where(v < 0, 1 - v, 0.0)), total(size[at] * (v != 0)),
        ]
        none = np.bincount(of, minlength=len(sizes)) == 0
        return [pa.array(c, mask=none if name == "total" else None).cast(kind) for c, (name, kind) in zip(columns, fields.items())]

    @F.arrow_udf(SUMS)
    def score(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(_load(path))
        parts = [pa.StructArray.from_arrays(sums(some), list(fields)) for some in _in_bytes(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(list(fields.items())))

    return score.asNondeterministic()


def _sums_in_row(df: DataFrame, text: str, kept: Sequence[str], scorer) -> DataFrame:
    """Sums over the sentiment words of each row, beside its ``kept`` columns."""
    rows = df.withColumn("_s", scorer(F.col(text)))
    return rows.select(
        *kept,
        F.struct(F.col("_s.n"), *_base(F.col(text))).alias("_base"),
        F.col("_s.total").alias("_sum"), F.col("_s.positive").alias("_pos"),
        F.col("_s.negative").alias("_neg"), F.col("_s.hits").alias("_hits"),
    )


def _base(text: Column) -> list[Column]:
    return [
        F.coalesce(F.length(F.trim(text)) >= 3, F.lit(False)).alias("ok"),
        (F.least(F.length(text) - F.length(F.translate(text, "!", "")), F.lit(4)) * BANG).alias("bang"),
    ]


def _bitmap(lexicon: DataFrame) -> bytes:
    """One bit for the checksum of every entry: ``BITS`` of them, whatever the size of the lexicon."""
    place = F.crc32(F.col("word").cast("binary")) % BITS + 1
    parts = (
        lexicon.where(F.col("word").isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    )
    out, size = bytearray(BITS // 8), 4096
    for r in parts:
        out[(r["part"] - 1) * size : r["part"] * size] = r["bits"]
    return bytes(out)


def _candidates(bitmap: bytes, longest: int):
    """Words and stretches of up to ``longest`` words that may be entries, with the three words before each."""
    bits = len(bitmap) * 8
    text, whole = pa.string(), pa.int32()
    fields = {"word": text, "pos": whole, "len": whole, "w1": text, "w2": text, "w3": text}

    @F.arrow_udf("n int, but int, hits array<struct<word string, pos int, len int, w1 string, w2 string, w3 string>>")
    def find(texts: pa.Array) -> pa.Array:
        parts = []
        for some in in_slices(texts):
            sizes, buts, ends, rows = [], [], [0], []
            for t in some:
                bare = (w.strip(".,!?") for w in re.split("[ \t\n\x0b\f\r]+", t or ""))
                tokens = [w for w in bare if len(w) > 1]
                coded, n = [(" " + w).encode() for w in tokens], len(tokens)
                for i in range(n):
                    sum_ = zlib.crc32(coded[i][1:])
                    for size in range(1, min(longest, n - i) + 1):
                        if size > 1:
                            sum_ = zlib.crc32(coded[i + size - 1], sum_)
                        spot = sum_ % bits
                        if bitmap[spot >> 3] >> (spot & 7) & 1:
                            near = [tokens[i - back] if back <= i else None for back in (1, 2, 3)]
                            rows.append((" ".join(tokens[i : i + size]), i, size, *near))
                sizes.append(n)
                buts.append(tokens.index("but") + 1 if "but" in tokens else 0)
                ends.append(len(rows))
            columns = zip(*rows) if rows else [[]] * len(fields)
            hits = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, fields.values())], list(fields))
            lists = pa.ListArray.from_arrays(pa.array(ends, whole), hits)
            found = [pa.array(sizes, whole), pa.array(buts, whole), lists]
            parts.append(pa.StructArray.from_arrays(found, ["n", "but", "hits"]))
        kind = pa.struct([("n", whole), ("but", whole), ("hits", pa.list_(pa.struct(list(fields.items()))))])
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return find.asNondeterministic()


def _sums_by_join(df: DataFrame, text: str, kept: Sequence[str], lexicon: DataFrame) -> DataFrame:
    """The same by a join; rows are told apart by a number, as keys may repeat.

    A bitmap of the entries' checksums travels with the tasks, so that only words that may be entries become rows;
    the join drops those that are none. One more row per text carries the base struct.
    """
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    base = [*_base(F.col(text)), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)]]
    longest = _longest(lexicon)
    found = rows.withColumn("_f", _candidates(_bitmap(lexicon), longest)(F.col(text))).select(
        "_row", F.col("_f.but").alias("_but"), F.col("_f.hits").alias("_hits"),
        F.struct(F.col("_f.n").alias("n"), *base).alias("_b"),
    )
    near, none = ("w1", "w2", "w3"), F.lit(None)
    # A word of its own per row: a shuffled join spreads these rows like any others.
    own = F.struct(
        F.concat(F.lit("\x01"), F.col("_row").cast("string")).alias("word"), F.lit(-1).alias("pos"),
        F.lit(1).alias("len"), *[none.cast("string").alias(w) for w in near], F.col("_b").alias("base"),
    )
    hit = F.transform("_hits", lambda h: F.struct(
        *[h[c].alias(c) for c in ("word", "pos", "len", *near)], none.cast(found.schema["_b"].dataType).alias("base")
    ))
    tokens = found.select("_row", "_but", F.inline(F.concat(F.array(own), hit))).join(lexicon, "word", "left")
    hits = _uncovered(tokens.where(F.col("valence").isNotNull() | (F.col("pos") < 0)), "_row", longest)
    v = F.col("v")
    sums = (
        hits.select("_row", "base", "len", F.when(F.col("pos") >= 0, _valence()).alias("v"))
        .groupBy("_row").agg(
            F.sum(v).alias("_sum"),
            F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("_pos"),
            F.sum(F.when(v < 0, 1 - v).otherwise(0.0)).alias("_neg"),
            F.coalesce(F.sum(F.when(v != 0, F.col("len"))), F.lit(0)).alias("_hits"),
            F.first("base", ignorenulls=True).alias("_base"),
        )
    )
    return sums.withColumns({c: F.col(f"_base._{i}") for i, c in enumerate(kept)})


def sentiment(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, carry: Sequence[str] = ()
) -> DataFrame:
    """Positive, negative and neutral shares, compound score and label, one row per row of df.

    Texts under three characters, null texts, and texts without a sentiment word are neutral.
    ``carry`` takes further columns of df along, which saves a join.
    """
    known, kept = _known(lexicon), [key, *carry]
    packed = _packed(lexicon) if known is None else None
    if known is not None:
        sums = _sums_in_row(df, text, kept, _scorer(known))
    elif packed is not None:
        sums = _sums_in_row(df, text, kept, _packed_scorer(packed))
    else:
        sums = _sums_by_join(df, text, kept, lexicon)
    bang = F.col("_base.bang")
    emphasis = F.when(F.col("_sum") > 0, bang).when(F.col("_sum") < 0, -bang)
    total = F.col("_sum") + F.coalesce(emphasis, F.lit(0.0))
    pos = F.col("_pos") + F.when(F.col("_pos") > F.col("_neg"), bang).otherwise(0.0)
    neg = F.col("_neg") + F.when(F.col("_neg") > F.col("_pos"), bang).otherwise(0.0)
    parts = sums.withColumns(
        {
            "_ok": F.col("_base.ok") & F.col("_sum").isNotNull(),
            "_p": pos,
            "_g": neg,
            "_u": (F.col("_base.n") - F.col("_hits")).cast("double"),
            "_c": F.round(total / F.sqrt(total * total + ALPHA), 4),
        }
    )
    whole = F.col("_p") + F.col("_g") + F.col("_u")

    def share(c: str, default: float) -> Column:
        part = F.round(F.try_divide(F.col(c), whole), 4)
        return F.coalesce(F.when(F.col("_ok"), part), F.lit(default))

    out = parts.select(
        *kept,
        share("_p", 0.0).alias("sentiment_positive"),
        share("_g", 0.0).alias("sentiment_negative"),
        share("_u", 1.0).alias("sentiment_neutral"),
        F.coalesce(F.when(F.col("_ok"), F.col("_c")), F.lit(0.0)).alias("sentiment_compound"),
    )
    return out.withColumn("sentiment_label", sentiment_label("sentiment_compound"))


def attach(df: DataFrame, scores: DataFrame, on: str) -> DataFrame:
    """Put score columns beside their rows by key."""
    return df.join(scores, on)
