"""SentencePiece encoding and decoding through a table of distinct marked words.

White space becomes a marker in front of the word that follows. When no piece of a model has a marker
behind another sign, no merge crosses from one word to the next, so a text's ids are those of its
marked words one after another. Each Arrow batch makes a table of its distinct marked words, the library
segments each of them once, and the ids are joined back by position. A table for the whole corpus would
have to shuffle every occurrence of every word, several times the input; one per batch shuffles nothing.

Defined results: a null or empty text has the end id only; texts of any length are encoded whole;
repeated rows give repeated results; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from shopgrain.llm.common import columns_of, free_name, slices, text_or_empty

MARK = "▁"
#: Text per table of words, and words kept from one table for the next.
BATCH_BYTES, KEPT_WORDS = 1 << 20, 100_000


class WordTable:
    """Ids of marked words, segmented once each."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        crossing = [p for p in map(self.model.id_to_piece, range(self.model.vocab_size())) if MARK in p.lstrip(MARK)]
        if crossing or not self.model.encode("a", out_type=str)[0].startswith(MARK):
            raise ValueError("pieces of this model cross white space; marked words can't be segmented alone")
        self.known: dict[str, bytes] = {}

    def ids(self, words: list[str]) -> list[bytes]:
        """Of each word the ids, four bytes each. Words start with one blank, the marker that the library puts first."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        lone = [self.model.piece_to_id(MARK)]
        for word, ids in zip(new, self.model.encode([w[1:] for w in new], num_threads=1), strict=True):
            self.known[word] = np.array(ids if word != " " else lone, np.int32).tobytes()
        return [self.known[w] for w in words]


@lru_cache(maxsize=2)
def word_table(model: str) -> WordTable:
    return WordTable(model)


def encode_batch(texts: pa.Array, table: WordTable) -> pa.Array:
    """The ids of every text, the end id last."""
    texts = pc.replace_substring(texts, MARK, " ")
    # The blank in front is the one that the library adds; an empty text stays empty.
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    blank = data == 32
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    words = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)
    ).dictionary_encode()
    pieces = table.ids(words.dictionary.to_pylist())
    at = words.indices.to_numpy()
    # Pieces of all words in one array; a word's are copied to wherever it stands, then an end id per text.
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
    flat = np.frombuffer(b"".join(pieces), np.int32)
    first = np.cumsum(sizes) - sizes
    long = sizes[at]
    place = np.cumsum(long) - long
    doc = np.searchsorted(offsets, starts, side="right") - 1
    ids = np.empty(int(long.sum()) + len(texts), np.int32)
    shift = np.repeat(doc, long)
    ids[np.arange(len(shift)) + shift] = flat[np.arange(len(shift)) + np.repeat(first[at] - place, long)]
    ends = np.bincount(doc, weights=long, minlength=len(texts)).astype(np.int64).cumsum() + np.arange(len(texts))
    ids[ends] = table.model.eos_id()
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends + 1).astype(np.int32)), pa.array(ids))


def encode(df: DataFrame, model: str, text: str = "text", to: str = "ids", decoded: str | None = None) -> DataFrame:
    """All columns of df, the ids of its texts and, if a name is given, what the library decodes them to.

    ``model`` is a file that every executor has. Rows leave a task in parts of ``BATCH_BYTES`` of text, so its
    memory does not grow with the rows of an Arrow batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(model)
        for batch in batches:
            start = 0
            for part in slices(batch.columns[-1], BATCH_BYTES):
                rows = batch.slice(start, len(part))
                start += len(part)
                ids = encode_batch(part, table)
                made = [ids, _decoded(ids, table)] if decoded else [ids]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *made], inner)

    new = [StructField(free_name(df, to), ArrayType(IntegerType()))]
    new += [StructField(free_name(df, decoded), StringType())] if decoded else []
    schema = StructType([*df.schema.fields, *new])
    # Plain names on the way through the tasks: mapInArrow can't take all that a column may be called.
    inner = [f"c{i}" for i in range(len(schema))]
    plain = StructType([StructField(n, f.dataType) for n, f in zip(inner, schema, strict=True)])
    rows = df.select(*columns_of(df), text_or_empty(text).alias("body")).toDF(*inner[: len(df.columns)], "body")
    return rows.mapInArrow(run, plain).toDF(*schema.fieldNames())


def _decoded(ids: pa.Array, table: WordTable) -> pa.Array:
    offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
    bounds = zip(offsets[:-1], offsets[1:], strict=True)
    return pa.array([table.model.decode(values[a:b].tolist()) for a, b in bounds], pa.string())


def decode(df: DataFrame, model: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of df and the text of its ids; null ids give an empty text."""

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        return _decoded(lists, word_table(model))

    return df.withColumn(free_name(df, to), text(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
