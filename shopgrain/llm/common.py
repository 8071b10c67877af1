"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """The text as a string; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def learned_from(id_column: str, folds: int) -> Column:
    """False for held-out rows: crc32 of the id as text leaves 1 modulo ``folds``; a null id is not held out."""
    return ~held_out(id_column, folds)


def held_out(id_column: str, folds: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == 1, F.lit(False))


def span_digest(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas; only some kinds if given."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def slices(array: pa.Array, max_bytes: int) -> Iterator[pa.Array]:
    """Consecutive parts of a string array with at most ``max_bytes`` of text each, one row at least."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(array).to_pylist()):
        if size and size + (n or 0) > max_bytes:
            yield array[start:i]
            start, size = i, 0
        size += n or 0
    if start < len(array):
        yield array[start:]


def columns_of(df: DataFrame) -> list[Column]:
    """References to all columns, whatever signs their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
