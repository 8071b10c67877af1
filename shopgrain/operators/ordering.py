"""Order-dependent operators that never sort a whole table in one task.

Positions and exact quantiles both need a running count over a global order. Positions
come from a range-partitioned sort and the sizes of its ranges; quantiles from counts
per value range, cut at values sampled by hash, which affect balance, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.operators.checkpoints import materialise

RANGES = 256


def with_index(df: DataFrame, order: str | Sequence[str | Column], out: str = "product_idx") -> DataFrame:
    """Dense 0..n-1 position by a unique order key, or by several columns.

    Spark sorts by ranges, as many as the data needs, and numbers the rows of each; the sorted rows are
    written, so that the number of a range and its size belong together whatever is computed again.
    """
    numbered = df.orderBy(order).withColumn("_at", F.monotonically_increasing_id())
    rows = materialise(numbered, "ordered").withColumn("_range", F.shiftright("_at", 33))
    # One row a range, so this one window without partitions is short.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_range").agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    return (
        rows.join(offsets, "_range").withColumn(out, (F.col("_offset") + place).cast("bigint"))
        .drop("_range", "_offset", "_at")
    )


def surrogate_id(
    df: DataFrame, prefix: str, order: str, out: str = "product_id"
) -> DataFrame:
    """Ids ``<prefix>0, <prefix>1, ...`` by position in a unique order."""
    df = with_index(df, order, "_pos")
    return df.withColumn(out, F.concat(F.lit(prefix), F.col("_pos").cast("string"))).drop("_pos")


def _interpolate(ordered: Sequence[tuple[float, int]], position: float, before: int = 0) -> float:
    """Value at a fractional position among counted values in order."""
    low, high = math.floor(position), math.ceil(position)
    a = b = None
    for value, n in ordered:
        before += n
        a = value if a is None and before > low else a
        b = value if b is None and before > high else b
    return a + (b - a) * (position - low)


def exact_quantile(
    df: DataFrame, value: str, p: float, ranges: int = RANGES, few: int = 10_000
) -> float | None:
    """Exact quantile with linear interpolation; like ``approxQuantile`` it runs at once.

    Values are counted first, so a value that fills a third of the table is one row
    afterwards. Row counts of at most ``ranges`` value ranges show which one holds the
    wanted position, and the search goes on inside it until ``few`` distinct values are
    left; no more than these, from all tasks together, come to the driver.
    """
    counts = (
        df.select(F.col(value).cast("double").alias("v"))
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("v").agg(F.count("*").alias("n"))
    )
    rows, before, position = counts, 0, None
    try:
        while True:
            left = rows.count()
            if not left:
                return None
            if left <= few:
                ordered = sorted((r["v"], r["n"]) for r in rows.collect())
                if position is None:
                    position = (sum(n for _, n in ordered) - 1) * p
                return _interpolate(ordered, position, before)
            if rows is counts:
                rows = counts.persist()
            sample = rows.select("v").orderBy(F.xxhash64("v")).limit(ranges - 1).collect()
            cuts = sorted(r["v"] for r in sample)
            bounds = F.array(*[F.lit(c) for c in cuts])
            part = F.size(F.filter(bounds, lambda b: b < F.col("v")))
            sizes = rows.groupBy(part.alias("r")).agg(F.sum("n").alias("n")).orderBy("r").collect()
            if position is None:
                position = (sum(r["n"] for r in sizes) - 1) * p
            wanted = []
            upto, start = before, None
            for r in sizes:
                if upto + r["n"] > math.floor(position) and upto <= math.ceil(position):
                    wanted.append(r["r"])
                    start = upto if start is None else start
                upto += r["n"]
            # One range, or two neighbours when the position falls between them.
            before = start
            if wanted[0] > 0:
                rows = rows.where(F.col("v") > cuts[wanted[0] - 1])
            if wanted[-1] < len(cuts):
                rows = rows.where(F.col("v") <= cuts[wanted[-1]])
    finally:
        counts.unpersist()


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key. Each task keeps one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def take_first(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First n rows by an explicit order: a heap per task, no global sort."""
    return df.orderBy(*order).limit(n)


def topk(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """k best rows per group with their 1-based rank.

    Spark cuts every task to k rows per group before the shuffle. It does so up to
    its group-limit threshold; a larger k is cut per salted part of the group first.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.window.group.limit.threshold", "1000"))
    if k > limit:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        part = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= k)
        df = df.drop("_salt", "_rn")
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def ranked_within(df: DataFrame, by: str, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """All rows with their 1-based rank in their group, which is never in one task: its rows follow each other in one order."""
    placed = with_index(df, [by, *order], "_pos")
    first = placed.groupBy(F.col(by).alias("_by")).agg(F.min("_pos").alias("_first"))
    place = (F.col("_pos") - F.col("_first") + 1).cast("int")
    return placed.join(first, F.col(by).eqNullSafe(F.col("_by"))).withColumn(rank, place).drop("_pos", "_by", "_first")


def ranked_top(df: DataFrame, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """n best rows of the whole table, numbered from 1.

    Top-n by heap first, so the numbering window sees n rows only.
    """
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)))
