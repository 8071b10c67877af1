"""Forecast, ranking and classification metrics, and the splits they need."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.operators.ordering import topk, with_index
from shopgrain.operators.recommend import hits


def hash_key(seed: int, *cols: str | Column) -> Column:
    """Hex digest of a seed and key columns: a stable random order any engine can repeat."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def share_cut(share: float) -> str:
    """Eight hex digits below which the given share of digests falls."""
    return f"{min(int(share * 2**32), 2**32 - 1):08x}"


def split(
    df: DataFrame, keys: Sequence[str], shares: Sequence[float] = (0.70, 0.15, 0.15),
    names: Sequence[str] = ("train", "validation", "test"), seed: int = 42,
) -> DataFrame:
    """Assign each row to a part by the hash of its key, the same in every run."""
    digest = F.substring(hash_key(seed, *keys), 1, 8)
    out, upto = None, 0.0
    for share, name in list(zip(shares, names))[:-1]:
        upto += share
        test = digest < share_cut(upto)
        out = F.when(test, name) if out is None else out.when(test, name)
    return df.withColumn("part", out.otherwise(names[-1]))


def holdout(interactions: DataFrame, frac: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(training, held-out) interactions. Each pair is drawn by its own hash, so a user
    with very many interactions needs no sort."""
    late = F.substring(hash_key(seed, "user_id", "item_id"), 1, 8) < share_cut(frac)
    return interactions.where(~late), interactions.where(late)


def balanced_sample(
    df: DataFrame, by: str, key: str, total: int, floor: int = 50, seed: int = 42
) -> DataFrame:
    """Up to max(total / categories, floor) rows per category, then at most total rows.

    Larger categories come first when the total cuts the sample.
    """
    counts = df.groupBy(by).agg(F.count("*").alias("_size"))
    quota = counts.agg(F.greatest(F.floor(F.lit(total) / F.count("*")), F.lit(floor))).scalar()
    keyed = df.withColumn("_h", hash_key(seed, key))
    # The quota is at most max(total, floor): cut to that first, then to the quota itself.
    most = topk(keyed, [by], [F.asc("_h"), F.asc(key)], max(total, floor), "_rn")
    chosen = most.where(F.col("_rn") <= quota).join(counts, by)
    return (
        chosen.orderBy(F.desc("_size"), by, "_h", key).limit(total).drop("_h", "_rn", "_size")
    )


def forecast_metrics(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Error measures per model from arrays ``y`` and ``yhat``.

    MAPE keeps its 1e-8 in the divisor and so explodes near 0; sMAPE and WAPE are the
    usable forms. Direction compares the sign of last minus first.
    """
    ends = [F.signum(F.element_at(c, -1) - F.element_at(c, 1)) for c in ("y", "yhat")]
    rows = df.select(
        *by,
        (ends[0] == ends[1]).cast("int").alias("_dir"),
        F.size("y").alias("_n"),
        F.zip_with("y", "yhat", lambda a, b: F.abs(a - b)).alias("_e"),
        F.zip_with("y", "yhat", lambda a, b: F.abs((b - a) / (a + 1e-8))).alias("_p"),
        F.zip_with(
            "y", "yhat",
            lambda a, b: F.coalesce(F.try_divide(2 * F.abs(a - b), F.abs(a) + F.abs(b)), F.lit(0.0)),
        ).alias("_s"),
        F.transform("y", F.abs).alias("_y"),
    )

    def total(c: str, f=lambda x: x) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda s, x: s + f(x))

    sums = rows.groupBy(*by).agg(
        F.sum("_n").alias("_n"), F.avg("_dir").alias("_dir"),
        F.sum(total("_e")).alias("_e"), F.sum(total("_e", lambda x: x * x)).alias("_e2"),
        F.sum(total("_p")).alias("_p"), F.sum(total("_s")).alias("_s"), F.sum(total("_y")).alias("_y"),
    )
    n = F.col("_n")
    return sums.select(
        *by,
        (F.col("_e") / n).alias("mae"),
        F.sqrt(F.col("_e2") / n).alias("rmse"),
        (F.col("_p") / n * 100).alias("mape"),
        (F.col("_s") / n * 100).alias("smape"),
        (F.try_divide(F.col("_e"), F.col("_y")) * 100).alias("wape"),
        F.col("_dir").alias("dir_acc"),
    )


def best_model(metrics: DataFrame, baseline: str) -> DataFrame:
    """Model with the smallest MAE and its gain over the baseline in percent."""
    base = F.max(F.when(F.col("model") == baseline, F.col("mae")))
    best = F.min(F.when(F.col("model") != baseline, F.struct("mae", "model")))
    return metrics.agg(base.alias("baseline_mae"), best.alias("_b")).select(
        F.col("_b.model").alias("best_model"), F.col("_b.mae").alias("mae"), "baseline_mae",
        (F.try_divide(F.col("baseline_mae") - F.col("_b.mae"), F.col("baseline_mae")) * 100)
        .alias("improvement_pct"),
    )


def relevant_items(interactions: DataFrame, held_out: DataFrame) -> DataFrame:
    """Held-out items with at least the user's median score.

    Scores are on a scale of 41 steps, so the exact median keeps 41 counters a user.
    """
    medians = interactions.groupBy("user_id").agg(F.median("score").alias("_median"))
    return held_out.join(medians, "user_id").where("score >= _median").select("user_id", "item_id")


def ranking_metrics(recs: DataFrame, relevant: DataFrame, k: int = 10) -> DataFrame:
    """Precision, recall, NDCG and F1 at k, averaged over users with a relevant item.

    recs: ``user_id, item_id, rank``.
    """
    gains = [1 / math.log2(i + 2) for i in range(k)]
    ideal = F.array(*[F.lit(sum(gains[: i + 1])) for i in range(k)])
    found = hits(recs.where(F.col("rank") <= k), relevant).groupBy("user_id").agg(
        F.count("*").alias("_hits"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("_dcg")
    )
    users = relevant.groupBy("user_id").agg(F.count("*").alias("_rel")).join(found, "user_id", "left")
    n_hits = F.coalesce("_hits", F.lit(0))
    best = F.element_at(ideal, F.least(F.col("_rel"), F.lit(k)).cast("int"))
    means = users.agg(
        F.count("*").alias("users"),
        F.avg(n_hits / k).alias("p"),
        F.avg(n_hits / F.col("_rel")).alias("r"),
        F.avg(F.coalesce("_dcg", F.lit(0.0)) / best).alias("n"),
    )
    p, r = F.col("p"), F.col("r")
    return means.select(
        "users", p.alias("precision_at_k"), r.alias("recall_at_k"), F.col("n").alias("ndcg_at_k"),
        (2 * p * r / (p + r + 1e-8)).alias("f1_at_k"),
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Label, prediction and count."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1 per class, and accuracy, macro F1 and weighted F1 as (metric, class, value)."""
    cells = confusion(df, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("truth"), F.lit(0).cast("bigint").alias("said")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("truth"), F.col("n").alias("said")),
    )
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    per_class = (
        cells.select((right / 2).alias("right"), F.inline(sides))
        .groupBy("class")
        .agg(F.sum("right").alias("tp"), F.sum("truth").alias("truth"), F.sum("said").alias("said"))
        .where("class IS NOT NULL")
        .withColumn(
            "f1", F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("truth") + F.col("said")), F.lit(0.0))
        )
    )
    total = F.sum("truth")
    overall = per_class.agg(
        (F.sum("tp") / total).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("truth")) / total).alias("weighted_f1"),
    ).unpivot([], ["accuracy", "macro_f1", "weighted_f1"], "metric", "value")
    rows = per_class.select(
        F.lit("f1").alias("metric"), F.col("class").cast("string").alias("class"), F.col("f1").alias("value")
    )
    return rows.unionByName(overall.select("metric", F.lit("").alias("class"), "value"))


def label_index(df: DataFrame, col: str) -> DataFrame:
    """Distinct values numbered from 0 in order."""
    return with_index(df.select(col).where(F.col(col).isNotNull()).distinct(), col, "label_idx")
