"""Language by nearest centroid over TF-IDF vectors of letter n-grams.

A text's vector holds its one- to three-letter grams (lower case, other signs as one blank), hashed to
``DIMS`` places, weighted by (1 + log tf) * idf and normalised. Each language has up to ``CENTROIDS``
centroids from spherical k-means; the language of the most similar centroid wins. A text whose
cosine lies far below what texts of its language and length had in training is rejected.

Document frequencies, language sizes and rejection limits come from all labelled rows. Only the clustering
uses a sample: about ``sample`` rows a language, chosen by a hash of the id.

Defined results: null text or one without a letter is ``und`` with score 0 and rejected; nothing learned
gives ``und`` everywhere; ties go to the language that sorts first; repeated rows give repeated results;
other columns are kept. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import free_name, slices

DIMS, CENTROIDS, ROUNDS = 4096, 6, 12
SAMPLE = 1500
UNKNOWN = "und"
#: Of a low quantile of the cosines seen in training, what a text must reach to be accepted.
SLACK = 0.6
#: That quantile, rows below which there is none but the least, rows a limit should rest on, steps of a cosine.
LOW, FEW, ENOUGH, STEPS = 0.005, 20, 200, 1000
_BATCH_BYTES = 2 << 20


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed grams over the whole text; None if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # one blank after each word
    c = np.concatenate(([32], codes[kept], [32])).astype(np.uint64)
    pair = c[:-1] * np.uint64(0x1F123BB5) + c[1:]
    three = pair[:-1] * np.uint64(0x1F123BB5) + c[2:]
    mixed = np.concatenate((c[1:-1], pair + np.uint64(1 << 40), three + np.uint64(1 << 50)))
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return np.bincount((mixed >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int64), minlength=DIMS)


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and log2 of the number of letter grams (-1 without a letter)."""
    out, sizes = np.zeros((len(texts), DIMS), np.float32), np.full(len(texts), -1)
    for i, t in enumerate(texts):
        if (n := gram_counts(t)) is not None:
            out[i] = np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0) * idf
            sizes[i] = int(n.sum()).bit_length()
            norm = math.sqrt(float(out[i] @ out[i]))
            if norm:
                out[i] /= norm
    return out, sizes


def spherical_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids of unit rows: farthest-first start, then Lloyd steps by cosine."""
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centre = x[chosen].copy()
    for _ in range(rounds):
        own = (x @ centre.T).argmax(1)
        for j in range(len(centre)):
            if (own == j).any():
                total = x[own == j].sum(0)
                centre[j] = total / max(np.linalg.norm(total), 1e-12)
    return centre


@dataclass(frozen=True)
class Model:
    """Bounded by languages x ``CENTROIDS`` x ``DIMS``; languages[i] is that of centroid i."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: tuple[str, ...]
    lowest: dict[tuple[str, int], float]  # by language and log2 of a text's grams: a lower cosine is rejected

    def limit(self, lang: str, size: int) -> float:
        """That of the nearest length in training that is no longer; texts shorter than all are accepted."""
        near = max((z for l, z in self.lowest if l == lang and z <= size), default=-1)
        return self.lowest.get((lang, near), 0.0)

    def predict(self, texts: list[str | None]) -> list[dict]:
        x, sizes = vectors(texts, self.idf)
        if not self.languages:
            return [{"lang": UNKNOWN, "score": 0.0, "rejected": True}] * len(texts)
        cosine = x @ self.centroids.T
        best = cosine.argmax(1)
        out, limit = [], cache(self.limit)
        for i, size in enumerate(sizes):
            s = float(min(1.0, max(0.0, cosine[i, best[i]])))
            out.append(
                {"lang": (lang := self.languages[best[i]]), "score": s, "rejected": s < limit(lang, int(size))}
                if size >= 0 else {"lang": UNKNOWN, "score": 0.0, "rejected": True}
            )
        return out


def fit(df: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
        sample: int = SAMPLE) -> Model:
    """Learn from rows where ``learn`` holds and text and language are not null."""
    rows = df.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(key).cast("string")).alias("at"),
    )
    n, idf, sizes = _statistics(rows)
    if not n:
        return Model(idf, np.zeros((0, DIMS), np.float32), (), {})
    share = F.create_map(*(F.lit(x) for l, c in sorted(sizes.items()) for x in (l, min(1.0, sample / c))))
    sampled = rows.where((F.col("at") / 2.0**64 + 0.5) < share[F.col("lang")])
    learned = _clusters(sampled, idf, sample).collect()
    learned.sort(key=lambda r: r["lang"])
    centroids = [np.frombuffer(r["centroids"], np.float32).reshape(-1, DIMS) for r in learned]
    model = Model(
        idf, np.concatenate(centroids) if centroids else np.zeros((0, DIMS), np.float32),
        tuple(r["lang"] for r, c in zip(learned, centroids, strict=True) for _ in c), {},
    )
    return replace(model, lowest=_limits(rows, model)) if centroids else model


def _limits(rows: DataFrame, model: Model) -> dict[tuple[str, int], float]:
    """From the cosines of all rows, by the language predicted and length; they are counted in the tasks."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        m, held = shared.value, Counter()
        for batch in batches:
            for part in slices(batch["text"], _BATCH_BYTES):
                for i in range(0, len(part), 512):
                    x, sizes = vectors(part[i : i + 512].to_pylist(), m.idf)
                    cosine = x @ m.centroids.T
                    best = cosine.argmax(1)
                    step = (cosine[np.arange(len(x)), best].clip(0, 1) * STEPS).astype(int)
                    held.update((m.languages[j], z, c) for j, z, c in zip(best, sizes.tolist(), step.tolist()) if z >= 0)
        lang, size, step = zip(*held, strict=True) if held else ((), (), ())
        yield pa.RecordBatch.from_pydict(
            {"lang": lang, "size": size, "step": step, "n": list(held.values())},
            pa.schema([("lang", pa.string()), ("size", pa.int32()), ("step", pa.int32()), ("n", pa.int64())]),
        )

    counts = rows.select("text").mapInArrow(count, "lang string, size int, step int, n long")
    found: dict[str, dict[int, np.ndarray]] = {}
    for r in counts.groupBy("lang", "size", "step").agg(F.sum("n").alias("n")).collect():  # languages x 64 x STEPS at most
        found.setdefault(r["lang"], {}).setdefault(r["size"], np.zeros(STEPS + 1, np.int64))[r["step"]] = r["n"]
    return {(lang, size): SLACK * low(by, size) for lang, by in found.items() for size in by}


def low(by: dict[int, np.ndarray], size: int) -> float:
    """A low quantile of the cosines at a length; of few rows also those of shorter, then longer texts count."""
    pooled = np.zeros(STEPS + 1, np.int64)
    for z in (*sorted((z for z in by if z <= size), reverse=True), *sorted(z for z in by if z > size)):
        pooled = pooled + by[z]
        if pooled.sum() >= ENOUGH:
            break
    n = int(pooled.sum())
    skipped = math.ceil(LOW * n) if n >= FEW else 0
    return int(np.searchsorted(np.cumsum(pooled), skipped, side="right")) / STEPS


def _statistics(rows: DataFrame) -> tuple[int, np.ndarray, dict[str, int]]:
    """Of all rows: how many have letters, the weight of each place, and rows a language."""

    def count(batches):
        n, df, langs = 0, np.zeros(DIMS, np.int64), {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                if (c := gram_counts(text.as_py())) is not None:
                    n += 1
                    df += c > 0
                    langs[lang] = langs.get(lang, 0) + 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict(
            {"lang": [*langs, *[None] * len(at)], "place": [*[None] * len(langs), *at], "n": [*langs.values(), *df[at]]},
            pa.schema([("lang", pa.string()), ("place", pa.int32()), ("n", pa.int64())]),
        )

    counts = rows.select("lang", "text").mapInArrow(count, "lang string, place int, n long")
    found = counts.groupBy("lang", "place").agg(F.sum("n").alias("n")).collect()  # DIMS + languages rows at most
    sizes = {r["lang"]: r["n"] for r in found if r["place"] is None}
    n, df = sum(sizes.values()), np.zeros(DIMS)
    for r in found:
        if r["place"] is not None:
            df[r["place"]] = r["n"]
    return n, (np.log((1 + n) / (1 + df)) + 1).astype(np.float32), sizes


def _clusters(sampled: DataFrame, idf: np.ndarray, sample: int) -> DataFrame:
    """For each language its centroids."""

    def sparse(batches):
        for batch in batches:
            for part in slices(batch["text"], _BATCH_BYTES):
                for i, text in enumerate(part):
                    if (c := gram_counts(text.as_py())) is not None:
                        at = np.flatnonzero(c)
                        yield pa.RecordBatch.from_pydict(
                            {"lang": [batch["lang"][i].as_py()], "counts": [_pack(at, c[at])]},
                            pa.schema([("lang", pa.string()), ("counts", pa.binary())]),
                        )

    def cluster(key, rows):
        x = np.zeros((len(rows), DIMS), np.float32)
        for i, packed in enumerate(sorted(rows["counts"].to_pylist())):
            at, n = _unpack(packed)
            x[i, at] = (1 + np.log(n)) * idf[at]
            x[i] /= max(np.linalg.norm(x[i]), 1e-12)
        centre = spherical_means(x, CENTROIDS)
        return pa.table(
            {"lang": [key[0].as_py()], "centroids": [centre.astype(np.float32).tobytes()]},
            pa.schema([("lang", pa.string()), ("centroids", pa.binary())]),
        )

    counted = sampled.select("lang", "text").mapInArrow(sparse, "lang string, counts binary")
    return counted.groupBy("lang").applyInArrow(cluster, "lang string, centroids binary")


def _pack(at: np.ndarray, n: np.ndarray) -> bytes:
    return np.stack((at, n)).astype(np.int32).tobytes()


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.frombuffer(packed, np.int32).reshape(2, -1)
    return at, n


def identify(df: DataFrame, model: Model, text: str = "text", to: str = "language") -> DataFrame:
    """All columns of df and a struct of lang, score and rejected."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(texts), 512):
            out += shared.value.predict(texts[i : i + 512].to_pylist())
        return pa.array(out, kind)

    return df.withColumn(free_name(df, to), predict(F.col(text).cast("string")))
