"""Secrets in all versions of many files, each distinct content scanned once per rule version.

Every version (a row with a text) is addressed by the SHA-256 of its text. A ledger in a shared folder
records which rules, in which version, have been run on which blob and what they found. A scan runs
only pairs of blob and rule version that the ledger does not hold, appends to the ledger, and joins
the findings back to every row that has the blob.

Defined results: a null text is the empty text; repeated rows give repeated results; an empty table
gives an empty result; a blob without findings has an empty list; other columns are kept as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm.common import columns_of, free_name, text_or_empty
from shopgrain.operators.checkpoints import materialise


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches whose group is at least ``least`` long; shorter ones are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()  # one of them, in lower case, is in every text with a match
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule(
        "assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8, ("passw", "secret", "token", "api"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, ("akia",)),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", hints=("private key",)),
    # Only at the start of a word, and without going back in it: linear however often a text says "eyJ".
    Rule(
        "jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", hints=("eyj",),
        version=2,
    ),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,255}", hints=("gh",)),
)
RULES = BASE_RULES + EXTRA_RULES

SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
SPANS_ARROW = pa.list_(
    pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
)
LEDGER = f"blob_id string, rules array<string>, findings {SPANS}"


def find_secrets(text: str, rules: tuple[Rule, ...], pending: set[str]) -> list[dict]:
    found, low = [], text.lower()
    for rank, rule in enumerate(rules):
        if rule.key in pending and (not rule.hints or any(h in low for h in rule.hints)):
            for m in re.finditer(rule.pattern, text):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found.append({"start": m.start(), "rank": rank, "kind": rule.kind, "end": m.end()})
    return found


def _finder(rules: tuple[Rule, ...]):
    @F.arrow_udf(SPANS)
    def find(texts: pa.Array, pending: pa.Array) -> pa.Array:
        return pa.array(
            [find_secrets(t.as_py(), rules, set(p.as_py())) for t, p in zip(texts, pending, strict=True)],
            SPANS_ARROW,
        )

    return find


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger of a folder; one that does not exist yet is made empty."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan_versions(
    versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """All columns of ``versions``, and blob_id and findings (by start, then order of the rules).

    Texts are moved once, to bring copies of a blob together after a first step in each task;
    the findings return over blob ids alone.
    """
    spark = versions.sparkSession
    blob, findings = free_name(versions, "blob_id"), free_name(versions, "findings")
    keyed = versions.withColumn(blob, F.sha2(text_or_empty(text), 256))
    blobs = keyed.groupBy(F.col(blob).alias("blob_id")).agg(F.first(text_or_empty(text)).alias("text"))
    wanted = F.array(*(F.lit(r.key) for r in rules))
    seen = read_ledger(spark, ledger).groupBy("blob_id").agg(F.flatten(F.collect_set("rules")).alias("seen"))
    pending = (
        blobs.join(seen, "blob_id", "left")
        .withColumn("rules", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        .where(F.size("rules") > 0)
    )
    pending.select("blob_id", "rules", _finder(rules)("text", "rules").alias("findings")).write.mode("append").parquet(
        ledger
    )
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    # Stored, so that its side of the join is a shuffle of its own and Spark can split a blob with many rows.
    known = materialise(
        spark.read.schema(LEDGER).parquet(ledger)
        .where((F.size("findings") > 0) & F.arrays_overlap("rules", wanted))
        .withColumn("findings", _of_these(F.col("findings"), F.col("rules"), rules, kinds))
        .groupBy(F.col("blob_id").alias(blob))
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("findings")))).alias(findings)),
        "findings",
    )
    none = F.array().cast(SPANS)
    return keyed.join(known, blob, "left").select(
        *columns_of(versions), blob, F.coalesce(F.col(findings), none).alias(findings)
    )


def _of_these(found: Column, ran: Column, rules: tuple[Rule, ...], kinds: Column) -> Column:
    """Findings of the current rule versions, ranked in their present order."""
    current = F.create_map(*(x for r in rules for x in (F.lit(r.kind), F.lit(r.key))))
    kept = F.filter(found, lambda s: F.array_contains(ran, current[s["kind"]]))
    return F.transform(
        kept,
        lambda s: F.struct(
            s["start"], (F.array_position(kinds, s["kind"]) - 1).cast("int").alias("rank"), s["kind"], s["end"]
        ),
    )


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every found span replaced by a mark; overlapping spans give one mark."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, spans in zip(texts, found, strict=True):
            if not spans.is_valid or not len(spans.values):
                out.append(t.as_py())
                continue
            t, parts, at, done = t.as_py(), [], 0, -1
            for s in sorted(spans.as_py(), key=lambda s: (s["start"], s["end"])):
                if s["start"] >= done:
                    parts += [t[at : s["start"]], mark]
                done = at = max(at, s["end"])
            out.append("".join(parts) + t[at:])
        return pa.array(out, pa.string())

    return cut(text, findings)
