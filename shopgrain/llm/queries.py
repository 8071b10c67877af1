"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import (
    decontamination,
    embedding_dedup,
    language_id,
    language_model,
    periodic_runs,
    pii,
    prefix_trie,
    secret_scan,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    vector_packing,
    warc,
)
from shopgrain.llm.common import held_out, learned_from, span_count, span_digest, table, text_or_empty
from shopgrain.operators.checkpoints import materialise, new_path

#: Shingles of the SimHash near-dedup, by its contract.
SIMHASH_WORDS = 4
MODEL = "piece_bpe_32k.model"
#: Tokenizer and sequence size of the packing, by its contract.
WORD_MODEL, SEQUENCE_TOKENS = "word_bpe_49k.json", 2048


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages").select("page_id", "url", "html"), new_path(spark, "warc")
    captures = warc.write_archives(pages, f"{folder}/archives")
    index = warc.build_index(captures, f"{folder}/index", f"{folder}/archives")
    records = warc.read_records(index, warc.lookup(index, pages))
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


OP1_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), r AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
    CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN r ON p.d = r.d
"""


def op2_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.contained(docs.select("doc_id", "text"), items.select("item_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shingles", "n_shared", "containment"
    )


OP2_SQL = """
WITH texts AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents
    UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
    SELECT side, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-/:-`{-\\x7f]+') AS w
    FROM texts
), shingles AS (
    SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS s
    FROM words, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 4))) AS i) WHERE len(w) > 0
), sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id),
shared AS (
    SELECT d.id AS doc_id, i.id AS item_id, count(*) AS m
    FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 'd' AND i.side = 'i' GROUP BY ALL
)
SELECT doc_id, item_id, n AS n_shingles, m AS n_shared, m / n AS containment
FROM shared JOIN sizes ON id = item_id WHERE m >= 0.8 * n - 1e-9
"""


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii")
    return found.select(
        "doc_id", *(span_count(spans, k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(span_digest(spans, pii.BASE), 256).alias("base_sha256"), span_digest(spans).alias("spans"),
        F.transform(spans, lambda s: s["score"]).alias("scores"),
    )


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


OP5_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.e) = len(b.e) AND list_dot_product(a.e, b.e)
        >= 0.93 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id,
    vec_id = least(vec_id, coalesce(l.b, vec_id)) AS kept
FROM embeddings LEFT JOIN least l ON l.a = vec_id LEFT JOIN counts c ON c.a = vec_id
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SIMHASH_WORDS)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(MODEL)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode(docs, model, decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, learned_from("doc_id", 3))
    found = language_id.identify(docs, model)
    return found.select(
        "doc_id", held_out("doc_id", 3).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"),
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = language_model.score(docs, learned_from("doc_id", 5))
    return found.withColumnRenamed("id", "doc_id").withColumn("held_out", held_out("doc_id", 5))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_versions(docs, new_path(spark, "ledger"))
    spans, base = F.col("findings"), [r.kind for r in secret_scan.BASE_RULES]
    return found.select(
        "doc_id", *(span_count(spans, k).alias(f"n_{k}") for k in base),
        F.sha2(span_digest(spans, base), 256).alias("base_sha256"), span_digest(spans).alias("spans"), "blob_id",
    )


def looped(docs: DataFrame) -> DataFrame:
    """Documents whose number's checksum ends in 0 repeat a part of their words to the end, as the contract derives them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(text_or_empty("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    changed = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(changed, words).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    a, n, w = F.col("a"), F.col("n"), F.col("w")
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    again = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int"))))
    return rows.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(looped(table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # The greatest length / period by cross products; the first of equals stays.
    best = F.aggregate(
        "runs", F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    rows = found.select("doc_id", "runs", best.alias("best"), lines.alias("lines"), "collapsed")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share first turns, as the contract derives them; and the ids of all."""
    known = conversations.where(F.col("conv_id").isNotNull())
    rows = known.select("conv_id", "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    places = materialise(prefix_trie.running(rows, "conv_id", ["turn", "role", "text"], "place"), "turns")
    ids = places.select("conv_id").distinct()
    shared = F.crc32(F.col("conv_id").cast("string")) % 6
    # At most five turns of a conversation are ever shared, with at most a hundred others.
    first = places.where(F.col("place") < 5).select(F.col("conv_id").alias("from"), "place", "role", "text")
    source = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("from"))
    copied = source.join(first, "from").where(F.col("place") < shared)
    own = places.where(F.col("place") >= shared)
    columns = ["conv_id", F.col("place").alias("turn"), "role", "text"]
    return own.select(*columns).unionByName(copied.select(*columns)), ids


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))


#: crc32 of a text of digits, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)"""

OP12_SQL = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (SELECT conv_id, {_CRC.format('conv_id')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
turns AS (
    SELECT conv_id, place, role, text FROM t JOIN ids USING (conv_id) WHERE place >= h
    UNION ALL
    SELECT i.conv_id, place, role, text FROM ids i JOIN t ON t.conv_id = i.conv_id - i.conv_id % 100 WHERE place < h
), whole AS (
    SELECT conv_id, coalesce(s, []) AS s, coalesce(n, []) AS n FROM ids LEFT JOIN (
        SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY place) AS s,
            list(length(text) ORDER BY place) AS n FROM turns GROUP BY 1) USING (conv_id)
), prefixes AS (
    SELECT conv_id, d, s[1:d] AS path, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS size, d = len(s) AS last
    FROM whole, LATERAL (SELECT unnest(generate_series(0, len(s))) AS d)
), nodes AS (
    SELECT path, d, min(conv_id) AS c, count(*) AS n_convs, max(size) AS size,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends
    FROM prefixes GROUP BY path, d
), children AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (
    SELECT a.path, sum((k.n IS NULL)::INT) AS leaves, sum((b.n_convs - 1) * b.size) AS saved
    FROM nodes a JOIN nodes b ON b.d >= a.d AND b.path[1:a.d] = a.path LEFT JOIN children k ON k.path = b.path GROUP BY 1
)
SELECT a.c AS conv_id, a.d AS depth, p.c AS parent_conv_id, a.n_convs, coalesce(k.n, 0) AS n_children,
    leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, a.ends AS ends_sha256
FROM nodes a JOIN sums ON sums.path = a.path LEFT JOIN children k ON k.path = a.path
    LEFT JOIN nodes p ON p.d = a.d - 1 AND p.path = a.path[1:a.d - 1]
"""


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = vector_packing.cut(docs, public_tokenizers.path(WORD_MODEL), SEQUENCE_TOKENS, "doc_id")
    pieces = pieces.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    # Neither documents nor attention bind before tokens do: the fewest sequences are asked for.
    room = vector_packing.Capacity(SEQUENCE_TOKENS, SEQUENCE_TOKENS, SEQUENCE_TOKENS**2)
    return vector_packing.pack(pieces, room)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc, op2_containment, op3_pii, op4_suffixes, op5_embeddings, op6_simhash, op7_sentencepiece, op8_language, op9_language_model, op10_secrets, op11_runs, op12_prefix_trie, op13_packing)
}
ORACLE: dict[str, str] = {"op1_warc": OP1_SQL, "op2_containment": OP2_SQL, "op5_embeddings": OP5_SQL, "op12_prefix_trie": OP12_SQL}
