"""TF-IDF as a long table (key, term, weight) and search over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.functions.dictionaries import STOP_WORDS
from shopgrain.operators.checkpoints import materialise

#: Hash buckets whose loads bound the counts of terms; a task holds one number for each.
BUCKETS = 1 << 20


def term_list(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Words of two or more characters without the stop words."""
    split = F.split(F.lower(text), r"[^\p{L}\p{N}_]+")
    return F.filter(split, lambda w: (F.length(w) > 1) & ~w.isin(list(stop_words)))


def terms_of(tokens: Column, bigrams: bool = True) -> Column:
    """The words of a text and, with ``bigrams``, the pairs of neighbours."""
    if not bigrams:
        return tokens
    pairs = F.transform(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get(tokens, i + 1)),
    )
    return F.concat(tokens, pairs)


def term_counts(
    df: DataFrame, key: str, text: str, stop_words: Sequence[str] = STOP_WORDS, bigrams: bool = True
) -> DataFrame:
    """(key, term, tf); equal terms of a text merge before the shuffle."""
    tokens = df.select(key, term_list(F.col(text), stop_words).alias("_t"))
    return (
        tokens.select(key, F.explode(terms_of(F.col("_t"), bigrams)).alias("term"))
        .groupBy(key, "term").agg(F.count("*").alias("tf"))
    )


def _bucket(term: str = "term") -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def frequent_terms(tokens: DataFrame, max_terms: int, bigrams: bool = True) -> DataFrame | None:
    """(bucket): hash buckets that hold every term which can be among the ``max_terms`` most frequent.

    The ``max_terms``-th most frequent word occurs n times, so no term that occurs less often is wanted, and a
    term occurs at most as often as all terms of its bucket (Park, Chen and Yu). None if any term can be wanted.
    """
    words = tokens.select(F.explode("_t").alias("term")).groupBy("term").agg(F.count("*").alias("total"))
    top = words.orderBy(F.desc("total")).limit(max_terms)
    found, least = top.agg(F.count("*"), F.min("total")).first()
    if found < max_terms or least < 2:
        return None
    terms = tokens.select(F.explode(terms_of(F.col("_t"), bigrams)).alias("term"))
    loads = terms.select(_bucket().alias("bucket")).groupBy("bucket").agg(F.count("*").alias("load"))
    return materialise(loads.where(F.col("load") >= least).select("bucket"), "buckets")


def vocabulary(counts: DataFrame, n_docs: Column, max_terms: int | None = None) -> DataFrame:
    """Terms, all or the ``max_terms`` most frequent, with their smooth inverse document frequency."""
    found = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
    if max_terms is not None:
        found = found.orderBy(F.desc("total"), "term").limit(max_terms)
    return (
        found.withColumn("idf", F.log((1 + n_docs) / (1 + F.col("df"))) + 1)
        .select("term", "df", "idf")
    )


def weigh(counts: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """Sublinear tf times idf, scaled to unit length per key.

    Spark sends a small vocabulary to all tasks and shuffles a large one. A key has at most
    as many rows as its text has terms.
    """
    raw = counts.join(vocab.select("term", "idf"), "term").withColumn(
        "_w", (1 + F.log("tf")) * F.col("idf")
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("_w") / norm).alias("weight"))


def tfidf(
    df: DataFrame, key: str, text: str, max_terms: int | None = None,
    stop_words: Sequence[str] = STOP_WORDS, bigrams: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(weights, vocabulary) of a table of texts.

    With ``max_terms``, rows of terms that are too rare for the vocabulary are dropped before any shuffle. Rows are
    dealt by key alone, which serves the counts and the lengths alike.
    """
    tokens = materialise(df.select(key, term_list(F.col(text), stop_words).alias("_t")), "tokens")
    terms = tokens.select(key, F.explode(terms_of(F.col("_t"), bigrams)).alias("term"))
    kept = None if max_terms is None else frequent_terms(tokens, max_terms, bigrams)
    if kept is not None:
        terms = terms.withColumn("bucket", _bucket()).join(kept, "bucket", "left_semi").select(key, "term")
    n_docs = F.lit(tokens.count())
    counts = terms.groupBy(key, "term").agg(F.count("*").alias("tf"))
    if max_terms is None:
        vocab = vocabulary(counts, n_docs)
        return weigh(counts, key, vocab), vocab
    vocab = materialise(vocabulary(counts, n_docs, max_terms), "vocabulary")
    wanted = terms.join(vocab.select("term"), "term", "left_semi").select(key, "term")
    return weigh(wanted.repartition(key).groupBy(key, "term").agg(F.count("*").alias("tf")), key, vocab), vocab


def project(
    queries: DataFrame, key: str, text: str, vocab: DataFrame,
    stop_words: Sequence[str] = STOP_WORDS, bigrams: bool = True,
) -> DataFrame:
    """Weights of new texts on an existing vocabulary."""
    return weigh(term_counts(queries, key, text, stop_words, bigrams), key, vocab)


def sparse_cosine(queries: DataFrame, items: DataFrame, query_key: str, item_key: str) -> DataFrame:
    """(query, item, cosine) for pairs that share a term.

    Work follows the postings of the query terms. Spark broadcasts the query side
    when it is small and splits a hot term's partition when it is not.
    """
    q = queries.withColumnRenamed("weight", "_qw")
    return (
        q.join(items, "term")
        .groupBy(query_key, item_key)
        .agg(F.sum(F.col("_qw") * F.col("weight")).alias("cosine"))
    )
