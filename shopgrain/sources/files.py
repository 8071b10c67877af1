"""Readers for raw files and writers for published tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shopgrain.operators.checkpoints import new_path
from shopgrain.operators.ordering import surrogate_id


#: A sign that no line holds: it separates nothing when lines are read, and marks where a row ends.
_END = "\x01"


def _csv_lines(spark: SparkSession, path: str, schema: T.StructType, extra: str, multi_line: bool) -> DataFrame:
    """(line, file) of all rows behind the headers; with ``multi_line`` rows with exactly one surplus field are missing.

    Lines are read as they are, by a separator that none holds. Rows with line breaks have to be parsed to find
    their ends: they are read with one column too many, and only rows with one surplus field fill it without
    an error and leave no raw line; no file is named.
    """
    reader = spark.read.options(header=True, enforceSchema=True, mode="PERMISSIVE")
    if not multi_line:
        lines = reader.schema("line string").options(sep=_END, quote="", escape="").csv(path)
        return lines.select("line", F.col("_metadata.file_path").alias("file")).where(F.col("line").isNotNull())
    raw = "_raw_line"
    caught = T.StructType([*schema.fields, T.StructField(extra, T.StringType()), T.StructField(raw, T.StringType())])
    reader = reader.schema(caught).options(multiLine=True, quote='"', escape='"')
    lines = reader.options(columnNameOfCorruptRecord=raw, columnPruning=False).csv(path)
    kept = lines.where(F.col(raw).isNotNull() & F.col(extra).isNull())
    return kept.select(F.col(raw).alias("line"), F.lit(None).cast("string").alias("file"))


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, extra: str = "_extra", multi_line: bool = False,
    corrupt_to: str | None = None,
) -> DataFrame:
    """CSV with a header; rows with too many fields are skipped, also if these are empty; short rows padded.

    A file is split over tasks unless ``multi_line`` asks for fields with line breaks. To every line one field is
    added: it shows where a row ends, and stands behind the schema if the row fits.

    With ``corrupt_to`` the rows that do not fit are published there as (line, file, reason), and the good rows come
    from the same read: it is written once, good and bad apart. Not for ``multi_line``, which can't see all bad rows.
    """
    if corrupt_to and multi_line:
        raise ValueError("rows with line breaks can't be put in quarantine")
    quoting = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    lines = _csv_lines(spark, path, schema, extra, multi_line)
    strings = ", ".join(f"`{f.name}` string" for f in [*schema, T.StructField(extra, T.StringType())])
    fields = lines.withColumn("f", F.from_csv(F.concat("line", F.lit("," + _END)), strings, quoting))
    last = F.col("f").getField(extra)
    short = F.array_contains(F.array(*(F.col("f").getField(f.name) for f in schema)), _END)
    fits = F.coalesce((last == _END) | (last.isNull() & short), F.lit(False))
    whole = F.from_csv(F.col("line"), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), quoting)
    if corrupt_to is None:
        return fields.where(fits).select(whole.alias("r")).select("r.*")
    staged = new_path(spark, "csv-lines")
    fields.select("line", "file", (~fits).alias("bad")).write.partitionBy("bad").parquet(staged)
    read = spark.read.schema("line string, file string, bad boolean").parquet(staged)
    reason = F.lit(f"more than {len(schema)} fields")
    publish(read.where("bad").select("line", "file", reason.alias("reason")), corrupt_to)
    return read.where("NOT bad").select(whole.alias("r")).select("r.*")


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A few rows as a table whose size Spark knows, so that joins can broadcast it."""
    arrow = pa.table(
        {f.name: pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(schema)}
    )
    return spark.createDataFrame(arrow, schema)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def spread(df: DataFrame) -> DataFrame:
    """A plain scan with fewer splits than cores is dealt out over all of them.

    For heavy per-row work on a table of one or two files. A table with many splits
    is left as it is, so nothing large is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or an empty frame of the schema when the path is missing."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def scan_first(
    spark: SparkSession, paths: Sequence[str], category: str = "predicted_category"
) -> DataFrame:
    """First table that exists; one without categories gets ``Other``."""
    for path in paths:
        if exists(spark, path):
            df = spark.read.parquet(path)
            return df if category in df.columns else df.withColumn(category, F.lit("Other"))
    raise FileNotFoundError(f"none of {list(paths)} exists")


# The article fields that are used.
NEWS_SCHEMA = T.StructType(
    [
        T.StructField(
            "articles",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("title", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField("content", T.StringType()),
                        T.StructField("publishedAt", T.StringType()),
                        T.StructField("url", T.StringType()),
                        T.StructField(
                            "source", T.StructType([T.StructField("name", T.StringType())])
                        ),
                    ]
                )
            ),
        )
    ]
)


def scan_news(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Responses, one a file; one a line (``multi_line=False``) lets Spark split large files."""
    return spark.read.schema(NEWS_SCHEMA).option("multiLine", multi_line).json(path)


def news_articles(responses: DataFrame, source: str = "news", cap: int | None = None) -> DataFrame:
    """Article lists to product-shaped rows; the text is the description, else the content.

    Articles are numbered by publication time and content; equal articles keep a number
    each. ``cap`` is the request's page limit and keeps the first ones.
    """
    rows = responses.select(F.inline("articles")).select(
        F.coalesce("title", F.lit("")).alias("product_name"),
        F.coalesce(F.nullif(F.col("description"), F.lit("")), F.col("content")).alias("review_text"),
        F.lit(source).alias("source"),
        F.coalesce("publishedAt", F.lit("")).alias("published_at"),
        F.coalesce("source.name", F.lit("")).alias("news_source"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("double").alias("price"),
    )
    key = F.concat_ws("|", "published_at", "url", "product_name", F.coalesce("review_text", F.lit("")))
    numbered = rows.withColumn("_key", key)
    if cap is not None:
        numbered = numbered.orderBy("_key").limit(cap)
    return surrogate_id(numbered, "NEWS_", "_key").drop("_key")


# Columns of the stored demand series.
DEMAND_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("category", T.StringType()),
        T.StructField("demand", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_of_month", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("trend", T.DoubleType()),
    ]
)


def demand_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DEMAND_SCHEMA).option("header", True).csv(path)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Replace a published table; Parquet unless CSV is asked for."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError("fmt is 'parquet' or 'csv'")


#: Name of the file that says which version of a published table is current.
POINTER = "_CURRENT"


def _hadoop(spark: SparkSession, path: str):
    """A path and the file system that holds it, wherever that is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write df as a new version of the table at ``path``, then make it the current one; returns its folder.

    The version is written whole beside the earlier ones. Readers see it only after the pointer file is
    replaced, which is one rename, so a run that is interrupted leaves the earlier table as it was, and a
    second run replaces the first. Earlier versions stay for readers that are under way; ``drop_versions``
    removes them.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    pointer, system = _hadoop(spark, f"{path}/{POINTER}")
    staged, _ = _hadoop(spark, f"{path}/{POINTER}-{version}")
    out = system.create(staged, True)
    out.write(bytearray(version, "ascii"))
    out.close()
    jvm = spark.sparkContext._jvm
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = overwrite
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.makeQualified(pointer).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(system.makeQualified(staged), system.makeQualified(pointer), kinds)
    return f"{path}/{version}"


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version of a published table; none if nothing was published."""
    pointer, system = _hadoop(spark, f"{path}/{POINTER}")
    if not system.exists(pointer):
        return None
    source = system.open(pointer)
    version = "".join(chr(source.read()) for _ in range(system.getFileStatus(pointer).getLen()))
    source.close()
    return f"{path}/{version}"


def published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a published table; filters on its partition columns prune folders."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(folder)


def drop_versions(spark: SparkSession, path: str) -> int:
    """Remove all versions but the current one; returns how many went."""
    folder, system = _hadoop(spark, path)
    current = current_version(spark, path)
    old = [
        s.getPath() for s in system.listStatus(folder)
        if s.getPath().getName().startswith("v-") and current and not current.endswith(s.getPath().getName())
    ]
    return sum(bool(system.delete(p, True)) for p in old)


def replace_slices(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only those slices of a partitioned table that df has rows of; the other slices stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_slice(df: DataFrame, test: Column, path: str) -> None:
    """Write only the rows that pass the test."""
    write_table(df.where(test), path)


def publish_slice(df: DataFrame, test: Column, path: str) -> DataFrame:
    """Publish the rows that pass the test as a table of their own and read them back."""
    publish(df.where(test), path)
    return published(df.sparkSession, path, df.schema)


def write_vectors(df: DataFrame, path: str, key: str, vector: str = "vector") -> None:
    """Key and vector, as single-precision arrays."""
    write_table(df.select(key, F.col(vector).cast("array<float>").alias("vector")), path)


def unpivot_trends(df: DataFrame, date: str = "date", flag: str = "isPartial") -> DataFrame:
    """One column per keyword to (date, keyword, search_interest)."""
    wide = df.drop(flag)
    keywords = [F.col("`" + c.replace("`", "``") + "`") for c in wide.columns if c != date]
    return wide.unpivot([date], keywords, "keyword", "search_interest")
