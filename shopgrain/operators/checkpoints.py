"""Cutting lineage through tables written to reliable storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one is made in local mode only."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="shopgrain-")
    sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/shopgrain/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df as Parquet in the shared folder and go on from the written copy.

    For tables that are read several times: later reads prune columns, know the size,
    and do not depend on the executors that computed them.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
