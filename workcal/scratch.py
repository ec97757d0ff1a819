"""Working folders for intermediate tables.

An intermediate table goes to the shared folder that the cluster names in
``spark.checkpoint.dir``, so it survives the loss of executors. Where a session
has no such setting, the folder ``_scratch`` below its warehouse is used, which is
shared as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder path below the session's shared scratch folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/workcal/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` once and read it back.

    Later steps then reuse the rows instead of the plan behind them, a lost
    executor costs a re-read and not a re-run, and Spark knows the size on disk
    when it chooses a join.

    ``narrow`` is for tables of a few numbers a row whose plan ends in a shuffle: they are
    written in at most two files for each core of the cluster and not one for each partition.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if narrow:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
