"""File readers. Every reader takes the schema: none infers one from the data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schemas import CORRUPT
from ..storage import exists


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Rows held by the caller as a table.

    They travel as Arrow, which gives a local relation: Spark knows its size, so
    its own broadcast threshold applies to it.
    """
    arrow = to_arrow_schema(schema)
    rows = list(rows)
    columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = False
) -> DataFrame:
    """JSON lines with the text of unreadable lines in ``_corrupt_record``.

    ``multi_line`` reads one document per file instead of one per line.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .json(path)
    )


def _json_keys(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.json_object_keys("value").alias("keys"))


def _carries(column: str) -> Column:
    return F.coalesce(F.array_contains("keys", column), F.lit(False))


def json_columns_seen(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """For each column, how many JSON lines carry it: ``(coluna, registros, presente)``."""
    counted = _json_keys(spark, path).agg(
        *(F.count_if(_carries(c)).alias(f"n{i}") for i, c in enumerate(columns))
    )
    entries = [
        F.struct(F.lit(c).alias("coluna"), F.col(f"n{i}").alias("registros"))
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*entries))).withColumn(
        "presente", F.col("registros") > 0
    )


def missing_json_columns(spark: SparkSession, path: str, required: Sequence[str]) -> list[str]:
    """Required columns that no JSON line carries.

    A single line with all of them settles it, and ``limit`` stops the scan
    there; the full scan runs only for a file where no such line exists.
    """
    whole = F.lit(True)
    for column in required:
        whole = whole & _carries(column)
    if not _json_keys(spark, path).filter(whole).isEmpty():
        return []
    seen = json_columns_seen(spark, path, required)
    absent = {row.coluna for row in seen.filter(~F.col("presente")).collect()}
    return [c for c in required if c in absent]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line. Without a schema every column is text."""
    reader = spark.read.option("header", True)
    if schema is not None:
        # The header must name the columns of the schema, in its order.
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, fmt: str = "parquet"
) -> DataFrame:
    """A lake table. ``fmt`` may name any format installed in the session."""
    reader = spark.read.format(fmt)
    if schema is None:
        return reader.load(path)
    return reader.schema(schema).load(path).select(*schema.names)


def in_partitions(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of a partitioned table whose partition is listed in ``wanted``.

    The columns of ``wanted`` are partition columns. A list that Spark measures to be small
    prunes the scan while the query runs (dynamic partition pruning): files of other
    partitions are not opened. NULL partitions are in no list.
    """
    # The planner prunes by a list with a comparison on it; this one holds for every value.
    listed = wanted.filter(F.col(wanted.columns[0]).cast("string") >= "")
    return table.join(listed, wanted.columns, "left_semi")


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when there is a folder or file at ``path``, on whatever file system it names."""
    return exists(spark, path)
