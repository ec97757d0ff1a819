"""Landing -> bronze: lineage, validity, upsert per load."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import load_stamp
from ..operators.upsert import upsert_table
from ..schemas import (
    BRONZE,
    CORRUPT,
    FILE_ERROR,
    FILE_INVALID,
    FILE_PROCESSED,
    HOLIDAY_KEY,
    INVALID,
    LANDING,
    REQUIRED_COLUMNS,
    VALID,
)
from ..scratch import scratch_dir
from ..sinks import observed, write_partitioned
from ..sources import missing_json_columns, read_json_lines, read_table, table_exists
from .metrics import BRONZE_METRICS, one_row

BRONZE_PARTITIONS = ("ano_particao", "mes_particao")
QUARANTINE = T.StructType([*BRONZE.fields, T.StructField(CORRUPT, T.StringType())])


def bronze_rows(
    spark: SparkSession, file_path: str, partition_date: dt.date, load_ts: dt.datetime
) -> DataFrame:
    """The landed records with lineage, validity and the partition of the load.

    ``_corrupt_record`` holds the text of the lines that could not be read.
    """
    corrupt = F.col(CORRUPT)
    return (
        read_json_lines(spark, file_path, LANDING)
        .withColumns(
            {
                "source_file": F.col("_metadata.file_path"),
                "bronze_ingestion_tsp": load_stamp(load_ts),
                "status_processamento": F.when(corrupt.isNull(), VALID).otherwise(INVALID),
                "ano_particao": F.lit(partition_date.year),
                "mes_particao": F.lit(partition_date.month),
            }
        )
        .select(*BRONZE.names, CORRUPT)
    )


def to_bronze(
    spark: SparkSession,
    file_path: str,
    bronze_path: str,
    quarantine_path: str,
    partition_date: dt.date,
    load_ts: dt.datetime,
    *,
    keep_first: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Load one landed file; returns its metrics.

    The file is parsed once, into a staged table. Valid records are upserted; one without
    a complete key is known by all that was landed of it. Unreadable lines are added to the
    quarantine table before, once per file and text. So a repeated load adds nothing.
    ``particoes`` lists the partitions that the load changed. A file that lacks a required column gives
    status INVALID and writes nothing. Any failure gives status ERROR; a load that fails
    while it is stored can be repeated.
    """
    started = time.perf_counter()

    def result(status: str, **values) -> DataFrame:
        seconds = time.perf_counter() - started
        return one_row(
            spark, BRONZE_METRICS, status=status, processing_time_seconds=seconds, **values
        )

    try:
        missing = missing_json_columns(spark, file_path, REQUIRED_COLUMNS)
        if missing:
            return result(
                FILE_INVALID,
                records_processed=spark.read.text(file_path).count(),
                error_message=f"Colunas ausentes: {', '.join(missing)}",
            )
        seen = Observation("bronze")
        valid = F.col("status_processamento") == VALID
        staged_path = scratch_dir(spark, "bronze-load")
        (
            bronze_rows(spark, file_path, partition_date, load_ts)
            .observe(
                seen,
                F.count("*").alias("records_processed"),
                F.count_if(valid).alias("valid_records"),
                F.count_if(~valid).alias("invalid_records"),
            )
            .write.parquet(staged_path)
        )
        counts = {"records_processed": 0, "valid_records": 0, "invalid_records": 0} | observed(seen)
        staged = read_table(spark, staged_path, QUARANTINE)
        if counts["invalid_records"]:
            unreadable = staged.filter(~valid)
            if table_exists(spark, quarantine_path):
                known = read_table(spark, quarantine_path, QUARANTINE)
                unreadable = unreadable.join(known, ["source_file", CORRUPT], "left_anti")
                unreadable = unreadable.select(*QUARANTINE.names)
            write_partitioned(unreadable, quarantine_path, BRONZE_PARTITIONS)
        written = upsert_table(
            staged.filter(valid).drop(CORRUPT),
            bronze_path,
            BRONZE,
            HOLIDAY_KEY,
            BRONZE_PARTITIONS,
            partitions_follow_keys=False,
            keep_first=keep_first,
            null_keys="match",
            identity=LANDING.names,
        )
    except (PySparkException, Py4JError) as error:
        return result(FILE_ERROR, records_processed=0, error_message=f"Falha ao carregar o arquivo: {error}")
    particoes = [f"{part.ano_particao}-{part.mes_particao:02d}" for part in written]
    return result(
        FILE_PROCESSED, **counts, ano=partition_date.year, mes=partition_date.month, particoes=particoes
    )
