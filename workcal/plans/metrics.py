"""One-row run results, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import columns
from ..sources import from_rows

LANDING_METRICS = columns(
    "status string, total_records bigint, national_holidays bigint, state_holidays bigint, "
    "processing_time_seconds double, file_path string, dt_carga string"
)

BRONZE_METRICS = columns(
    "status string, records_processed bigint, valid_records bigint, invalid_records bigint, "
    "processing_time_seconds double, error_message string, ano int, mes int, particoes array<string>"
)


def silver_metrics_schema(rule_names: list[str]) -> T.StructType:
    counts = ["total_records", "successful_records", "error_records", *rule_names]
    return columns(
        "status string, "
        + ", ".join(f"{c} bigint" for c in counts)
        + ", processing_time_seconds double, error_message string"
    )


def one_row(spark: SparkSession, schema: T.StructType, **values) -> DataFrame:
    return from_rows(spark, [[values.get(name) for name in schema.names]], schema)
