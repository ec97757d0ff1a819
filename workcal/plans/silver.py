"""Bronze -> silver: clean, type, one row per key, mark, upsert."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean, conform, one_per_holiday
from ..operators.quality import HOLIDAY_RULES, Rule, apply_rules, metric_columns
from ..operators.upsert import upsert_table
from ..schemas import BRONZE, ERROR, HOLIDAY_KEY, PARTIAL, SILVER, SUCCESS
from ..scratch import scratch_dir
from ..sinks import observed
from ..sources import read_table
from .metrics import one_row, silver_metrics_schema

SILVER_PARTITIONS = ("ano", "mes")
# Columns that a newer version of a known holiday replaces.
SILVER_UPDATES = (
    "nome",
    "tipo",
    "silver_timestamp",
    "status_processamento",
    "validation_errors",
    "last_updated",
)
# What a record without a complete key is known by.
SILVER_RECORD = ("data", "nome", "tipo", "estado", "dt_processamento", "dt_carga", "validation_errors")


def validated_rows(
    bronze: DataFrame, load_ts: dt.datetime, rules: Sequence[Rule] = HOLIDAY_RULES
) -> DataFrame:
    """Cleaned, typed, one per key and marked; still with ``data_raw``."""
    return (
        bronze.transform(clean)
        .transform(conform, load_ts)
        .transform(one_per_holiday)
        .transform(apply_rules, rules)
    )


def silver_rows(
    bronze: DataFrame, load_ts: dt.datetime, rules: Sequence[Rule] = HOLIDAY_RULES
) -> DataFrame:
    return validated_rows(bronze, load_ts, rules).select(*SILVER.names)


def load_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    load_ts: dt.datetime,
    *,
    rules: Sequence[Rule] = HOLIDAY_RULES,
    dt_carga: str | None = None,
) -> tuple[DataFrame, list[Row]]:
    """Bring bronze into silver; returns the run's metrics and the partitions it changed.

    All of bronze is taken, or the rows of one load (``dt_carga``). The metrics
    are observed on the one write of the processed rows. A repeated load adds nothing.
    """
    started = time.perf_counter()
    names = [r.name for r in rules]

    def result(status: str, **values) -> DataFrame:
        return one_row(
            spark,
            silver_metrics_schema(names),
            status=status,
            processing_time_seconds=time.perf_counter() - started,
            **values,
        )

    try:
        bronze = read_table(spark, bronze_path, BRONZE)
        if dt_carga is not None:
            bronze = bronze.filter(F.col("dt_carga") == dt_carga)
        seen = Observation("silver")
        staged_path = scratch_dir(spark, "silver-load")
        (
            validated_rows(bronze, load_ts, rules)
            .observe(seen, *metric_columns(rules))
            .select(*SILVER.names)
            .write.parquet(staged_path)
        )
        counts = observed(seen)
        if not counts.get("total_records"):
            return result(ERROR, error_message="Nenhum registro em bronze"), []
        changed = upsert_table(
            read_table(spark, staged_path, SILVER),
            silver_path,
            SILVER,
            HOLIDAY_KEY,
            SILVER_PARTITIONS,
            partitions_follow_keys=True,
            update_if=f"source.status_processamento = '{SUCCESS}'",
            update_cols=SILVER_UPDATES,
            single_keys=True,
            null_keys="match",
            identity=SILVER_RECORD,
        )
    except (PySparkException, Py4JError) as error:
        return result(ERROR, error_message=f"Falha ao processar silver: {error}"), []
    if not counts["error_records"]:
        status = SUCCESS
    else:
        status = PARTIAL if counts["successful_records"] else ERROR
    return result(status, **counts), changed


def to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    load_ts: dt.datetime,
    *,
    rules: Sequence[Rule] = HOLIDAY_RULES,
    dt_carga: str | None = None,
) -> DataFrame:
    """``load_silver`` for its metrics alone."""
    return load_silver(spark, bronze_path, silver_path, load_ts, rules=rules, dt_carga=dt_carga)[0]
