"""Run report over all layers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = (
    "total_records",
    "national_holidays",
    "state_holidays",
    "successful_records",
    "error_records",
    "total_holidays",
    "working_days",
)


def _lines(
    metrics: DataFrame, layer: str, item: Column, keep: Sequence[str] = (), **columns: str
) -> DataFrame:
    counts = (
        F.col(columns[name]).cast("long") if name in columns else F.lit(None).cast("long")
        for name in COUNTS
    )
    return metrics.select(
        F.lit(layer).alias("camada"),
        item.alias("item"),
        F.col(columns["ano"]).cast("int").alias("ano") if "ano" in columns else F.lit(None).cast("int").alias("ano"),
        F.col(columns["status"]).alias("status"),
        *(c.alias(n) for n, c in zip(COUNTS, counts)),
        *(F.col(c) for c in keep),
    )


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# What each layer calls the columns of the report.
_COLUMNS = {
    "landing": _same("status", "total_records", "national_holidays", "state_holidays"),
    "bronze": {
        "status": "status",
        "total_records": "records_processed",
        "successful_records": "valid_records",
        "error_records": "invalid_records",
    },
    "silver": _same("status", "total_records", "successful_records", "error_records"),
    "gold": {"status": "processing_status", **_same("ano", "total_holidays", "working_days")},
}


def layer_lines(metrics: DataFrame, layer: str, keep: Sequence[str] = ()) -> DataFrame:
    """The report's lines for the metrics a layer returned: one, or one per region and year;
    with the columns ``keep`` of the metrics."""
    item = F.col("regiao") if layer == "gold" else F.lit("total")
    return _lines(metrics, layer, item, keep, **_COLUMNS[layer])


def run_report(
    landing: DataFrame, bronze: DataFrame, silver: DataFrame, gold: DataFrame
) -> DataFrame:
    """One line per layer, and per region and year, from the metrics the layers returned."""
    metrics = {"landing": landing, "bronze": bronze, "silver": silver, "gold": gold}
    return reduce(DataFrame.unionByName, (layer_lines(m, layer) for layer, m in metrics.items()))
