"""Rules as data: mark the rows that break them, and count per rule in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ERROR, NATIONAL, PARTIAL, SUCCESS


class Rule(NamedTuple):
    name: str
    condition: str  # SQL boolean; a row breaks the rule where it is false
    message: str

    @property
    def broken(self) -> Column:
        return ~F.expr(self.condition)


# Names and messages are stored with the rows.
_DATE_NULL = ("data_not_null", "Data não pode ser nula")
_STATE = ("estado_valid", "Estado inválido")
_NAME = ("nome_not_empty", "Nome do feriado não pode ser vazio")
_DATE_FORMAT = ("data_format", "Formato de data inválido")


def _rule(key: tuple[str, str], condition: str) -> Rule:
    return Rule(key[0], condition, key[1])


_NAME_RULE = _rule(_NAME, "coalesce(trim(nome), '') <> ''")

# On typed rows: an unreadable date is also a missing one, and only two-letter
# states pass, which excludes the national scope.
LITERAL_RULES = [
    _rule(_DATE_NULL, "data IS NOT NULL"),
    _rule(_STATE, "coalesce(length(estado), 0) = 2"),
    _NAME_RULE,
    _rule(_DATE_FORMAT, "try_to_date(CAST(data AS STRING), 'yyyy-MM-dd') IS NOT NULL"),
]

# The rules of the holiday lake: missing and unreadable dates are told apart by
# the raw text, and the national scope is a valid state.
HOLIDAY_RULES = [
    _rule(_DATE_NULL, "data_raw IS NOT NULL"),
    _rule(_STATE, f"coalesce(estado = '{NATIONAL}' OR length(estado) = 2, false)"),
    _NAME_RULE,
    _rule(_DATE_FORMAT, "data_raw IS NULL OR data IS NOT NULL"),
]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that the table does not have."""
    return [c for c in required if c not in df.columns]


def apply_rules(df: DataFrame, rules: Sequence[Rule] = HOLIDAY_RULES) -> DataFrame:
    """Adds ``validation_errors`` (messages joined by ``;``) and ``status_processamento``.

    Rows are marked, never dropped.
    """
    errors = F.concat_ws(";", *(F.when(r.broken, r.message) for r in rules))
    return df.withColumn("validation_errors", errors).withColumn(
        "status_processamento",
        F.when(F.col("validation_errors") == "", SUCCESS).otherwise(ERROR),
    )


def metric_columns(rules: Sequence[Rule] = HOLIDAY_RULES) -> list[Column]:
    """Aggregates over the rows of ``apply_rules``: totals, and breaks per rule.

    They serve a plain ``agg`` and an ``Observation`` on a write alike.
    """
    status = F.col("status_processamento")
    return [
        F.count("*").alias("total_records"),
        F.count_if(status == SUCCESS).alias("successful_records"),
        F.count_if(status == ERROR).alias("error_records"),
        *(F.count_if(r.broken).alias(r.name) for r in rules),
    ]


def run_status(errors: Column, successes: Column) -> Column:
    """Status of a run from its number of bad and good rows."""
    return F.when(errors == 0, SUCCESS).when(successes == 0, ERROR).otherwise(PARTIAL)


def rule_metrics(
    df: DataFrame, rules: Sequence[Rule] = HOLIDAY_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """Totals, breaks per rule and run status, overall or per group."""
    return (
        df.groupBy(*by)
        .agg(*metric_columns(rules))
        .withColumn(
            "processing_status", run_status(F.col("error_records"), F.col("successful_records"))
        )
    )
