"""Cleaning, typing, deduplication, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_of_week, easter_sunday, is_weekend, parse_date, parse_padded_date
from ..functions.text import dashed, squeeze
from ..operators.cleaning import clean, conform, first_per_key, latest_load
from ..operators.quality import HOLIDAY_RULES, LITERAL_RULES, Rule, apply_rules, rule_metrics
from ..plans.silver import silver_rows
from . import inputs as i
from .registry import query


@query(
    r"""SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text, upper(lang) AS lang,
  upper(source[1]) || lower(source[2:]) AS source
FROM documents"""
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """White space, case and capitals of whole document texts."""
    spec = {"text": squeeze, "lang": F.upper, "source": F.initcap}
    return i.table(spark, sf, "documents").transform(clean, spec).select(
        "doc_id", "text", "lang", "source"
    )


@query(i.sql(i.CLEAN_PARTS, "SELECT pedido, data_raw, nome, tipo, estado FROM cleaned"))
def clean_records(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaning of holiday records."""
    return i.raw_records(spark, sf).transform(clean).select(
        "pedido", F.col("data").alias("data_raw"), "nome", "tipo", "estado"
    )


@query(
    i.sql(
        i.CLEAN_PARTS,
        """SELECT pedido, data_raw, data, CAST(year(data) AS INT) AS ano, CAST(month(data) AS INT) AS mes,
  'API_HOLIDAYS' AS fonte_dado FROM cleaned""",
    )
)
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates written in several ways; unreadable ones become NULL."""
    return i.raw_records(spark, sf).transform(clean).transform(conform, i.LOAD_TS).select(
        "pedido", "data_raw", "data", "ano", "mes", "fonte_dado"
    )


@query(
    """SELECT user_id, event_type, CAST(ts AS DATE) AS dia, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
  ORDER BY ts DESC, event_id DESC) = 1"""
)
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The last event per user, type and day."""
    events = i.table(spark, sf, "events").withColumn("dia", F.col("ts").cast("date"))
    keys = ["user_id", "event_type", "dia"]
    return first_per_key(events, keys, [F.desc("ts"), F.desc("event_id")]).select(
        *keys, "event_id", "ts", "value"
    )


_LATEST = """SELECT data, estado, dt_carga, nome, tipo FROM cleaned
QUALIFY row_number() OVER (PARTITION BY data, estado
  ORDER BY dt_carga DESC, nome NULLS FIRST, tipo NULLS FIRST) = 1"""


@query(i.sql(i.CLEAN_PARTS, _LATEST))
def latest_load_per_holiday(spark: SparkSession, sf: str) -> DataFrame:
    """Of the loads of a holiday, the newest."""
    records = i.raw_records(spark, sf).transform(clean).transform(conform, i.LOAD_TS)
    return latest_load(records).select("data", "estado", "dt_carga", "nome", "tipo")


def _checked(spark: SparkSession, sf: str, rules: list[Rule]) -> DataFrame:
    records = i.raw_records(spark, sf).transform(clean).transform(conform, i.LOAD_TS)
    return apply_rules(records, rules)


_MARKED = "SELECT pedido, validation_errors, status_processamento FROM marked"
_HOLIDAY_MARKED = f"marked AS ({i.marked('cleaned', i.HOLIDAY_CHECKS)})"


@query(i.sql([*i.CLEAN_PARTS, _HOLIDAY_MARKED], _MARKED))
def rule_validation(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf, HOLIDAY_RULES).select(
        "pedido", "validation_errors", "status_processamento"
    )


@query(i.sql([*i.CLEAN_PARTS, f"marked AS ({i.marked('cleaned', i.LITERAL_CHECKS)})"], _MARKED))
def rule_validation_literal(spark: SparkSession, sf: str) -> DataFrame:
    """The stricter rule set, on typed rows only."""
    return _checked(spark, sf, LITERAL_RULES).select(
        "pedido", "validation_errors", "status_processamento"
    )


_METRICS = """count(*) AS total_records,
  count(*) FILTER (status_processamento = 'SUCESSO') AS successful_records,
  count(*) FILTER (status_processamento = 'ERRO') AS error_records,
  count(*) FILTER (contains(validation_errors, 'Data não pode ser nula')) AS data_not_null,
  count(*) FILTER (contains(validation_errors, 'Estado inválido')) AS estado_valid,
  count(*) FILTER (contains(validation_errors, 'Nome do feriado não pode ser vazio')) AS nome_not_empty,
  count(*) FILTER (contains(validation_errors, 'Formato de data inválido')) AS data_format,
  CASE WHEN count(*) FILTER (status_processamento = 'ERRO') = 0 THEN 'SUCESSO'
    WHEN count(*) FILTER (status_processamento = 'SUCESSO') = 0 THEN 'ERRO'
    ELSE 'PARCIAL' END AS processing_status
FROM marked"""


@query(i.sql([*i.CLEAN_PARTS, _HOLIDAY_MARKED], f"SELECT {_METRICS}"))
def rule_metrics_total(spark: SparkSession, sf: str) -> DataFrame:
    return rule_metrics(_checked(spark, sf, HOLIDAY_RULES))


@query(i.sql([*i.CLEAN_PARTS, _HOLIDAY_MARKED], f"SELECT estado, {_METRICS} GROUP BY estado"))
def rule_metrics_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return rule_metrics(_checked(spark, sf, HOLIDAY_RULES), by=["estado"])


SILVER_PARTS = [
    *i.CLEAN_PARTS,
    """single AS (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (
    PARTITION BY coalesce(CAST(data AS VARCHAR), data_raw), estado, dt_carga
    ORDER BY dt_processamento DESC, nome NULLS FIRST, tipo NULLS FIRST, data_raw NULLS FIRST) = 1)""",
    f"silver AS ({i.marked('single', i.HOLIDAY_CHECKS)})",
]


@query(
    i.sql(
        SILVER_PARTS,
        """SELECT data, nome, tipo, estado, dt_processamento, dt_carga, 'API_HOLIDAYS' AS fonte_dado,
  status_processamento, validation_errors, CAST(year(data) AS INT) AS ano,
  CAST(month(data) AS INT) AS mes FROM silver""",
    )
)
def silver_records(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, type, one per key, mark: the whole silver chain."""
    return silver_rows(i.raw_records(spark, sf), i.LOAD_TS).drop("silver_timestamp", "last_updated")


@query(
    i.sql(
        [i.STATES, i.ORDERS_BY_STATE, i.SPAN, i.EASTER],
        r"""SELECT o_orderkey AS pedido,
  regexp_replace(o_orderpriority, '[^A-Z]+', '', 'g') AS sem_digitos,
  replace(strftime(dia, '%Y/%m/%d'), '/', '-') AS com_traco,
  trim('  ' || c_mktsegment || ' ') AS aparado, lower(upper(lower(c_mktsegment))) AS minusculo,
  upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS inicial,
  CAST(length(o_orderpriority) AS INT) AS tamanho,
  concat_ws(';', CASE WHEN o_orderstatus = 'P' THEN 'P' END, NULL,
    CASE WHEN c_acctbal < 0 THEN 'negativo' END) AS juntos,
  contains(o_orderpriority, 'IG') AS contem,
  CASE WHEN o_totalprice > 250000 THEN 'alto' ELSE 'baixo' END AS faixa,
  try_cast(strftime(dia, '%d-%m-%Y') AS DATE) AS ilegivel, dia AS legivel,
  CAST(year(dia) AS INT) AS ano, CAST(month(dia) AS INT) AS mes,
  CAST(dayofweek(dia) + 1 AS INT) AS dia_semana, dayofweek(dia) IN (0, 6) AS fim_de_semana,
  CAST(len(generate_series(date_trunc('month', dia), dia, INTERVAL 1 DAY)) AS INT) AS dias_do_mes,
  CAST(o_orderkey / 4 * 100 AS DOUBLE) AS percentual, domingo AS pascoa
FROM placed JOIN easter ON y = year(dia)""",
    )
)
def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Every scalar function of the engine on each order."""
    dia, segment = F.col("dia"), F.col("c_mktsegment")
    until = F.sequence(F.trunc("dia", "month"), dia, F.expr("interval 1 day"))
    return i.orders_by_state(spark, sf).select(
        F.col("o_orderkey").alias("pedido"),
        F.regexp_replace("o_orderpriority", "[^A-Z]+", "").alias("sem_digitos"),
        dashed(F.date_format(dia, "yyyy/MM/dd")).alias("com_traco"),
        squeeze(F.concat(F.lit("  "), segment, F.lit(" "))).alias("aparado"),
        F.lower(F.upper(F.lower(segment))).alias("minusculo"),
        F.initcap(segment).alias("inicial"),
        F.length("o_orderpriority").alias("tamanho"),
        F.concat_ws(
            ";",
            F.when(F.col("o_orderstatus") == "P", "P"),
            F.lit(None).cast("string"),
            F.when(F.col("c_acctbal") < 0, "negativo"),
        ).alias("juntos"),
        F.contains(F.col("o_orderpriority"), F.lit("IG")).alias("contem"),
        F.when(F.col("o_totalprice") > 250000, "alto").otherwise("baixo").alias("faixa"),
        parse_date(F.date_format(dia, "dd-MM-yyyy")).alias("ilegivel"),
        parse_padded_date(F.date_format(dia, "yyyy-MM-dd")).alias("legivel"),
        F.year(dia).alias("ano"),
        F.month(dia).alias("mes"),
        day_of_week(dia).alias("dia_semana"),
        is_weekend(dia).alias("fim_de_semana"),
        F.size(until).alias("dias_do_mes"),
        (F.col("o_orderkey") / 4 * 100).alias("percentual"),
        easter_sunday("year(dia)").alias("pascoa"),
    )
