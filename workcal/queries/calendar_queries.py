"""Date spine, holiday calendar, working days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import default_rules, expand_rules, scopes_without_rules
from ..operators.cleaning import clean, conform
from ..operators.regions import holds_in, holidays_by_region, is_valid
from ..operators.workdays import (
    calendar_join,
    day_counts,
    holiday_counts,
    monthly_workdays,
    region_faults,
    region_holiday_counts,
    region_totals,
    state_holiday_counts,
    with_faults,
    workday_flags,
    workday_profile,
)
from ..plans.gold import create_report_function
from ..schemas import REPORT_FUNCTION
from ..scratch import stage
from ..sources import group_spine
from . import inputs as i
from .registry import query

_MONTHLY = """SELECT {by}, ano, mes, CAST(sum(dia_util) AS BIGINT) AS dias_uteis,
  CAST(sum(is_holiday) AS BIGINT) AS total_feriados, count(data) AS total_dias,
  avg(is_holiday) AS percentual_feriados, count(DISTINCT data) AS dias_calendario,
  count(DISTINCT CASE WHEN is_holiday = 1 THEN data END) AS dias_com_feriado
FROM joined GROUP BY {by}, ano, mes"""
MONTHLY_SQL = i.sql(i.DAY_PARTS, _MONTHLY.format(by="regiao"))


@query(
    i.sql(
        [i.STATES, i.ORDERS_BY_STATE],
        """SELECT regiao, data, CAST(dayofweek(data) + 1 AS INT) AS dia_semana,
  CAST(month(data) AS INT) AS mes, CAST(year(data) AS INT) AS ano
FROM (
  SELECT regiao, CAST(unnest(generate_series(make_date(CAST(lo AS INT), 1, 1),
    make_date(CAST(hi AS INT), 12, 31), INTERVAL 1 DAY)) AS DATE) AS data
  FROM (SELECT regiao, min(year(dia)) AS lo, max(year(dia)) AS hi FROM placed GROUP BY regiao))""",
    )
)
def date_spine_year(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of the years in which a region has orders."""
    span = i.orders_by_state(spark, sf).groupBy("regiao").agg(
        F.min("dia").alias("lo"), F.max("dia").alias("hi")
    )
    first = F.trunc("lo", "year")
    last = F.date_add(F.add_months(F.trunc("hi", "year"), 12), -1)
    return group_spine(span, first, last).drop("lo", "hi")


@query(i.sql(i.CALENDAR_PARTS, "SELECT data, nome, tipo, estado FROM calendar"))
def holiday_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return i.calendar(spark, sf)


@query(
    i.sql(
        [*i.CLEAN_PARTS],
        """SELECT regiao, pedido, data, nome, estado
FROM cleaned JOIN (
  SELECT regiao, uf FROM states UNION ALL SELECT DISTINCT regiao, 'ALL' FROM states) ON estado = uf
WHERE data IS NOT NULL AND nome IS NOT NULL AND estado IS NOT NULL""",
    )
)
def region_holiday_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Valid records, each in every region it holds in."""
    records = i.raw_records(spark, sf).transform(clean).transform(conform, i.LOAD_TS)
    valid = records.filter(is_valid()).select("pedido", "data", "nome", "estado")
    return holidays_by_region(valid, i.states(spark, sf))


@query(
    i.sql(
        i.CLEAN_PARTS,
        """SELECT pedido, data, nome, estado,
  data IS NOT NULL AND nome IS NOT NULL AND estado IS NOT NULL AS is_valid
FROM cleaned WHERE estado IN ('NA', 'NF', 'NK') OR estado = 'ALL'""",
    )
)
def state_holiday_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Records of some states or national ones, with their validity."""
    records = i.raw_records(spark, sf).transform(clean).transform(conform, i.LOAD_TS)
    return records.filter(holds_in(["NA", "NF", "NK"])).select(
        "pedido", "data", "nome", "estado", is_valid().alias("is_valid")
    )


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    span = i.years(spark, sf)
    regional = holidays_by_region(i.calendar(spark, sf, span), i.states(spark, sf))
    return calendar_join(i.region_spine(spark, sf, span), regional, ["regiao"])


@query(
    i.sql(i.DAY_PARTS, "SELECT regiao, data, dia_semana, mes, ano, nome, tipo, estado FROM joined")
)
def calendar_left_join(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf)


@query(
    i.sql(i.DAY_PARTS, "SELECT regiao, data, mes, dia_semana, nome, dia_util, is_holiday FROM joined")
)
def workday_flags_daily(spark: SparkSession, sf: str) -> DataFrame:
    return workday_flags(_joined(spark, sf)).select(
        "regiao", "data", "mes", "dia_semana", "nome", "dia_util", "is_holiday"
    )


@query(MONTHLY_SQL)
def monthly_workdays_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_workdays(i.region_days(spark, sf), ["regiao"])


@query(
    i.sql(
        [
            *i.CALENDAR_PARTS,
            i.SPINE.replace("SELECT DISTINCT regiao FROM states", "SELECT DISTINCT uf AS regiao FROM states"),
            """joined AS (
  SELECT s.regiao AS uf, s.data, s.mes, s.ano,
    CASE WHEN nome IS NULL AND dia_semana NOT IN (1, 7) THEN 1 ELSE 0 END AS dia_util,
    CASE WHEN nome IS NULL THEN 0 ELSE 1 END AS is_holiday
  FROM spine s LEFT JOIN calendar c ON s.data = c.data AND (c.estado = s.regiao OR c.estado = 'ALL'))""",
        ],
        _MONTHLY.format(by="uf").replace("SELECT uf", "SELECT uf AS estado"),
    )
)
def monthly_workdays_by_state(spark: SparkSession, sf: str) -> DataFrame:
    states, span = i.states(spark, sf), i.years(spark, sf)
    spine = i.spine(states.select(F.col("uf").alias("estado")), span)
    counts = state_holiday_counts(i.calendar(spark, sf, span), states)
    return monthly_workdays(day_counts(spine, counts, ["estado"]), ["estado"])


_TOTALS = """SELECT regiao, ano, CAST(sum(is_holiday) AS BIGINT) AS total_holidays,
  CAST(sum(dia_util) AS BIGINT) AS working_days,
  sum(is_holiday) / count(data) * 100 AS holiday_percentage FROM joined GROUP BY regiao, ano"""


@query(i.sql(i.DAY_PARTS, _TOTALS))
def region_yearly_totals(spark: SparkSession, sf: str) -> DataFrame:
    monthly = monthly_workdays(i.region_days(spark, sf), ["regiao"])
    return region_totals(monthly).drop("processing_status", "error_message")


@query(
    i.sql(
        [
            *i.DAY_PARTS[:-2],
            i.SPINE.replace("CAST(lo AS", "CAST(lo - 1 AS").replace("CAST(hi AS", "CAST(hi + 1 AS"),
            i.JOINED.replace("ON estado = uf", "ON estado = uf AND estado <> 'ALL'"),
            f"totals AS ({_TOTALS})",
        ],
        """SELECT regiao, ano, total_holidays,
  CASE WHEN total_holidays = 0 THEN 0 ELSE working_days END AS working_days,
  CASE WHEN total_holidays = 0 THEN 0 ELSE holiday_percentage END AS holiday_percentage,
  CASE WHEN total_holidays = 0 THEN 'ERRO' ELSE 'SUCESSO' END AS processing_status,
  CASE WHEN total_holidays = 0 THEN 'Sem dados válidos para região ' || regiao END AS error_message
FROM totals""",
    )
)
def region_status(spark: SparkSession, sf: str) -> DataFrame:
    """State holidays only, one year beyond the calendar at both ends: a region has
    no valid holiday there, which is reported and disturbs no other row."""
    states, span = i.states(spark, sf), i.years(spark, sf)
    state_only = i.calendar(spark, sf, span).filter(F.col("tipo") == "Estadual")
    wider = span[0] - 1, span[1] + 1
    spine = i.region_spine(spark, sf, wider)
    days = day_counts(spine, region_holiday_counts(state_only, states), ["regiao"])
    years = states.select("regiao").distinct().withColumn(
        "ano", F.explode(F.sequence(*map(F.lit, wider)))
    )
    return region_totals(monthly_workdays(days, ["regiao"]), groups=years)


@query(
    i.sql(
        [
            *i.DAY_PARTS[:-2],
            i.SPINE,
            """records AS (
  SELECT *, CASE WHEN estado IN (SELECT min(uf) FROM states) AND month(data) = 12
    THEN strftime(data, '%d-%m-%Y') END AS ilegivel FROM calendar)""",
            i.JOINED.replace("FROM calendar c JOIN", "FROM records c JOIN").replace("ON estado = uf)", "ON estado = uf WHERE ilegivel IS NULL)"),
            f"totals AS ({_TOTALS})",
            """faults AS (
  SELECT regiao, CAST(year(data) AS INT) AS ano, 'Formato de data inválido: ' || min(ilegivel) AS falha
  FROM records JOIN states ON estado = uf WHERE ilegivel IS NOT NULL GROUP BY ALL)""",
        ],
        """SELECT regiao, ano, CASE WHEN falha IS NULL THEN total_holidays ELSE 0 END AS total_holidays,
  CASE WHEN falha IS NULL THEN working_days ELSE 0 END AS working_days,
  CASE WHEN falha IS NULL THEN holiday_percentage ELSE 0 END AS holiday_percentage,
  CASE WHEN falha IS NULL THEN 'SUCESSO' ELSE 'ERRO' END AS processing_status, falha AS error_message
FROM totals LEFT JOIN faults USING (regiao, ano)""",
    )
)
def region_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Holidays with dates as text. The first state writes those of December in another way:
    its region has status ERRO in these years and says why, all others are reported."""
    states, span = i.states(spark, sf), i.years(spark, sf)
    first_state = states.agg(F.min("uf")).first()[0]
    day = F.col("data")
    odd = (F.col("estado") == first_state) & (F.month(day) == 12)
    pattern = F.when(odd, F.date_format(day, "dd-MM-yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    records = i.calendar(spark, sf, span).withColumn("data_raw", pattern)
    records = records.withColumn("data", F.try_to_date("data_raw", "yyyy-MM-dd"))
    fault = F.when(F.col("data").isNull(), F.concat(F.lit("Formato de data inválido: "), "data_raw"))
    faults = region_faults(records, states, fault, F.regexp_extract("data_raw", "[0-9]{4}", 0).try_cast("int"))
    days = day_counts(i.region_spine(spark, sf, span), region_holiday_counts(records, states), ["regiao"])
    return with_faults(region_totals(monthly_workdays(days, ["regiao"])), faults)


@query(MONTHLY_SQL)
def workday_views(spark: SparkSession, sf: str) -> DataFrame:
    """All months of a stored report, through its table function of region and year: one scan."""
    first, last = span = i.years(spark, sf)
    monthly = stage(monthly_workdays(i.region_days(spark, sf, span), ["regiao"]), "monthly")
    create_report_function(monthly)
    groups = i.states(spark, sf).select("regiao").distinct().withColumn(
        "ano", F.explode(F.sequence(F.lit(first), F.lit(last)))
    )
    groups.createOrReplaceTempView("grupos")
    return spark.sql(f"SELECT d.* FROM grupos g, LATERAL {REPORT_FUNCTION}(g.regiao, g.ano) d")


@query(
    i.sql(
        i.CALENDAR_PARTS[:-1],
        """SELECT uf AS scope, ano
FROM states, (SELECT CAST(unnest(range(lo - 1, hi + 2)) AS INT) AS ano FROM span)
WHERE NOT EXISTS (
  SELECT 1 FROM rules WHERE scope = uf AND ano BETWEEN coalesce(valid_from, ano) AND coalesce(valid_to, ano))""",
    )
)
def rule_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """States and years without any rule of the state, one year beyond the orders at both ends."""
    first, last = i.years(spark, sf)
    scopes = i.states(spark, sf).select(F.col("uf").alias("scope"))
    return scopes_without_rules(i.rules(spark, sf), scopes, first - 1, last + 1)


_DAYS = """days AS (
  SELECT regiao, data, max(dia_util) AS dia_util, min(ano) AS ano, min(mes) AS mes
  FROM joined GROUP BY regiao, data)"""


@query(
    i.sql(
        [*i.DAY_PARTS, _DAYS],
        """SELECT p.regiao, ano, mes, dia_util, count(*) AS pedidos,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS receita
FROM placed p LEFT JOIN days d ON p.regiao = d.regiao AND p.dia = d.data
GROUP BY p.regiao, ano, mes, dia_util""",
    )
)
def orders_on_workdays(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and revenue per region and month on working and other days."""
    return workday_profile(
        i.orders_by_state(spark, sf),
        i.region_days(spark, sf),
        date="dia",
        by=["regiao"],
        report=["ano", "mes", "dia_util"],
        measures={"pedidos": F.lit(1).cast("long"), "receita": i.money("o_totalprice")},
    ).withColumn("receita", F.col("receita").cast("double"))


@query(
    i.sql(
        [i.span_sql(i.SHIPPED) if part == i.SPAN else part for part in (*i.DAY_PARTS, _DAYS)],
        """SELECT s.regiao, l_returnflag, dia_util, count(*) AS itens,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantidade,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN states s ON s_nationkey = n_nationkey
LEFT JOIN days d ON s.regiao = d.regiao AND CAST(l_shipdate AS DATE) = d.data
GROUP BY s.regiao, l_returnflag, dia_util""",
    )
)
def shipments_on_workdays(spark: SparkSession, sf: str) -> DataFrame:
    """Line items by return flag, shipped on working and other days of the supplier."""
    lineitem, supplier = i.table(spark, sf, "lineitem"), i.table(spark, sf, "supplier")
    shipped = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        i.states(spark, sf), F.col("s_nationkey") == F.col("n_nationkey")
    )
    sums = workday_profile(
        shipped,
        i.region_days(spark, sf, i.years(spark, sf, i.SHIPPED)),
        date="l_shipdate",
        by=["regiao"],
        keep=["l_returnflag"],
        measures={
            "itens": F.lit(1).cast("long"),
            "quantidade": i.money("l_quantity"),
            "valor": i.money("l_extendedprice"),
        },
    )
    return sums.withColumns({c: F.col(c).cast("double") for c in ("quantidade", "valor")})


@query(
    i.sql(
        [
            i.span_sql([("events", "ts")]),
            i.EASTER,
            f"""rules(nome, kind, month, day, off, scope, valid_from, valid_to) AS (
  VALUES {", ".join("(" + ", ".join(i.sql_value(v) for v in r) + ")" for r in i.NATIONAL_RULES)})""",
            i.CALENDAR,
        ],
        """SELECT event_type, CAST(dayofweek(dia) + 1 AS INT) AS dia_semana,
  CASE WHEN dia IN (SELECT data FROM calendar) OR dayofweek(dia) IN (0, 6) THEN 0 ELSE 1 END AS dia_util,
  count(*) AS eventos, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM (SELECT *, CAST(ts AS DATE) AS dia FROM events) GROUP BY event_type, dia_semana, dia_util""",
    )
)
def events_workday_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Events per type and weekday, with the national calendar only."""
    span = i.years(spark, sf, [("events", "ts")])
    holidays = expand_rules(default_rules(spark, states=False), *span)
    days = day_counts(i.spine(spark.range(1).select(), span), holiday_counts(holidays))
    return workday_profile(
        i.table(spark, sf, "events"),
        days,
        date="ts",
        keep=["event_type"],
        report=["dia_semana", "dia_util"],
        measures={"eventos": F.lit(1).cast("long"), "total": i.money("value")},
    ).withColumn("total", F.col("total").cast("double"))
