"""The holiday model read off the test tables, in Spark and as SQL parts.

``nation`` plays the states and ``region`` the macro-regions. Holiday rules are
the national ones plus, per state, the days its customers order most on; raw
holiday records, with the flaws that a feed has, are the orders themselves. Both
therefore grow with ``orders``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import easter_sunday
from ..operators.calendar import default_rules, expand_rules, merge_same_day
from ..operators.cleaning import first_per_key
from ..operators.workdays import day_counts, region_holiday_counts
from ..schemas import NATIONAL_RULES, RULES
from ..sources import group_spine

LOAD_TS = dt.datetime(2024, 3, 1, 6, 0, 0)
LOAD_DATE = LOAD_TS.date()


# Schemas of the test tables: reading needs no look at the files first.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


# Date columns whose years a calendar must cover: of orders, and of line items too.
ORDERED = (("orders", "o_orderdate"),)
SHIPPED = (*ORDERED, ("lineitem", "l_shipdate"))


def years(spark: SparkSession, sf: str, dates=ORDERED) -> tuple[int, int]:
    """First and last year of the date columns; one row passes through the driver.
    Without any date, no year lies between them."""
    spans = [
        table(spark, sf, name).agg(F.year(F.min(c)).alias("lo"), F.year(F.max(c)).alias("hi"))
        for name, c in dates
    ]
    first, last = reduce(DataFrame.unionByName, spans).agg(F.min("lo"), F.max("hi")).first()
    return (2, 1) if first is None else (first, last)


def money(column: str) -> Column:
    """Exact, so that sums do not depend on the order of the rows."""
    return F.col(column).cast("decimal(18,2)")


def states(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("regiao"),
        F.concat(F.lit("N"), F.char(F.col("n_nationkey") + 65)).alias("uf"),
        "n_nationkey",
    )


def orders_by_state(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(states(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("dia", F.col("o_orderdate").cast("date"))
    )


def rules(spark: SparkSession, sf: str) -> DataFrame:
    """National rules, and per state: the busiest day of each month and the busiest
    distance from Easter Sunday, from the first to the last year with such orders."""
    daily = orders_by_state(spark, sf).groupBy("uf", "dia").agg(F.count("*").alias("n"))
    none = F.lit(None).cast("int")
    to_easter = F.date_diff("dia", easter_sunday("year(dia)"))
    # Each day speaks for two rules: its place in the month, and in the Easter cycle.
    votes = daily.select(
        F.col("uf").alias("scope"),
        "n",
        F.year("dia").alias("ano"),
        F.inline(
            F.array(
                F.struct(
                    F.lit("fixed").alias("kind"),
                    F.month("dia").alias("month"),
                    F.dayofmonth("dia").alias("day"),
                    none.alias("offset"),
                ),
                F.struct(
                    F.lit("easter").alias("kind"),
                    none.alias("month"),
                    none.alias("day"),
                    to_easter.alias("offset"),
                ),
            )
        ),
    )
    counted = votes.groupBy("scope", "kind", "month", "day", "offset").agg(
        F.sum("n").alias("n"), F.min("ano").alias("valid_from"), F.max("ano").alias("valid_to")
    )
    name = F.when(F.col("kind") == "fixed", "Dia do estado ").otherwise("Festa movel ")
    busiest = first_per_key(
        counted, ["scope", "kind", "month"], [F.desc("n"), F.asc("day"), F.asc("offset")]
    ).withColumn("nome", F.concat(name, "scope"))
    return default_rules(spark, states=False).unionByName(busiest.select(*RULES.names))


def calendar(spark: SparkSession, sf: str, span: tuple[int, int] | None = None) -> DataFrame:
    """The holidays of the years ``span``, by default those of the orders."""
    return merge_same_day(expand_rules(rules(spark, sf), *(span or years(spark, sf))))


def spine(groups: DataFrame, span: tuple[int, int]) -> DataFrame:
    return group_spine(groups, dt.date(span[0], 1, 1), dt.date(span[1], 12, 31))


def region_spine(spark: SparkSession, sf: str, span: tuple[int, int]) -> DataFrame:
    return spine(states(spark, sf).select("regiao").distinct(), span)


def region_days(spark: SparkSession, sf: str, span: tuple[int, int] | None = None) -> DataFrame:
    span = span or years(spark, sf)
    counts = region_holiday_counts(calendar(spark, sf, span), states(spark, sf))
    return day_counts(region_spine(spark, sf, span), counts, ["regiao"])


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as one raw holiday record, with the flaws of a hand-kept feed:
    four ways to write a date and one that is none, stray blanks, missing names,
    mixed case, wrong and missing states, and many records under one scope."""
    day, priority, status = F.col("dia"), F.col("o_orderpriority"), F.col("o_orderstatus")
    segment, balance, uf = F.col("c_mktsegment"), F.col("c_acctbal"), F.col("uf")
    national = segment.isin("AUTOMOBILE", "MACHINERY")
    iso = F.date_format(day, "yyyy-MM-dd")
    stamp = F.concat(F.lit("2024-01-0"), F.substring(priority, 1, 1), F.lit("T00:00:00.000Z"))
    return orders_by_state(spark, sf).select(
        F.col("o_orderkey").alias("pedido"),
        F.when(priority == "1-URGENT", iso)
        .when(priority == "2-HIGH", F.date_format(day, "yyyy/MM/dd"))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy/M/d"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(day, "dd-MM-yyyy"))
        .when(status != "P", iso)
        .alias("data"),
        F.when(status == "F", F.concat(F.lit("  Dia   de "), segment, F.lit(" ")))
        .when(status == "O", F.concat(F.lit("Dia\tde \n"), segment))
        .when(segment == "BUILDING", F.lit("   "))
        .when(segment != "FURNITURE", F.concat(F.lit("Dia de "), segment))
        .alias("nome"),
        F.when(national, "NACIONAL").otherwise("estadual").alias("tipo"),
        F.when(national, "ALL")
        .when(balance < 0, F.concat(uf, F.lit("X")))
        .when(balance > 9000, F.lit(None))
        .when(status == "O", F.lower(uf))
        .otherwise(uf)
        .alias("estado"),
        stamp.alias("dt_processamento"),
        stamp.alias("dt_carga"),
    )


def as_json_lines(records: DataFrame) -> DataFrame:
    """Records as JSON text; those without a usable name lost the end of the line."""
    line = F.to_json(F.struct("data", "nome", "tipo", "estado", "dt_processamento", "dt_carga"))
    cut = F.substring(line, F.lit(1), F.length(line) - 3)
    return records.select(F.when(F.trim("nome") == "", cut).otherwise(line).alias("value"))


# --- the same as SQL ---------------------------------------------------------

STATES = """states AS (
  SELECT r_name AS regiao, 'N' || chr(65 + n_nationkey) AS uf, n_nationkey
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

ORDERS_BY_STATE = """placed AS (
  SELECT *, CAST(o_orderdate AS DATE) AS dia
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN states ON c_nationkey = n_nationkey)"""



def span_sql(dates=ORDERED) -> str:
    days = " UNION ALL ".join(f"SELECT {c} AS d FROM {name}" for name, c in dates)
    return f"span AS (SELECT min(year(d)) AS lo, max(year(d)) AS hi FROM ({days}))"


SPAN = span_sql()

EASTER = """easter AS (
  SELECT y, make_date(CAST(y AS INT), CAST(x // 31 AS INT), CAST(x % 31 + 1 AS INT)) AS domingo
  FROM (
    SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f,
      (b - f + 1) // 3 AS g, (19 * a + b - d - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k,
      (32 + 2 * e + 2 * i - h - k) % 7 AS l, (a + 11 * h + 22 * l) // 451 AS m,
      h + l - 7 * m + 114 AS x
    FROM (SELECT unnest(range(lo, hi + 1)) AS y FROM span)))"""


def sql_value(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


RULES_SQL = f"""daily AS (
  SELECT uf, n, CAST(year(dia) AS INT) AS ano, month(dia) AS month, day(dia) AS day,
    dia - domingo AS off
  FROM (SELECT uf, dia, count(*) AS n FROM placed GROUP BY uf, dia) JOIN easter ON y = year(dia)),
busy_day AS (
  SELECT * FROM (SELECT uf, month, day, sum(n) AS n, min(ano) AS valid_from, max(ano) AS valid_to
    FROM daily GROUP BY uf, month, day)
  QUALIFY row_number() OVER (PARTITION BY uf, month ORDER BY n DESC, day) = 1),
busy_offset AS (
  SELECT * FROM (SELECT uf, off, sum(n) AS n, min(ano) AS valid_from, max(ano) AS valid_to
    FROM daily GROUP BY uf, off)
  QUALIFY row_number() OVER (PARTITION BY uf ORDER BY n DESC, off) = 1),
rules(nome, kind, month, day, off, scope, valid_from, valid_to) AS (
  VALUES {", ".join("(" + ", ".join(sql_value(v) for v in r) + ")" for r in NATIONAL_RULES)}
  UNION ALL
  SELECT 'Dia do estado ' || uf, 'fixed', month, day, NULL, uf, valid_from, valid_to
  FROM busy_day
  UNION ALL
  SELECT 'Festa movel ' || uf, 'easter', NULL, NULL, off, uf, valid_from, valid_to
  FROM busy_offset)"""

CALENDAR = """expanded AS (
  SELECT CASE WHEN kind = 'easter' THEN domingo + CAST(off AS INT)
    ELSE try_cast(printf('%04d-%02d-%02d', y, month, day) AS DATE) END AS data,
    nome, CASE WHEN scope = 'ALL' THEN 'Nacional' ELSE 'Estadual' END AS tipo, scope AS estado
  FROM rules JOIN easter ON y BETWEEN coalesce(valid_from, y) AND coalesce(valid_to, y)),
calendar AS (
  SELECT data, string_agg(DISTINCT nome, '; ' ORDER BY nome) AS nome, tipo, estado
  FROM expanded WHERE data IS NOT NULL GROUP BY data, tipo, estado)"""

SPINE = """spine AS (
  SELECT regiao, data, CAST(dayofweek(data) + 1 AS INT) AS dia_semana,
    CAST(month(data) AS INT) AS mes, CAST(year(data) AS INT) AS ano
  FROM (SELECT DISTINCT regiao FROM states), (
    SELECT CAST(unnest(generate_series(make_date(CAST(lo AS INT), 1, 1),
      make_date(CAST(hi AS INT), 12, 31), INTERVAL 1 DAY)) AS DATE) AS data FROM span))"""

JOINED = """scopes AS (
  SELECT regiao, uf FROM states UNION ALL SELECT DISTINCT regiao, 'ALL' FROM states),
regional AS (SELECT regiao, c.* FROM calendar c JOIN scopes ON estado = uf),
joined AS (
  SELECT s.*, r.nome, r.tipo, r.estado,
    CASE WHEN nome IS NULL AND dia_semana NOT IN (1, 7) THEN 1 ELSE 0 END AS dia_util,
    CASE WHEN nome IS NULL THEN 0 ELSE 1 END AS is_holiday
  FROM spine s LEFT JOIN regional r ON s.regiao = r.regiao AND s.data = r.data)"""

RAW = """raw AS (
  SELECT o_orderkey AS pedido,
    CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(dia, '%Y-%m-%d')
      WHEN o_orderpriority = '2-HIGH' THEN strftime(dia, '%Y/%m/%d')
      WHEN o_orderpriority = '3-MEDIUM' THEN strftime(dia, '%Y/%-m/%-d')
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(dia, '%d-%m-%Y')
      WHEN o_orderstatus <> 'P' THEN strftime(dia, '%Y-%m-%d') END AS data,
    CASE WHEN o_orderstatus = 'F' THEN '  Dia   de ' || c_mktsegment || ' '
      WHEN o_orderstatus = 'O' THEN 'Dia' || chr(9) || 'de ' || chr(10) || c_mktsegment
      WHEN c_mktsegment = 'BUILDING' THEN '   '
      WHEN c_mktsegment <> 'FURNITURE' THEN 'Dia de ' || c_mktsegment END AS nome,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'NACIONAL' ELSE 'estadual' END AS tipo,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'ALL'
      WHEN c_acctbal < 0 THEN uf || 'X'
      WHEN c_acctbal > 9000 THEN NULL
      WHEN o_orderstatus = 'O' THEN lower(uf)
      ELSE uf END AS estado,
    '2024-01-0' || substr(o_orderpriority, 1, 1) || 'T00:00:00.000Z' AS dt_processamento,
    '2024-01-0' || substr(o_orderpriority, 1, 1) || 'T00:00:00.000Z' AS dt_carga
  FROM placed)"""

CLEANED = r"""cleaned AS (
  SELECT pedido, replace(data, '/', '-') AS data_raw,
    try_cast(replace(data, '/', '-') AS DATE) AS data,
    trim(regexp_replace(nome, '\s+', ' ', 'g')) AS nome,
    upper(tipo[1]) || lower(tipo[2:]) AS tipo, upper(estado) AS estado, dt_processamento, dt_carga
  FROM raw)"""


def marked(source: str, rules: list[tuple[str, str]]) -> str:
    """``source`` with the texts of its failed rules; ``rules`` pairs condition and message."""
    parts = ", ".join(f"CASE WHEN NOT ({c}) THEN '{m}' END" for c, m in rules)
    return f"""SELECT *, CASE WHEN validation_errors = '' THEN 'SUCESSO' ELSE 'ERRO' END AS status_processamento
  FROM (SELECT *, concat_ws(';', {parts}) AS validation_errors FROM {source})"""


_NAME = ("nome IS NOT NULL AND length(trim(nome)) > 0", "Nome do feriado não pode ser vazio")
LITERAL_CHECKS = [
    ("data IS NOT NULL", "Data não pode ser nula"),
    ("estado IS NOT NULL AND length(estado) = 2", "Estado inválido"),
    _NAME,
    ("data IS NOT NULL", "Formato de data inválido"),
]
HOLIDAY_CHECKS = [
    ("data_raw IS NOT NULL", "Data não pode ser nula"),
    ("estado IS NOT NULL AND (estado = 'ALL' OR length(estado) = 2)", "Estado inválido"),
    _NAME,
    ("data_raw IS NULL OR data IS NOT NULL", "Formato de data inválido"),
]

CALENDAR_PARTS = [STATES, ORDERS_BY_STATE, SPAN, EASTER, RULES_SQL, CALENDAR]
DAY_PARTS = [*CALENDAR_PARTS, SPINE, JOINED]
RAW_PARTS = [STATES, ORDERS_BY_STATE, RAW]
CLEAN_PARTS = [*RAW_PARTS, CLEANED]


def sql(parts: list[str], body: str) -> str:
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
