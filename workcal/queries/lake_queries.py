"""Files, partitioned tables, upserts, and the layers end to end.

These write below the session's shared scratch folder and read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import one_row_per_key, upsert, upsert_table
from ..plans import LakePaths, bronze_rows, load_silver, run_lake, to_bronze, update_newest
from ..plans.bronze import BRONZE_PARTITIONS, QUARANTINE
from ..schemas import BRONZE, GOLD, REQUIRED_COLUMNS, SILVER, columns
from ..scratch import scratch_dir, stage
from ..sinks import write_csv, write_partitioned
from ..sources import in_partitions, json_columns_seen, read_csv, read_json_lines, read_table
from . import inputs as i
from .calendar_queries import MONTHLY_SQL
from .registry import query

# --- files -------------------------------------------------------------------


def _partitioned_orders(spark: SparkSession, sf: str, name: str, *by: str) -> DataFrame:
    path = scratch_dir(spark, name)
    day = F.col("o_orderdate")
    orders = i.table(spark, sf, "orders").withColumns({by[0]: F.year(day), by[1]: F.month(day)})
    write_partitioned(orders, path, by)
    return read_table(spark, path, orders.schema)


@query(
    """SELECT *, CAST(year(o_orderdate) AS INT) AS ano, CAST(month(o_orderdate) AS INT) AS mes
FROM orders WHERE year(o_orderdate) = 1997"""
)
def year_filter_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """One year of a table partitioned by year and month: reads that year's files only."""
    return _partitioned_orders(spark, sf, "orders", "ano", "mes").filter(F.col("ano") == 1997)


@query(
    """SELECT *, CAST(year(o_orderdate) AS INT) AS ano, CAST(month(o_orderdate) AS INT) AS mes
FROM orders WHERE year(o_orderdate) IN (
  SELECT year(o_orderdate) FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') >= count(*) / 3.0)"""
)
def year_set_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The years with a third of their orders finished, from a table of years that is itself
    computed: only the files of those years are read."""
    stored = _partitioned_orders(spark, sf, "orders", "ano", "mes")
    finished = F.count_if(F.col("o_orderstatus") == "F")
    years = stored.groupBy("ano").agg((finished / F.count("*")).alias("part")).filter(F.col("part") >= 1 / 3)
    return in_partitions(stored, stage(years.select("ano"), "years"))


@query(
    """SELECT CAST(year(o_orderdate) AS INT) AS ano_particao,
  CAST(month(o_orderdate) AS INT) AS mes_particao, count(*) AS records_processed
FROM orders GROUP BY 1, 2"""
)
def load_partition_info(spark: SparkSession, sf: str) -> DataFrame:
    """The partitions of a load and the rows in each."""
    written = _partitioned_orders(spark, sf, "bronze", "ano_particao", "mes_particao")
    return written.groupBy("ano_particao", "mes_particao").agg(
        F.count("*").alias("records_processed")
    )


@query("SELECT * FROM customer")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    customer = i.table(spark, sf, "customer")
    path = scratch_dir(spark, "customer-csv")
    write_csv(customer, path)
    return read_csv(spark, path, customer.schema)


@query("SELECT * FROM (SELECT COLUMNS(*)::VARCHAR FROM customer)")
def csv_as_text(spark: SparkSession, sf: str) -> DataFrame:
    """Without a schema every CSV column is text."""
    path = scratch_dir(spark, "customer-text")
    write_csv(i.table(spark, sf, "customer"), path)
    return read_csv(spark, path)


def _landed(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "records-json")
    i.as_json_lines(i.raw_records(spark, sf)).write.text(path)
    return path


_CUT = "coalesce(trim(nome) = '', false)"


@query(
    i.sql(
        i.RAW_PARTS,
        f"""SELECT {", ".join(f"CASE WHEN NOT {_CUT} THEN {c} END AS {c}"
                              for c in ("data", "nome", "tipo", "estado", "dt_processamento", "dt_carga"))},
  {_CUT} AS ilegivel, true AS tem_arquivo, CASE WHEN {_CUT} THEN 'INVALID' ELSE 'VALID' END AS status_processamento,
  2024 AS ano_particao, 3 AS mes_particao
FROM raw""",
    )
)
def json_landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines, some cut short, read with lineage and validity."""
    rows = bronze_rows(spark, _landed(spark, sf), i.LOAD_DATE, i.LOAD_TS)
    return rows.withColumns(
        {
            "ilegivel": F.col("_corrupt_record").isNotNull(),
            "tem_arquivo": F.col("source_file").contains("records-json"),
        }
    ).drop("source_file", "bronze_ingestion_tsp", "_corrupt_record")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_events_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows through JSON lines, to the microsecond."""
    events = i.table(spark, sf, "events")
    path = scratch_dir(spark, "events-json")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    events.write.option("timestampNTZFormat", micros).json(path)
    return read_json_lines(spark, path, events.schema).drop("_corrupt_record")


@query(
    i.sql(
        i.RAW_PARTS,
        f"""SELECT coluna, registros, registros > 0 AS presente FROM (
  SELECT unnest(['data', 'nome', 'tipo', 'estado', 'dt_carga', 'feriado']) AS coluna,
    unnest([count(data) FILTER (NOT {_CUT}), count(nome) FILTER (NOT {_CUT}), count(tipo) FILTER (NOT {_CUT}),
      count(estado) FILTER (NOT {_CUT}), count(dt_carga) FILTER (NOT {_CUT}), 0]) AS registros FROM raw)""",
    )
)
def required_columns(spark: SparkSession, sf: str) -> DataFrame:
    """How many landed records carry each required column, and one that none has."""
    return json_columns_seen(spark, _landed(spark, sf), [*REQUIRED_COLUMNS, "feriado"])


# --- upsert ------------------------------------------------------------------
# The table holds the orders up to a day; the load brings those from a year before
# that day on, with quantity and state taken from their line items. Together they
# are all orders: older ones stay, common ones may change, later ones are new.
# ``fila`` is part of the key and NULL for low-priority orders.

_KEYS = ("pedido", "fila")


def _queue() -> Column:
    return F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("fila")


def _target(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return i.table(spark, sf, "orders").filter(day < "1999-01-01").select(
        F.col("o_orderkey").alias("pedido"),
        _queue(),
        F.col("o_custkey").alias("cliente"),
        day.alias("data"),
        F.col("o_totalprice").alias("valor"),
        F.col("o_orderstatus").alias("situacao"),
        F.lit("VALID").alias("status"),
    )


def _load(spark: SparkSession, sf: str) -> DataFrame:
    """The load with single keys, staged: an upsert reads it several times."""
    day = F.col("o_orderdate").cast("date")
    items = i.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("valor"), F.max("l_linestatus").alias("situacao")
    )
    orders = i.table(spark, sf, "orders").filter(day >= "1998-01-01")
    load = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("pedido"),
        _queue(),
        F.col("o_custkey").alias("cliente"),
        day.alias("data"),
        "valor",
        "situacao",
        F.when(F.col("o_orderstatus") == "F", "VALID")
        .when(F.col("o_orderstatus") == "P", "INVALID")
        .alias("status"),
    )
    return stage(one_row_per_key(load, _KEYS), "load")


_UPSERT_PARTS = [
    """target AS (
  SELECT o_orderkey AS pedido, nullif(o_orderpriority, '5-LOW') AS fila, o_custkey AS cliente,
    CAST(o_orderdate AS DATE) AS data, o_totalprice AS valor, o_orderstatus AS situacao,
    'VALID' AS status, true AS in_target
  FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1999-01-01')""",
    """source AS (
  SELECT o_orderkey AS pedido, nullif(o_orderpriority, '5-LOW') AS fila, o_custkey AS cliente,
    CAST(o_orderdate AS DATE) AS data, valor, situacao,
    CASE o_orderstatus WHEN 'F' THEN 'VALID' WHEN 'P' THEN 'INVALID' END AS status, true AS in_source
  FROM orders LEFT JOIN (
    SELECT l_orderkey, sum(l_quantity) AS valor, max(l_linestatus) AS situacao
    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
  WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01')""",
]
_COLUMNS = ("pedido", "fila", "cliente", "data", "valor", "situacao", "status")


def _merge_sql(updated: tuple[str, ...], inserted: tuple[str, ...], insert_if: str) -> str:
    cols = ", ".join(
        f"CASE WHEN in_target IS NULL THEN {f's.{c}' if c in inserted else 'NULL'} "
        + (f"WHEN in_source AND s.status = 'VALID' THEN s.{c} " if c in updated else "")
        + f"ELSE t.{c} END AS {c}"
        for c in _COLUMNS
    )
    return f"""SELECT {cols}
FROM target t FULL JOIN source s ON t.pedido = s.pedido AND t.fila = s.fila
WHERE in_target OR {insert_if}"""


@query(i.sql(_UPSERT_PARTS, _merge_sql(_COLUMNS, _COLUMNS, "s.status = 'VALID'")))
def upsert_valid_only(spark: SparkSession, sf: str) -> DataFrame:
    """Valid rows replace or join the table; others change nothing."""
    valid = "source.status = 'VALID'"
    return upsert(
        _target(spark, sf),
        _load(spark, sf),
        _KEYS,
        update_if=valid,
        insert_if=valid,
        single_keys=True,
        large_load=True,
    )


_UPDATED = ("valor", "situacao")
_INSERTED = ("pedido", "fila", "data", "valor", "situacao", "status")


@query(i.sql(_UPSERT_PARTS, _merge_sql(_UPDATED, _INSERTED, "true")))
def upsert_partial_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Valid rows update two columns; every new row is inserted, without one column."""
    return upsert(
        _target(spark, sf),
        _load(spark, sf),
        _KEYS,
        update_if="source.status = 'VALID'",
        update_cols=_UPDATED,
        insert_cols=_INSERTED,
        single_keys=True,
        large_load=True,
    )


_MONTHS = columns("regiao string, ano int, mes int, registros bigint")


def _monthly(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy("regiao", F.year(day).alias("ano"), F.month(day).alias("mes")).agg(
        F.count("*").alias("registros")
    )


@query(
    i.sql(
        [
            i.STATES,
            i.ORDERS_BY_STATE,
            """target AS (
  SELECT regiao, CAST(year(dia) AS INT) AS ano, CAST(month(dia) AS INT) AS mes, count(*) AS registros
  FROM placed GROUP BY ALL)""",
            """source AS (
  SELECT regiao, CAST(year(l_shipdate) AS INT) AS ano, CAST(month(l_shipdate) AS INT) AS mes,
    count(*) AS registros
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN states ON s_nationkey = n_nationkey
  GROUP BY ALL)""",
        ],
        """SELECT regiao, ano, mes, coalesce(s.registros, t.registros) AS registros
FROM target t FULL JOIN source s USING (regiao, ano, mes)""",
    )
)
def upsert_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """A monthly table of order counts, refreshed with shipment counts."""
    path = scratch_dir(spark, "monthly")
    lineitem, supplier = i.table(spark, sf, "lineitem"), i.table(spark, sf, "supplier")
    shipped = (
        lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(i.states(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    loads = [_monthly(i.orders_by_state(spark, sf), "dia"), _monthly(shipped, "l_shipdate")]
    for load in loads:
        upsert_table(
            load,
            path,
            _MONTHS,
            ["regiao", "ano", "mes"],
            ["regiao", "ano"],
            partitions_follow_keys=True,
        )
    return read_table(spark, path, _MONTHS)


_BY_STATUS = columns("pedido bigint, cliente bigint, valor double, situacao string")


@query(
    """SELECT o_orderkey AS pedido, o_custkey AS cliente, o_totalprice AS valor,
  CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS situacao FROM orders"""
)
def upsert_moves_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders stored by status; all pending ones are completed, so they move to
    another partition and their own is left empty."""
    path = scratch_dir(spark, "by-status")
    stored = i.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pedido"),
        F.col("o_custkey").alias("cliente"),
        F.col("o_totalprice").alias("valor"),
        F.col("o_orderstatus").alias("situacao"),
    )
    completed = stored.filter(F.col("situacao") == "P").withColumn("situacao", F.lit("F"))
    for load in (stored, completed):
        upsert_table(
            load, path, _BY_STATUS, ["pedido"], ["situacao"], partitions_follow_keys=False
        )
    return read_table(spark, path, _BY_STATUS)


# --- layers ------------------------------------------------------------------

_ONE_PER_KEY = """QUALIFY row_number() OVER (PARTITION BY data, estado, dt_carga
  ORDER BY nome NULLS FIRST, tipo NULLS FIRST, dt_processamento NULLS FIRST) = 1"""


@query(
    i.sql(
        [*i.RAW_PARTS, f"readable AS (SELECT * FROM raw WHERE NOT {_CUT})"],
        f"""SELECT data, nome, tipo, estado, dt_processamento, dt_carga, 'VALID' AS status_processamento,
  2024 AS ano_particao, 3 AS mes_particao
FROM (
  SELECT * FROM readable WHERE data IS NOT NULL AND estado IS NOT NULL {_ONE_PER_KEY}
  UNION ALL
  SELECT * FROM readable WHERE data IS NULL OR estado IS NULL)
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'INVALID', 2024, 3
FROM raw WHERE {_CUT}""",
    )
)
def bronze_load(spark: SparkSession, sf: str) -> DataFrame:
    """One file loaded twice: complete keys match and stay single; records without a
    complete key are known again and all there once; unreadable lines go to quarantine once."""
    landed = _landed(spark, sf)
    bronze, quarantine = scratch_dir(spark, "bronze"), scratch_dir(spark, "quarantine")
    order = ["nome", "tipo", "dt_processamento"]
    for _ in range(2):
        to_bronze(
            spark, landed, bronze, quarantine, i.LOAD_DATE, i.LOAD_TS, keep_first=order
        )
    kept = read_table(spark, bronze, BRONZE)
    set_aside = read_table(spark, quarantine, QUARANTINE).drop("_corrupt_record")
    return kept.unionByName(set_aside).drop("source_file", "bronze_ingestion_tsp")


def _run_lake(spark: SparkSession, sf: str, **options) -> tuple[DataFrame, LakePaths]:
    """All layers in a fresh folder; returns the report and where the tables are."""
    paths, (first, last) = LakePaths.below(scratch_dir(spark, "lake")), i.years(spark, sf)
    report = run_lake(
        spark, i.rules(spark, sf), i.states(spark, sf), paths, i.LOAD_TS, first, last, **options
    )
    return report, paths


@query(MONTHLY_SQL)
def medallion_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Rules -> landing -> bronze -> silver -> gold of all years."""
    return read_table(spark, _run_lake(spark, sf)[1].gold, GOLD).drop("dt_processamento")


_DATE = f"TIMESTAMP '{i.LOAD_TS}' AS execution_date"


@query(
    i.sql(
        i.DAY_PARTS,
        f"""SELECT camada, 'total' AS item, CAST(NULL AS INT) AS ano, 'SUCESSO' AS status, count(*) AS total_records,
  count(*) FILTER (tipo = 'Nacional' AND camada = 'landing') AS national_holidays,
  count(*) FILTER (tipo = 'Estadual' AND camada = 'landing') AS state_holidays,
  NULL AS successful_records, NULL AS error_records, NULL AS total_holidays, NULL AS working_days,
  CAST(NULL AS BIGINT) AS regions_processed, true AS timed, CAST(NULL AS VARCHAR) AS error_message, {_DATE}
FROM calendar, (SELECT 'landing' AS camada) GROUP BY camada
UNION ALL
SELECT camada, 'total', NULL, CASE camada WHEN 'bronze' THEN 'PROCESSED' ELSE 'SUCESSO' END, count(*),
  NULL, NULL, count(*), CAST(0 AS BIGINT), NULL, NULL, NULL, true, NULL, {_DATE}
FROM calendar, (SELECT unnest(['bronze', 'silver']) AS camada) GROUP BY camada
UNION ALL
SELECT 'gold', 'total', NULL, 'SUCESSO', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  count(DISTINCT regiao), true, NULL, {_DATE}
FROM joined
UNION ALL
SELECT 'gold', regiao, ano, 'SUCESSO', NULL, NULL, NULL, NULL, NULL,
  CAST(sum(is_holiday) AS BIGINT), CAST(sum(dia_util) AS BIGINT), NULL, false, NULL, {_DATE}
FROM joined GROUP BY regiao, ano""",
    )
)
def lake_run_report(spark: SparkSession, sf: str) -> DataFrame:
    """One line per layer, and per region and year, of a whole gated run."""
    timed = F.coalesce(F.col("processing_time_seconds") > 0, F.lit(False))
    report = _run_lake(spark, sf)[0].withColumn("timed", timed).drop("processing_time_seconds")
    return report.withColumn("execution_date", F.col("execution_date").cast("timestamp_ntz"))


@query(MONTHLY_SQL)
def gold_after_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Two gated loads, the second of the last year alone: newest states and gold are brought
    up to date for what each load changed, and gold is as if computed at once."""
    paths, (first, last) = LakePaths.below(scratch_dir(spark, "lake")), i.years(spark, sf)
    rules, states = i.rules(spark, sf), i.states(spark, sf)
    for moment, since in ((i.LOAD_TS, first), (i.LOAD_TS + dt.timedelta(days=31), last)):
        run_lake(spark, rules, states, paths, moment, since, last, incremental=True)
    return read_table(spark, paths.gold, GOLD).drop("dt_processamento")


@query(
    i.sql(
        i.CLEAN_PARTS,
        """SELECT data, estado, dt_carga, nome, tipo FROM cleaned WHERE data IS NOT NULL AND estado IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY data, estado
  ORDER BY dt_carga DESC, nome NULLS FIRST, tipo NULLS FIRST) = 1""",
    )
)
def newest_state_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The raw records come into silver in two loads; each brings the stored newest states
    up to date, which then are those of the whole history."""
    paths = LakePaths.below(scratch_dir(spark, "lake"))
    records = i.raw_records(spark, sf).withColumns(
        {
            "source_file": F.lit("feed"),
            "bronze_ingestion_tsp": F.lit(i.LOAD_TS),
            "status_processamento": F.lit("VALID"),
            "ano_particao": F.lit(i.LOAD_DATE.year),
            "mes_particao": F.lit(i.LOAD_DATE.month),
        }
    )
    early = F.col("dt_carga") < "2024-01-03"
    for k, part in enumerate((early, ~early)):
        feed, moment = f"{paths.bronze}-{k}", i.LOAD_TS + dt.timedelta(days=k)
        write_partitioned(records.filter(part).select(*BRONZE.names), feed, BRONZE_PARTITIONS)
        _, changed = load_silver(spark, feed, paths.silver, moment)
        update_newest(spark, paths.silver, paths.newest, moment, changed)
    return read_table(spark, paths.newest, SILVER).select("data", "estado", "dt_carga", "nome", "tipo")
