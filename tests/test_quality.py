"""Cleaning, typing, deduplication and rules on the literal records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from workcal.functions.dates import load_stamp, parse_date
from workcal.operators.cleaning import clean, conform, first_per_key, latest_load, one_per_holiday
from workcal.operators.quality import (
    HOLIDAY_RULES,
    LITERAL_RULES,
    apply_rules,
    missing_columns,
    rule_metrics,
)
from workcal.plans import silver_rows
from workcal.schemas import REQUIRED_COLUMNS, SILVER, columns
from workcal.sources import from_rows

TS = dt.datetime(2024, 3, 1, 6)
RAW = columns(
    "id int, data string, nome string, tipo string, estado string, dt_processamento string, dt_carga string"
)
_LOAD = ("2024-03-01T00:00:00.000Z",) * 2
RECORDS = [
    (1, "2024-01-01", "  Ano   Novo ", "NACIONAL", "ALL", *_LOAD),
    (2, "2024/07/09", "Dia  da Revolucao", "estadual", "sp", *_LOAD),
    (3, "2024-13-01", "Dia Ruim", "ESTADUAL", "RJ", *_LOAD),
    (4, None, "Sem Data", "Estadual", "BA", *_LOAD),
    (5, "2024-07-02", "   ", "Estadual", "BA", *_LOAD),
    (6, "2024-09-20", "Farroupilha", "Estadual", "RSX", *_LOAD),
    (7, "2024-07-09", "Dia da Revolucao", "Estadual", "SP", *_LOAD),
]


@pytest.fixture(scope="module")
def typed(spark):
    return from_rows(spark, RECORDS, RAW).transform(clean).transform(conform, TS)


def test_cleaning_and_typing(typed):
    rows = {r.id: (r.nome, r.tipo, r.estado, r.data) for r in typed.collect()}
    assert rows == {
        1: ("Ano Novo", "Nacional", "ALL", dt.date(2024, 1, 1)),
        2: ("Dia da Revolucao", "Estadual", "SP", dt.date(2024, 7, 9)),
        3: ("Dia Ruim", "Estadual", "RJ", None),
        4: ("Sem Data", "Estadual", "BA", None),
        5: ("", "Estadual", "BA", dt.date(2024, 7, 2)),
        6: ("Farroupilha", "Estadual", "RSX", dt.date(2024, 9, 20)),
        7: ("Dia da Revolucao", "Estadual", "SP", dt.date(2024, 7, 9)),
    }
    row = typed.filter("id = 2").first()
    assert (row.ano, row.mes, row.fonte_dado, row.data_raw) == (2024, 7, "API_HOLIDAYS", "2024-07-09")


def _failed(df, rules):
    names = {r.message: r.name for r in rules}
    rows = apply_rules(df, rules).collect()
    for row in rows:
        assert row.status_processamento == ("ERRO" if row.validation_errors else "SUCESSO")
    return {
        r.id: ";".join(names[m] for m in r.validation_errors.split(";") if m) for r in rows
    }


def test_rules(typed):
    assert _failed(typed, HOLIDAY_RULES) == {
        1: "",
        2: "",
        3: "data_format",
        4: "data_not_null",
        5: "nome_not_empty",
        6: "estado_valid",
        7: "",
    }


def test_literal_rules(typed):
    assert _failed(typed, LITERAL_RULES) == {
        1: "estado_valid",
        2: "",
        3: "data_not_null;data_format",
        4: "data_not_null;data_format",
        5: "nome_not_empty",
        6: "estado_valid",
        7: "",
    }


def test_metrics(typed):
    row = rule_metrics(apply_rules(typed)).first()
    assert tuple(row) == (7, 3, 4, 1, 1, 1, 1, "PARCIAL")
    literal = rule_metrics(apply_rules(typed, LITERAL_RULES), LITERAL_RULES).first()
    assert tuple(literal) == (7, 2, 5, 2, 2, 1, 2, "PARCIAL")


@pytest.mark.parametrize("ids, status", [([1, 2], "SUCESSO"), ([3, 4], "ERRO"), ([1, 3], "PARCIAL")])
def test_run_status(typed, ids, status):
    row = rule_metrics(apply_rules(typed.filter(F.col("id").isin(ids)))).first()
    assert row.processing_status == status


def test_one_row_per_holiday_after_cleaning(typed):
    rows = one_per_holiday(typed).collect()
    assert len(rows) == 6
    assert len({r.id for r in rows} & {2, 7}) == 1


def test_unreadable_dates_stay_apart(spark):
    rows = [
        (k, data, "n", "Estadual", "SP", *_LOAD)
        for k, data in enumerate(["2024-13-01", "2024-13-02", "2024-1-5", "2024/01/05", None, None])
    ]
    typed = from_rows(spark, rows, RAW).transform(clean).transform(conform, TS)
    kept = one_per_holiday(typed).collect()
    assert sorted(str(r.data_raw) for r in kept if r.data is None) == ["2024-13-01", "2024-13-02", "None"]
    assert [r.data for r in kept if r.data] == [dt.date(2024, 1, 5)]


def test_survivor_does_not_depend_on_row_order(spark):
    rows = [(k % 5, f"v{k}", k) for k in range(200)]
    schema = columns("k int, v string, n int")
    picks = [
        sorted(map(tuple, first_per_key(from_rows(spark, data, schema), ["k"], [F.desc("n")]).collect()))
        for data in (rows, rows[::-1])
    ]
    assert picks[0] == picks[1] == [(k, f"v{195 + k}", 195 + k) for k in range(5)]


def test_latest_load(spark):
    schema = columns("data date, estado string, dt_carga string, nome string, tipo string")
    day = dt.date(2024, 1, 1)
    rows = [(day, "ALL", f"2024-0{m}-01", f"nome {m}", "Nacional") for m in (1, 3, 2)]
    assert [r.nome for r in latest_load(from_rows(spark, rows, schema)).collect()] == ["nome 3"]


def test_missing_columns(spark):
    df = from_rows(spark, RECORDS, RAW)
    assert missing_columns(df, REQUIRED_COLUMNS) == []
    assert missing_columns(df.drop("estado", "data"), REQUIRED_COLUMNS) == ["data", "estado"]


def test_silver_has_its_columns_and_marks_bad_rows(spark):
    out = silver_rows(from_rows(spark, RECORDS, RAW), TS)
    assert out.columns == SILVER.names
    rows = out.collect()
    assert len(rows) == 6
    assert sum(r.status_processamento == "ERRO" for r in rows) == 4
    assert {r.silver_timestamp for r in rows} == {r.last_updated for r in rows} == {TS}


def test_only_whole_dates_are_dates(spark):
    texts = ["2024-7-9", "2024-07-09", "2024", "2024-05", "2024-07-09 xyz", "2024-07-09Tgarbage", "2024-02-30", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_date(F.col("t")).cast("string"))
    assert [r[0] for r in rows.collect()] == ["2024-07-09", "2024-07-09", *[None] * 6]


def test_load_time_without_a_zone_is_utc_in_any_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamp = spark.range(1).select(F.unix_seconds(load_stamp(dt.datetime(2024, 4, 1, 6)))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert stamp == 1711951200
