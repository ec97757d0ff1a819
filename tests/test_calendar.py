"""Spine, rules, regions and working days on literal fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from workcal.functions.dates import easter_sunday
from workcal.operators.calendar import default_rules, expand_rules, merge_same_day
from workcal.operators.regions import holds_in, holidays_by_region, is_valid, region_map
from workcal.operators.workdays import (
    calendar_join,
    day_counts,
    holiday_counts,
    monthly_workdays,
    region_holiday_counts,
    region_totals,
    state_holiday_counts,
    workday_flags,
    workday_profile,
)
from workcal.plans.gold import create_views, region_days, view_name
from workcal.schemas import REGIONS, RULES, columns
from workcal.sources import date_spine, from_rows, group_spine

D = dt.date
HOLIDAY = columns("data date, estado string, nome string")
REGIONS_SMALL = {"norte": ["AC", "AP"], "nordeste": ["BA"], "sudeste": ["SP", "RJ"], "sul": ["PR"]}
RECORDS = [
    (D(2024, 1, 1), "ALL", "Ano Novo"),
    (D(2024, 1, 6), "ALL", "Reis"),
    (D(2024, 1, 15), "SP", "x"),
    (D(2024, 1, 15), "RJ", "y"),
    (D(2024, 2, 1), "PR", "z"),
    (D(2024, 2, 2), None, "q"),
    (D(2024, 2, 5), "BA", None),
]


@pytest.fixture(scope="module")
def holidays(spark):
    return from_rows(spark, RECORDS, HOLIDAY)


@pytest.fixture(scope="module")
def states(spark):
    return region_map(spark, REGIONS_SMALL)


def test_region_map_is_complete(spark):
    rows = region_map(spark).collect()
    assert len(rows) == 27 and len({r.regiao for r in rows}) == 5
    assert {r.uf for r in rows} == {uf for ufs in REGIONS.values() for uf in ufs}


def test_spine(spark):
    rows = date_spine(spark, D(2024, 1, 1), D(2024, 12, 31)).collect()
    assert len(rows) == 366 == len({r.data for r in rows})
    first = min(rows)
    assert tuple(first) == (D(2024, 1, 1), 2, 1, 2024)  # a Monday


def test_spine_of_an_empty_range(spark):
    assert date_spine(spark, D(2024, 1, 2), D(2024, 1, 1)).count() == 0


def test_easter_against_published_dates_and_sundays(spark):
    years = spark.range(1900, 2100).select(F.col("id").cast("int").alias("y"))
    found = {r.y: r.e for r in years.select("y", easter_sunday("y").alias("e")).collect()}
    assert found[2024] == D(2024, 3, 31)
    assert found[2025] == D(2025, 4, 20)
    assert found[2026] == D(2026, 4, 5)
    # The earliest and latest dates in the period.
    assert found[1943] == D(1943, 4, 25) and found[2038] == D(2038, 4, 25)
    assert found[1913] == D(1913, 3, 23) and found[2008] == D(2008, 3, 23)
    # The two exceptions of the simpler rules.
    assert found[1954] == D(1954, 4, 18) and found[1981] == D(1981, 4, 19)
    assert all(e.isoweekday() == 7 and D(y, 3, 22) <= e <= D(y, 4, 25) for y, e in found.items())


def test_default_calendar(spark):
    rows = expand_rules(default_rules(spark), 2023, 2025).collect()
    by_year = {y: {(r.data, r.estado) for r in rows if r.data.year == y} for y in (2023, 2024, 2025)}
    assert (D(2024, 3, 29), "ALL") in by_year[2024]  # Good Friday
    assert (D(2023, 11, 20), "ALL") not in by_year[2023]
    assert (D(2024, 11, 20), "ALL") in by_year[2024] and (D(2025, 11, 20), "ALL") in by_year[2025]
    assert (D(2024, 7, 9), "SP") in by_year[2024]
    assert {(r.tipo, r.estado == "ALL") for r in rows} == {("Nacional", True), ("Estadual", False)}
    assert [len(by_year[y]) for y in (2023, 2024, 2025)] == [13, 14, 14]


def test_rule_bounds_and_leap_day(spark):
    rules = from_rows(
        spark,
        [
            ("leap", "fixed", 2, 29, None, "ALL", None, None),
            ("past", "fixed", 5, 5, None, "SP", 1990, 2000),
            ("later", "fixed", 5, 5, None, "SP", 2025, None),
            ("broken", "easter", None, None, None, "ALL", None, None),
        ],
        RULES,
    )
    rows = expand_rules(rules, 2023, 2025).collect()
    assert {(r.nome, r.data) for r in rows} == {
        ("leap", D(2024, 2, 29)),
        ("later", D(2025, 5, 5)),
    }


def test_holidays_on_one_day_are_one_record(spark):
    # In 2000 Good Friday fell on 21 April.
    rows = merge_same_day(expand_rules(default_rules(spark), 2000, 2000)).collect()
    assert len(rows) == len({(r.data, r.estado) for r in rows}) == 12
    assert {r.nome for r in rows if r.data == D(2000, 4, 21)} == {"Sexta-feira Santa; Tiradentes"}


def test_filters(holidays):
    assert holidays.filter(holds_in(["SP", "RJ"])).count() == 4
    assert holidays.filter(is_valid()).count() == 5


def test_monthly_report(spark, holidays, states):
    rows = {
        (r.regiao, r.mes): tuple(r)[3:]
        for r in monthly_workdays(region_days(holidays, states, 2024, 2024), ["regiao"]).collect()
    }
    assert len(rows) == 48
    # dias_uteis, total_feriados, total_dias, percentual, dias_calendario, dias_com_feriado
    assert rows["sudeste", 1] == (21, 4, 32, 0.125, 31, 3)
    assert rows["sudeste", 2] == (21, 0, 29, 0.0, 29, 0)
    assert rows["sul", 1] == (22, 2, 31, 2 / 31, 31, 2)
    assert rows["sul", 2] == (20, 1, 29, 1 / 29, 29, 1)
    for regiao in ("norte", "nordeste"):
        assert rows[regiao, 1] == (22, 2, 31, 2 / 31, 31, 2)
        assert rows[regiao, 2] == (21, 0, 29, 0.0, 29, 0)


def test_joined_form_gives_the_same_totals(spark, holidays, states):
    spine = group_spine(states.select("regiao").distinct(), D(2024, 1, 1), D(2024, 12, 31))
    flags = workday_flags(calendar_join(spine, holidays_by_region(holidays, states), ["regiao"]))
    joined = flags.groupBy("regiao", "ano", "mes").agg(
        F.sum("dia_util"),
        F.sum("is_holiday"),
        F.count("data"),
        F.avg("is_holiday"),
        F.countDistinct("data"),
        F.countDistinct(F.when(F.col("is_holiday") == 1, F.col("data"))),
    )
    counted = monthly_workdays(region_days(holidays, states, 2024, 2024), ["regiao"])
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, counted.collect()))
    days = flags.select("regiao", "data").distinct().groupBy("regiao").count().collect()
    assert [r["count"] for r in days] == [366] * 4


def test_holiday_columns_do_not_clash_with_the_spine(spark, holidays):
    spine = date_spine(spark, D(2024, 1, 1), D(2024, 1, 31))
    clash = holidays.withColumn("mes", F.lit(99)).withColumn("ano", F.lit(99))
    rows = calendar_join(spine, clash).collect()
    assert {r.mes for r in rows} == {1} and {r.ano for r in rows} == {2024}


def test_days_add_up(spark, holidays, states):
    days = region_days(holidays, states, 2024, 2024)
    weekend = F.col("dia_semana").isin(1, 7)
    parts = days.groupBy("regiao").agg(
        F.sum("dia_util").alias("u"),
        F.count_if(weekend).alias("w"),
        F.count_if(~weekend & (F.col("n_feriados") > 0)).alias("h"),
        F.count("*").alias("n"),
    )
    assert all(r.u + r.w + r.h == r.n == 366 for r in parts.collect())


def test_states_on_their_own(spark, holidays, states):
    spine = group_spine(states.select(F.col("uf").alias("estado")), D(2024, 1, 1), D(2024, 1, 31))
    days = day_counts(spine, state_holiday_counts(holidays, states), ["estado"])
    rows = {r.estado: r.dias_uteis for r in monthly_workdays(days, ["estado"]).collect()}
    assert rows == {"SP": 21, "RJ": 21, "AC": 22, "AP": 22, "BA": 22, "PR": 22}


def test_totals_and_a_region_without_holidays(spark, states):
    only_sp = from_rows(spark, [(D(2024, 1, 15), "SP", "x")], HOLIDAY)
    monthly = monthly_workdays(region_days(only_sp, states, 2024, 2024), ["regiao"])
    rows = {r.regiao: r for r in region_totals(monthly).collect()}
    assert rows["sudeste"].processing_status == "SUCESSO"
    assert rows["sudeste"].total_holidays == 1 and rows["sudeste"].working_days == 261
    assert rows["sudeste"].holiday_percentage == 1 / 366 * 100
    assert tuple(rows["sul"])[2:6] == (0, 0, 0.0, "ERRO")
    assert "sul" in rows["sul"].error_message
    # A group with no monthly row at all is reported too.
    groups = states.select("regiao").distinct().withColumn("ano", F.lit(2024))
    filtered = region_totals(monthly.filter("regiao = 'sudeste'"), groups=groups).collect()
    assert sorted(map(tuple, filtered)) == sorted(map(tuple, rows.values()))


def test_views(spark, holidays, states):
    monthly = monthly_workdays(region_days(holidays, states, 2024, 2024), ["regiao"])
    create_views(monthly, ["sul"], 2024)
    assert view_name("sul", 2024) == "dias_uteis_sul_2024"
    rows = spark.sql("SELECT mes FROM dias_uteis_sul_2024").collect()
    assert [r.mes for r in rows] == list(range(1, 13))


def test_profile_of_facts_with_one_hot_day(spark):
    """A third of all facts on one day; facts beyond the calendar are kept."""
    pick = random.Random(5)
    hot = D(2024, 1, 1)
    facts = [(hot if k < 1000 else D(2024, 1, 1) + dt.timedelta(pick.randrange(40)), k % 3, k) for k in range(3000)]
    table = from_rows(spark, facts, columns("dia date, tipo int, valor bigint"))
    spine = date_spine(spark, D(2024, 1, 1), D(2024, 1, 31))
    holidays = from_rows(spark, [(hot, "ALL", "Ano Novo")], HOLIDAY)
    got = workday_profile(
        table,
        day_counts(spine, holiday_counts(holidays)),
        date="dia",
        keep=["tipo"],
        measures={"n": F.lit(1).cast("long"), "valor": F.col("valor")},
    ).collect()
    want = {}
    for day, kind, value in facts:
        util = None if day.month > 1 else int(day != hot and day.isoweekday() < 6)
        n, v = want.get((kind, util), (0, 0))
        want[kind, util] = (n + 1, v + value)
    assert {(r.tipo, r.dia_util): (r.n, r.valor) for r in got} == want


def test_counts_with_one_hot_scope(spark, states):
    """A third of all holidays under one state, many of them on one day."""
    pick = random.Random(7)
    scopes = ["ALL", "SP", "RJ", "PR", "BA", "AC", None]
    rows = []
    for k in range(3000):
        estado = "ALL" if k < 1000 else pick.choice(scopes)
        data = D(2024, 1, 1) if k < 700 else D(2024, 1, 1) + dt.timedelta(pick.randrange(20))
        rows.append((data, estado, f"n{k}" if k % 11 else None))
    got = region_holiday_counts(from_rows(spark, rows, HOLIDAY), states).collect()
    want = {}
    for data, estado, nome in rows:
        if nome is None or estado is None:
            continue
        for regiao, ufs in REGIONS_SMALL.items():
            if estado == "ALL" or estado in ufs:
                want[regiao, data] = want.get((regiao, data), 0) + 1
    assert {(r.regiao, r.data): r.n_feriados for r in got} == want
