"""Rules of the calendar: complete scopes, validity without gaps and overlaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from workcal.operators.calendar import all_rules, default_rules, expand_rules, rule_conflicts, scopes_without_rules
from workcal.operators.regions import region_map
from workcal.plans import extract
from workcal.schemas import ALL_STATE_RULES, REGIONS, RULES
from workcal.sources import from_rows

STATES = sorted(uf for ufs in REGIONS.values() for uf in ufs)


@pytest.fixture
def scopes(spark):
    return region_map(spark).select(F.col("uf").alias("scope"))


def test_rules_of_all_27_states(spark, scopes):
    assert sorted({rule[5] for rule in ALL_STATE_RULES}) == STATES and len(STATES) == 27
    rules = all_rules(spark)
    assert scopes_without_rules(rules, scopes, 2023, 2030).count() == 0
    assert rule_conflicts(rules).count() == 0
    days = {(r.estado, r.nome): r.data for r in expand_rules(rules, 2024, 2024).collect()}
    assert days["RJ", "Terça-feira de Carnaval"] == dt.date(2024, 2, 13)
    assert days["ES", "Nossa Senhora da Penha"] == dt.date(2024, 4, 8)


def test_a_sample_is_not_taken_for_the_calendar(spark, scopes, tmp_path):
    missing = scopes_without_rules(default_rules(spark), scopes, 2024, 2025).collect()
    assert len(missing) == 2 * 23 and {r.scope for r in missing}.isdisjoint({"RJ", "BA", "SP", "RS"})
    moment = dt.datetime(2024, 3, 1)
    with pytest.raises(ValueError, match="AC"):
        extract(default_rules(spark), 2024, 2025, str(tmp_path), moment, scopes=scopes)
    row = extract(all_rules(spark), 2024, 2025, str(tmp_path), moment, scopes=scopes).first()
    assert row.status == "SUCESSO" and row.national_holidays == 20


def test_validity(spark):
    def rule(nome, first, last, kind="fixed", day=5, scope="SP", offset=None):
        return (nome, kind, 3, day, offset, scope, first, last)

    rows = [
        rule("a", None, 2020), rule("a", 2021, None, day=6),  # follow each other
        rule("b", 2000, 2010), rule("b", 2002, 2003), rule("b", 2009, None),  # the third meets the first
        rule("c", 2010, 2000), rule("d", None, None, "lunar"), rule("e", None, None, "easter"), rule("f", None, None, day=None),
        rule("a", 2000, None, scope="RJ"),
    ]
    found = {(r.scope, r.nome, r.valid_from, r.problem) for r in rule_conflicts(from_rows(spark, rows, RULES)).collect()}
    assert found == {
        ("SP", "b", 2002, "overlap"), ("SP", "b", 2009, "overlap"), ("SP", "c", 2010, "reversed"),
        ("SP", "d", None, "unknown kind"), ("SP", "e", None, "no date"), ("SP", "f", None, "no date"),
    }


def test_years_without_a_rule_in_force(spark):
    rows = [("a", "fixed", 3, 5, None, "SP", 2020, 2021), ("b", "fixed", 4, 5, None, "SP", 2023, None)]
    scopes = spark.createDataFrame([("SP",), ("RJ",)], "scope string")
    found = scopes_without_rules(from_rows(spark, rows, RULES), scopes, 2020, 2024).collect()
    assert {tuple(r) for r in found} == {("SP", 2022), *(("RJ", y) for y in range(2020, 2025))}
    none = scopes_without_rules(from_rows(spark, [], RULES), scopes, 2020, 2020)
    assert none.count() == 2
