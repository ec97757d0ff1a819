"""Loads that can be repeated, the gated chain, and gold kept up load by load."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from workcal.operators.calendar import default_rules
from workcal.operators.regions import region_map
from workcal.operators.upsert import upsert_table
from workcal.plans import (
    LakePaths,
    create_report_function,
    load_silver,
    newest_state,
    refresh_gold,
    run_lake,
    to_bronze,
    to_gold,
    to_silver,
    update_newest,
)
from workcal.plans.silver import SILVER_PARTITIONS
from workcal.schemas import BRONZE, GOLD, HOLIDAY_KEY, SILVER
from workcal.sinks import write_partitioned
from workcal.sources import from_rows, in_partitions, read_table

T1, T2 = dt.datetime(2024, 3, 1, 6), dt.datetime(2024, 4, 2, 6, 30)


@pytest.fixture
def paths(tmp_path):
    return LakePaths.below(str(tmp_path))


def rows(spark, path, schema, *drop):
    return sorted(map(tuple, read_table(spark, path, schema).drop(*drop).collect()), key=str)


def files(path):
    from pathlib import Path

    return {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}


def lines(report):
    return {(r.camada, r.item, r.ano): r for r in report.collect()}


def lake(spark, paths, ts=T1, **options):
    options = {"first": 2023, "last": 2025} | options
    return run_lake(
        spark, options.pop("rules", default_rules(spark)), region_map(spark), paths, ts, options.pop("first"), options.pop("last"), **options
    )


# --- repeated loads ----------------------------------------------------------

_RECORD = '{"data":%s,"nome":"%s","tipo":"estadual","estado":%s,"dt_processamento":"p","dt_carga":"c"}'


def test_three_runs_are_one(spark, paths, tmp_path):
    """Records without date or state, equal ones among them, an unreadable date, a broken line."""
    feed = [
        _RECORD % ('"2024-01-05"', "n", '"SP"'), _RECORD % ("null", "x", '"SP"'), _RECORD % ("null", "x", '"SP"'),
        _RECORD % ("null", "y", "null"), _RECORD % ('"soon"', "z", '"RJ"'), _RECORD % ('"2024-02-01"', "w", "null"), "{broken",
    ]
    (tmp_path / "feed.json").write_text("\n".join(feed) + "\n")
    stored = []
    for _ in range(3):
        metrics = to_bronze(spark, f"{tmp_path}/feed.json", paths.bronze, paths.quarantine, T1.date(), T1).first()
        assert (metrics.status, metrics.valid_records, metrics.invalid_records) == ("PROCESSED", 6, 1)
        to_silver(spark, paths.bronze, paths.silver, T1)
        stored.append((rows(spark, paths.bronze, BRONZE), rows(spark, paths.silver, SILVER)))
    assert stored[0] == stored[1] == stored[2]
    assert len(stored[0][0]) == 6
    # Silver keeps one row per date, state and load, also of those that lack one of them.
    assert len(stored[0][1]) == 5


def test_file_result_lists_the_partitions_it_changed(spark, paths, tmp_path):
    (tmp_path / "a.json").write_text(_RECORD % ('"2024-01-05"', "n", '"SP"') + "\n")
    first = to_bronze(spark, f"{tmp_path}/a.json", paths.bronze, paths.quarantine, T1.date(), T1).first()
    moved = to_bronze(spark, f"{tmp_path}/a.json", paths.bronze, paths.quarantine, T2.date(), T2).first()
    assert (first.particoes, moved.particoes) == (["2024-03"], ["2024-03", "2024-04"])


# --- the chain ---------------------------------------------------------------


def test_chain(spark, paths):
    found = lines(lake(spark, paths))
    assert len(found) == 4 + 5 * 3
    assert {r.execution_date for r in found.values()} == {T1}
    for layer, status in {"landing": "SUCESSO", "bronze": "PROCESSED", "silver": "SUCESSO", "gold": "SUCESSO"}.items():
        row = found[layer, "total", None]
        assert row.status == status and row.processing_time_seconds > 0 and row.error_message is None
    assert found["landing", "total", None].national_holidays == 29
    assert found["gold", "total", None].regions_processed == 5
    assert found["gold", "sul", 2024].total_holidays == 11


def test_gold_line_of_a_region_without_holidays(spark, paths):
    only = default_rules(spark).filter("scope = 'SP'")
    found = lines(lake(spark, paths, rules=only, first=2024, last=2024))
    assert found["gold", "total", None].status == "PARCIAL" and found["gold", "total", None].regions_processed == 5
    assert found["gold", "norte", 2024].status == "ERRO" and "norte" in found["gold", "norte", 2024].error_message
    assert found["gold", "sudeste", 2024].status == "SUCESSO"


def fault(spark, paths, layer):
    """Options and paths of a run in which ``layer`` fails."""
    if layer == "landing":
        return paths, {"rules": default_rules(spark).withColumn("kind", F.raise_error(F.lit("no calendar")).cast("string"))}
    if layer == "silver":
        return paths, {"gold_after": []}
    return paths._replace(**{layer: "nosuchfs://host/table"}), {}


@pytest.mark.parametrize("layer", ["landing", "bronze", "silver", "gold"])
def test_failing_layer(spark, paths, layer):
    """The report comes all the same: the layer's line, and those behind it skipped."""
    where, options = fault(spark, paths, layer)
    report = lines(lake(spark, where, **options))
    order = ["landing", "bronze", "silver", "gold"]
    at = order.index(layer)
    statuses = [report[name, "total", None].status for name in order]
    assert statuses[:at] == ["SUCESSO", "PROCESSED", "SUCESSO"][:at]
    assert statuses[at + 1 :] == ["IGNORADO"] * (3 - at)
    if layer != "silver":
        assert statuses[at] == ("ERROR" if layer == "bronze" else "ERRO") and report[layer, "total", None].error_message
    assert all(r.execution_date == T1 for r in report.values())
    assert all(report[name, "total", None].processing_time_seconds is None for name in order[at + 1 :])


def test_silver_with_faults_passes_unless_told_otherwise(spark, paths):
    from workcal.operators.quality import HOLIDAY_RULES, Rule

    checks = [*HOLIDAY_RULES, Rule("no_sunday", "dayofweek(data) <> 1", "Domingo")]
    found = lines(lake(spark, paths, checks=checks))
    assert found["silver", "total", None].status == "PARCIAL" and found["gold", "total", None].status == "SUCESSO"
    strict = lines(lake(spark, paths, checks=checks, gold_after=["SUCESSO"]))
    assert strict["gold", "total", None].status == "IGNORADO"


# --- newest states and gold kept up ------------------------------------------


def load_of(pick, number):
    """Holidays of a load: corrected and faulty ones, with gaps, over three years."""
    found = {}
    for _ in range(40):
        day = pick.choice([None, dt.date(pick.choice([2023, 2024, 2025]), pick.randint(1, 12), pick.randint(1, 3))])
        estado = pick.choice([None, "ALL", "SP", "RJ", "AC", "XX"])
        carga = pick.choice([f"load{number}", f"load{number}", f"load{number}", f"load{max(0, number - 1)}", None])
        moment = dt.datetime(2024, 1, 1 + number)
        status = pick.choice(["SUCESSO", "SUCESSO", "ERRO"])
        nome = pick.choice([None, "a", "b", "c"])
        found[day, estado, carga] = (
            day, nome, "Estadual", estado, "p", carga, "API", moment, status, "", moment,
            day.year if day else None, day.month if day else None,
        )
    return list(found.values()), dt.datetime(2024, 1, 1 + number)


def store(spark, paths, values):
    return upsert_table(
        from_rows(spark, values, SILVER), paths.silver, SILVER, HOLIDAY_KEY, SILVER_PARTITIONS, partitions_follow_keys=True,
        update_if="source.status_processamento = 'SUCESSO'", null_keys="match", identity=["data", "nome", "estado", "dt_carga"],
    )


def test_after_random_loads_all_is_as_computed_at_once(spark, paths):
    pick, states = random.Random(1), region_map(spark)
    for number in range(4):
        values, moment = load_of(pick, number)
        changed = store(spark, paths, values)
        update_newest(spark, paths.silver, paths.newest, moment, changed)
        refresh_gold(spark, paths.silver, paths.gold, states, moment, changed, newest_path=paths.newest)
    history = read_table(spark, paths.silver, SILVER).dropna(subset=["data", "estado"])
    names = ["data", "estado", "dt_carga", "nome", "status_processamento"]
    want = newest_state(history).select(*names).collect()
    got = read_table(spark, paths.newest, SILVER).select(*names).collect()
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 30
    to_gold(spark, paths.silver, paths.gold + "-at-once", states, 2023, moment, last_year=2025)
    assert rows(spark, paths.gold, GOLD, "dt_processamento") == rows(spark, paths.gold + "-at-once", GOLD, "dt_processamento")


def test_load_of_one_month_leaves_other_years_alone(spark, paths, plan):
    states = region_map(spark)
    lake(spark, paths, incremental=True)
    before, kept = files(paths.gold), files(paths.newest)
    day, stamp = dt.date(2024, 8, 6), T2
    one = [(day, "new", "Estadual", "SC", "p", "later", "API", stamp, "SUCESSO", "", stamp, 2024, 8)]
    changed = store(spark, paths, one)
    assert [tuple(p) for p in changed] == [(2024, 8)]
    assert [tuple(p) for p in update_newest(spark, paths.silver, paths.newest, stamp, changed)] == [(2024, 8)]
    metrics = refresh_gold(spark, paths.silver, paths.gold, states, stamp, changed, newest_path=paths.newest).collect()
    # One state of one region: its report of the year, and nothing else, is replaced.
    assert [(r.regiao, r.ano, r.processing_status) for r in metrics] == [("sul", 2024, "SUCESSO")]
    gone = before - files(paths.gold)
    assert gone and all("regiao=sul/ano=2024" in f for f in gone)
    assert all("ano=2024/mes=8" in f for f in files(paths.newest) ^ kept)
    august = read_table(spark, paths.gold, GOLD).filter("regiao = 'sul' AND ano = 2024 AND mes = 8").first()
    assert august.total_feriados == 1


def test_national_holiday_concerns_all_regions(spark, paths):
    lake(spark, paths, incremental=True)
    stamp = T2
    one = [(dt.date(2025, 8, 6), "new", "Nacional", "ALL", "p", "later", "API", stamp, "SUCESSO", "", stamp, 2025, 8)]
    changed = store(spark, paths, one)
    metrics = refresh_gold(spark, paths.silver, paths.gold, region_map(spark), stamp, changed).collect()
    assert {(r.regiao, r.ano) for r in metrics} == {(r, 2025) for r in ("norte", "nordeste", "centro_oeste", "sudeste", "sul")}


def test_repeated_load_changes_nothing(spark, paths):
    lake(spark, paths, incremental=True)
    _, changed = load_silver(spark, paths.bronze, paths.silver, T1)
    stored = rows(spark, paths.newest, SILVER), rows(spark, paths.gold, GOLD)
    update_newest(spark, paths.silver, paths.newest, T1, changed)
    refresh_gold(spark, paths.silver, paths.gold, region_map(spark), T1, changed, newest_path=paths.newest)
    assert (rows(spark, paths.newest, SILVER), rows(spark, paths.gold, GOLD)) == stored


# --- reports by parameter, partitions by list --------------------------------


def test_report_function_scans_the_report_once(spark, paths, plan):
    lake(spark, paths)
    gold = read_table(spark, paths.gold, GOLD)
    create_report_function(gold)
    one = spark.sql("SELECT mes, dias_uteis FROM dias_uteis('sudeste', 2024) ORDER BY mes").collect()
    assert [r.mes for r in one] == list(range(1, 13)) and one[6].dias_uteis == 22
    gold.select("regiao", "ano").distinct().write.parquet(paths.landing + "-groups")
    spark.read.parquet(paths.landing + "-groups").createOrReplaceTempView("wanted")
    every = spark.sql("SELECT d.* FROM wanted w, LATERAL dias_uteis(w.regiao, w.ano) d")
    assert sorted(map(str, every.collect())) == sorted(map(str, gold.collect()))
    text = plan(every).split("Initial Plan")[0]
    assert text.count(f"{paths.gold}]") == 1 and "NestedLoop" not in text and "Cartesian" not in text


def test_partitions_of_a_list_prune_the_scan(spark, plan, tmp_path):
    table = spark.range(1000).selectExpr("id", "int(id % 5) ano", "int(id % 3) mes")
    write_partitioned(table, f"{tmp_path}/t", ["ano", "mes"])
    spark.createDataFrame([(2,), (3,), (None,)], "ano int").write.parquet(f"{tmp_path}/y")
    found = in_partitions(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/y"))
    assert "dynamicpruningexpression" in plan(found)
    assert found.count() == 400


def test_written_partitions_are_observed(spark, tmp_path):
    schema = GOLD
    assert write_partitioned(from_rows(spark, [], schema), f"{tmp_path}/none", ["regiao", "ano"]) == []
    df = spark.range(50).selectExpr("id", "if(id % 2 = 0, null, 'a') g", "int(id % 3) n")
    got = write_partitioned(df, f"{tmp_path}/t", ["g", "n"])
    assert [tuple(p) for p in got] == [(None, 0), (None, 1), (None, 2), ("a", 0), ("a", 1), ("a", 2)]
