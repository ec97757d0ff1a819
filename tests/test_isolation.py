"""A faulty region does not stop the others; paths of another Hadoop scheme."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from workcal.operators.calendar import default_rules
from workcal.operators.regions import region_map
from workcal.operators.workdays import region_faults, with_faults, without_faults
from workcal.plans import LakePaths, load_silver, refresh_gold, run_lake, to_gold
from workcal.schemas import GOLD, SILVER
from workcal.sources import from_rows, read_table, table_exists
from workcal.storage import remove_folder

T1, T2 = dt.datetime(2024, 3, 1, 6), dt.datetime(2024, 4, 2, 6, 30)
STATES = [("norte", "AC"), ("norte", "PA"), ("sul", "RS")]


@pytest.fixture
def states(spark):
    return spark.createDataFrame(STATES, "regiao string, uf string")


def faults_of(spark, states, rows):
    records = spark.createDataFrame(rows, "estado string, raw string, ano int")
    bad = F.when(F.try_to_date("raw", "yyyy-MM-dd").isNull(), F.concat(F.lit("data: "), F.coalesce("raw", F.lit("-"))))
    return region_faults(records, states, bad)


def test_faults_by_region_and_year(spark, states):
    rows = [("AC", "2024-01-01", 2024), ("AC", "x2", 2024), ("PA", "x1", 2024), ("RS", "z", None), ("XX", "q", 2024), (None, "q", 2024)]
    got = {tuple(r) for r in faults_of(spark, states, rows).collect()}
    assert got == {("norte", 2024, "data: x1"), ("sul", None, "data: z")}
    everywhere = faults_of(spark, states, [("ALL", None, 2023)])
    assert {tuple(r) for r in everywhere.collect()} == {("norte", 2023, "data: -"), ("sul", 2023, "data: -")}
    assert faults_of(spark, states, rows[:1]).count() == 0


def test_totals_with_faults(spark, states):
    kinds = "regiao string, ano int, total_holidays long, working_days long, holiday_percentage double, processing_status string, error_message string"
    fine = [(r, y, 9, 250, 2.5, "SUCESSO", None) for r in ("norte", "sul") for y in (2023, 2024)]
    totals = spark.createDataFrame(fine, kinds)
    faults = spark.createDataFrame([("norte", 2024, "a"), ("sul", None, "c"), ("sul", 2023, "b")], "regiao string, ano int, falha string")
    got = {(r.regiao, r.ano): (r.processing_status, r.total_holidays, r.error_message) for r in with_faults(totals, faults).collect()}
    assert got == {
        ("norte", 2023): ("SUCESSO", 9, None), ("norte", 2024): ("ERRO", 0, "a"),
        ("sul", 2023): ("ERRO", 0, "b"), ("sul", 2024): ("ERRO", 0, "c"),
    }
    assert [(r.regiao, r.ano) for r in without_faults(totals, faults).collect()] == [("norte", 2023)]
    assert with_faults(totals, faults.limit(0)).collect() == totals.collect()


def test_gold_goes_on_without_the_faulty_region(spark, tmp_path):
    """Its stored months stay those of the run before; all others are those of this run."""
    paths, states = LakePaths.below(str(tmp_path)), region_map(spark)
    run_lake(spark, default_rules(spark), states, paths, T1, 2023, 2024)
    faults = spark.createDataFrame([("sul", 2024, "defeito")], "regiao string, ano int, falha string")
    metrics = to_gold(spark, paths.silver, paths.gold, states, 2023, T2, last_year=2024, faults=faults).collect()
    bad = {(r.regiao, r.ano): r.error_message for r in metrics if r.processing_status == "ERRO"}
    assert bad == {("sul", 2024): "defeito"} and len(metrics) == 10
    stored = read_table(spark, paths.gold, GOLD).select("regiao", "ano", "dt_processamento").distinct().collect()
    assert {(r.regiao, r.ano) for r in stored if r.dt_processamento == T1} == {("sul", 2024)}
    assert len(stored) == 10


@pytest.fixture
def mounted(spark, tmp_path):
    """A mount table: ``viewfs://lake/data`` is a local folder, known to the session alone."""
    key = "fs.viewfs.mounttable.lake.link./data"
    spark.conf.set(key, tmp_path.as_uri())
    yield "viewfs://lake/data"
    spark.conf.unset(key)


def test_lake_on_a_mounted_file_system(spark, mounted, tmp_path):
    """All layers, a second load and a refresh on another scheme."""
    paths, states = LakePaths.below(f"{mounted}/lake"), region_map(spark)
    assert not table_exists(spark, paths.silver)
    for ts in (T1, T2):
        report = run_lake(spark, default_rules(spark), states, paths, ts, 2023, 2024, incremental=True).collect()
        assert {r.status for r in report if r.item == "total"} <= {"SUCESSO", "PROCESSED"}, report
    assert table_exists(spark, paths.silver)
    assert (tmp_path / "lake" / "gold").is_dir()
    local = LakePaths.below(str(tmp_path / "lake"))
    same = [sorted(map(str, read_table(spark, p.gold, GOLD).collect())) for p in (paths, local)]
    assert same[0] == same[1] and len(same[0]) == 120
    _, changed = load_silver(spark, paths.bronze, paths.silver, T2)
    refresh_gold(spark, paths.silver, paths.gold, states, T2, changed, newest_path=paths.newest)
    assert read_table(spark, paths.silver, SILVER).count() == read_table(spark, local.silver, SILVER).count()
    remove_folder(spark, paths.landing)
    assert not (tmp_path / "lake" / "landing").exists()


def test_csv_and_json_on_a_mounted_file_system(spark, mounted):
    from workcal.schemas import REGION_MAP
    from workcal.sinks import write_csv, write_json
    from workcal.sources import missing_json_columns, read_csv, read_json_lines

    rows = from_rows(spark, STATES, REGION_MAP)
    write_csv(rows, f"{mounted}/c")
    write_json(rows, f"{mounted}/j")
    assert sorted(map(tuple, read_csv(spark, f"{mounted}/c", REGION_MAP).collect())) == STATES
    got = read_json_lines(spark, f"{mounted}/j", REGION_MAP).drop("_corrupt_record")
    assert sorted(map(tuple, got.collect())) == STATES
    assert missing_json_columns(spark, f"{mounted}/j", ["regiao", "x"]) == ["x"]
