"""The lake end to end in a fresh folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from workcal.operators.calendar import default_rules
from workcal.operators.regions import region_map
from workcal.plans import extract, landing_path, run_report, to_bronze, to_gold, to_silver
from workcal.plans.bronze import QUARANTINE
from workcal.plans.landing import iso_millis
from workcal.schemas import BRONZE, GOLD, LANDING, SILVER
from workcal.sources import read_json_lines, read_table

T1, T2 = dt.datetime(2024, 3, 1, 6), dt.datetime(2024, 4, 2, 6, 30, 0, 123456)


class Lake:
    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)

    def path(self, layer):
        return f"{self.base}/{layer}"

    def load(self, ts, year=2024):
        landing = extract(default_rules(self.spark), 2023, 2025, self.path("landing"), ts)
        return landing, *self.refine(landing_path(self.path("landing"), ts), ts, year)

    def refine(self, file, ts, year=2024):
        bronze = self.bronze(file, ts)
        silver = to_silver(self.spark, self.path("bronze"), self.path("silver"), ts)
        return bronze, silver, self.gold_run(ts, year)

    def bronze(self, file, ts, **options):
        return to_bronze(
            self.spark, file, self.path("bronze"), self.path("quarantine"), ts.date(), ts, **options
        )

    def gold_run(self, ts, year):
        return to_gold(
            self.spark, self.path("silver"), self.path("gold"), region_map(self.spark), year, ts
        )

    def rows(self, layer, schema, *drop):
        table = read_table(self.spark, self.path(layer), schema).drop(*drop)
        return sorted(map(tuple, table.collect()), key=str)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_iso_millis():
    assert iso_millis(T2) == "2024-04-02T06:30:00.123Z"
    east = dt.timezone(dt.timedelta(hours=-3))
    assert iso_millis(dt.datetime(2024, 1, 1, 21, tzinfo=east)) == "2024-01-02T00:00:00.000Z"


def test_run_and_rerun(lake):
    landing, bronze, silver, gold = lake.load(T1)
    row = landing.first()
    assert (row.status, row.total_records) == ("SUCESSO", 41)
    assert (row.national_holidays, row.state_holidays) == (29, 12)
    assert row.dt_carga == "2024-03-01T06:00:00.000Z" and row.file_path.endswith("holidays_2024-03-01.json")
    row = bronze.first()
    assert (row.status, row.records_processed, row.invalid_records) == ("PROCESSED", 41, 0)
    assert (row.ano, row.mes) == (2024, 3)
    row = silver.first()
    # National holidays pass: their scope is a valid state.
    assert (row.status, row.total_records, row.error_records, row.estado_valid) == ("SUCESSO", 41, 0, 0)
    assert {r.regiao: r.processing_status for r in gold.collect()} == dict.fromkeys(
        ["norte", "nordeste", "centro_oeste", "sudeste", "sul"], "SUCESSO"
    )
    layers = [("bronze", BRONZE), ("silver", SILVER), ("gold", GOLD)]
    first = {name: lake.rows(name, schema) for name, schema in layers}
    assert len(first["gold"]) == 60 and len(first["silver"]) == 41

    # The same load again changes nothing (but the names of the landed files).
    first["bronze"] = lake.rows("bronze", BRONZE, "source_file")
    lake.load(T1)
    assert lake.rows("bronze", BRONZE, "source_file") == first["bronze"]
    assert lake.rows("silver", SILVER) == first["silver"]
    assert lake.rows("gold", GOLD) == first["gold"]

    # A new load is kept in silver beside the old one, and counts once in gold.
    lake.load(T2)
    assert len(lake.rows("silver", SILVER)) == 82
    assert lake.rows("gold", GOLD, "dt_processamento") == sorted(
        (r[:-1] for r in first["gold"]), key=str
    )
    # Another year leaves the first one alone.
    lake.gold_run(T2, 2025)
    assert len(lake.rows("gold", GOLD)) == 120


def test_gold_of_known_months(lake, spark):
    lake.load(T1)
    gold = read_table(spark, lake.path("gold"), GOLD)
    july = {r.regiao: (r.dias_uteis, r.total_feriados) for r in gold.filter("mes = 7").collect()}
    # July 2024 has 23 weekdays; SP keeps the 9th and BA the 2nd.
    assert july["sudeste"] == (22, 1) and july["nordeste"] == (22, 1) and july["sul"] == (23, 0)


def test_views_over_the_stored_report(lake, spark):
    lake.load(T1)
    to_gold(
        spark, lake.path("silver"), lake.path("gold"), region_map(spark), 2024, T1, views=True
    )
    rows = spark.sql("SELECT mes, total_dias FROM dias_uteis_centro_oeste_2024").collect()
    assert [r.mes for r in rows] == list(range(1, 13)) and sum(r.total_dias for r in rows) == 366


def test_landing_columns(lake, spark):
    landing = lake.load(T1)[0].first()
    rows = read_json_lines(spark, landing.file_path, LANDING)
    assert rows.filter(F.col("_corrupt_record").isNull()).select("dt_carga", "nome").distinct().count() > 10


def _file(tmp_path, *lines):
    file = tmp_path / "feed.json"
    file.write_text("\n".join(lines) + "\n")
    return str(file)


_GOOD = '{"data":"2024-0%d-05","nome":"n","tipo":"estadual","estado":"%s","dt_carga":"c"}'


def test_unreadable_lines_go_to_quarantine(lake, spark, tmp_path):
    file = _file(tmp_path, _GOOD % (1, "sp"), "{broken", _GOOD % (2, "RJ"))
    row = lake.bronze(file, T1).first()
    assert (row.status, row.records_processed, row.valid_records, row.invalid_records) == ("PROCESSED", 3, 2, 1)
    stored = read_table(spark, lake.path("bronze"), BRONZE).collect()
    assert {(r.data, r.status_processamento) for r in stored} == {("2024-01-05", "VALID"), ("2024-02-05", "VALID")}
    assert all(r.source_file.endswith("feed.json") and r.bronze_ingestion_tsp == T1 for r in stored)
    bad = read_table(spark, lake.path("quarantine"), QUARANTINE).collect()
    assert [(r._corrupt_record, r.status_processamento) for r in bad] == [("{broken", "INVALID")]


def test_repeated_load_adds_nothing_to_quarantine(lake, spark, tmp_path):
    file = _file(tmp_path, _GOOD % (1, "sp"), "{broken")
    for _ in range(3):
        assert lake.bronze(file, T1).first().status == "PROCESSED"
    assert read_table(spark, lake.path("quarantine"), QUARANTINE).count() == 1
    assert read_table(spark, lake.path("bronze"), BRONZE).count() == 1


def test_unknown_file_system_is_reported(lake):
    row = lake.bronze("nosuchfs://host/in.json", T1).first()
    assert row.status == "ERROR" and row.records_processed == 0


def test_file_without_a_required_column(lake, tmp_path):
    row = lake.bronze(_file(tmp_path, '{"data":"2024-01-01","nome":"n"}'), T1).first()
    assert row.status == "INVALID" and row.records_processed == 1
    assert "tipo, estado, dt_carga" in row.error_message
    assert not (tmp_path / "bronze").exists()


def test_missing_file(lake, tmp_path):
    row = lake.bronze(f"{tmp_path}/none.json", T1).first()
    assert row.status == "ERROR" and row.records_processed == 0 and "PATH_NOT_FOUND" in row.error_message


def test_repeated_keys_in_one_file(lake, spark, tmp_path):
    file = _file(tmp_path, _GOOD % (1, "SP"), _GOOD % (1, "SP"))
    assert lake.bronze(file, T1).first().status == "ERROR"
    assert lake.bronze(file, T1, keep_first=["nome"]).first().status == "PROCESSED"
    assert read_table(spark, lake.path("bronze"), BRONZE).count() == 1


def test_corrected_record_replaces_the_old_one(lake, spark, tmp_path):
    lake.refine(_file(tmp_path, _GOOD % (1, "SP")), T1)
    lake.refine(_file(tmp_path, (_GOOD % (1, "SP")).replace('"n"', '"  new   name "')), T2)
    rows = read_table(spark, lake.path("silver"), SILVER).collect()
    assert [(r.nome, r.tipo, r.estado) for r in rows] == [("new name", "Estadual", "SP")]
    assert rows[0].last_updated == T2
    # The row moved to the later load's partition of bronze.
    stored = read_table(spark, lake.path("bronze"), BRONZE).collect()
    assert [(r.ano_particao, r.mes_particao) for r in stored] == [(2024, 4)]


def test_faulty_rows_are_inserted_but_replace_nothing(lake, spark, tmp_path):
    good = _GOOD % (1, "SP")
    lake.refine(_file(tmp_path, good), T1)
    faulty = [good.replace('"n"', '" "'), good.replace('"n"', '" "').replace("SP", "RJ")]
    _, silver, gold = lake.refine(_file(tmp_path, *faulty), T2)
    rows = read_table(spark, lake.path("silver"), SILVER).collect()
    assert {(r.estado, r.nome, r.status_processamento) for r in rows} == {
        ("SP", "n", "SUCESSO"),
        ("RJ", "", "ERRO"),
    }
    row = silver.first()
    assert (row.status, row.error_records, row.nome_not_empty) == ("ERRO", 2, 2)
    # Rows with a fault still count in gold, as long as they have date, name and state.
    by_region = {r.regiao: r for r in gold.collect()}
    assert by_region["sudeste"].total_holidays == 2
    assert by_region["sul"].processing_status == "ERRO" and by_region["sul"].working_days == 0
    strict = to_gold(
        spark, lake.path("silver"), lake.path("gold-strict"), region_map(spark), 2024, T2, require_status=True
    )
    assert {r.regiao: r.total_holidays for r in strict.collect()}["sudeste"] == 1


def test_one_load_into_silver(lake, spark):
    lake.load(T1)
    lake.load(T2)
    other = f"{lake.base}/silver-t2"
    row = to_silver(spark, lake.path("bronze"), other, T2, dt_carga=iso_millis(T2)).first()
    assert row.total_records == 41 and read_table(spark, other, SILVER).count() == 41


def test_silver_without_bronze(lake, spark):
    row = to_silver(spark, lake.path("bronze"), lake.path("silver"), T1).first()
    assert row.status == "ERRO" and row.error_message


def test_gold_without_silver_rows(lake, spark):
    read_table(spark, lake.load(T1)[0].first().file_path, LANDING, fmt="json")
    empty = f"{lake.base}/empty"
    read_table(spark, lake.path("silver"), SILVER).filter("false").write.parquet(empty)
    with pytest.raises(ValueError):
        to_gold(spark, empty, lake.path("gold2"), region_map(spark), 2024, T1)


def test_year_without_holidays(lake):
    lake.load(T1)
    rows = lake.gold_run(T1, 1999).collect()
    assert {r.processing_status for r in rows} == {"ERRO"} and len(rows) == 5


def test_report(lake):
    rows = {(r.camada, r.item): r for r in run_report(*lake.load(T1)).collect()}
    assert len(rows) == 8
    assert rows["landing", "total"].national_holidays == 29
    assert rows["bronze", "total"].successful_records == 41
    assert rows["silver", "total"].error_records == 0
    assert rows["gold", "sul"].total_holidays == 11


def test_callers_session_stays_open(lake, spark):
    lake.load(T1)
    assert spark.range(1).count() == 1
