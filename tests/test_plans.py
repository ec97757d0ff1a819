"""Physical plans: what is read, what is shuffled, what stays out of Python."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from workcal.operators.cleaning import first_per_key
from workcal.operators.regions import holidays_by_region, region_map
from workcal.operators.upsert import upsert
from workcal.operators.workdays import calendar_join, region_holiday_counts
from workcal.plans.gold import silver_year
from workcal.queries import QUERIES
from workcal.queries import inputs as i
from workcal.schemas import SILVER, columns
from workcal.sinks import write_partitioned
from workcal.sources import date_spine, from_rows, read_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name",
    [
        "calendar_left_join",
        "monthly_workdays_by_region",
        "monthly_workdays_by_state",
        "orders_on_workdays",
        "region_holiday_filter",
        "shipments_on_workdays",
        "silver_records",
        "upsert_partial_columns",
        "upsert_valid_only",
    ],
)
def test_no_python_and_no_pairing(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_only_needed_columns_are_read(spark, plan):
    text = plan(QUERIES["shipments_on_workdays"](spark, SF_DIR))
    lineitem = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    read = re.search(r"FileScan parquet \[(.*?)\]", lineitem).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == {
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
        "l_shipdate",
    }


def test_year_is_pruned_by_partition(spark, plan, tmp_path):
    silver = from_rows(spark, [], SILVER)
    for year in (2023, 2024):
        rows = silver.union(
            spark.range(3).select(
                *(
                    (F.lit(year) if f.name == "ano" else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in SILVER.fields
                )
            )
        )
        write_partitioned(rows, f"{tmp_path}/silver", ["ano", "mes"])
    newest = silver_year(spark, f"{tmp_path}/silver", 2024)
    assert re.search(r"PartitionFilters: \[[^\]]*ano#\d+ = 2024", plan(newest))


def test_key_ranges_and_null_keys_reach_the_scan(spark, plan, tmp_path):
    schema = columns("k int, v string")
    from_rows(spark, [(1, "a"), (None, "b")], schema).write.parquet(f"{tmp_path}/t")
    target = read_table(spark, f"{tmp_path}/t", schema)
    text = plan(upsert(target, target, ["k"], keep_first=["v"]))
    assert "PushedFilters: [IsNotNull(k)]" in text and "PushedFilters: [IsNull(k)]" in text


def test_small_load_is_broadcast_and_the_table_not_shuffled(spark, plan, tmp_path):
    schema = columns("k int, v string")
    spark.range(1000).selectExpr("int(id) k", "string(id) v").write.parquet(f"{tmp_path}/t")
    spark.range(10).selectExpr("int(id) k", "string(id) v").write.parquet(f"{tmp_path}/s")
    target, load = (read_table(spark, f"{tmp_path}/{n}", schema) for n in "ts")
    text = plan(upsert(target, load, ["k"], single_keys=True))
    assert re.search(r"BroadcastHashJoin \[k#\d+\], \[k#\d+\], LeftOuter, BuildRight", text)
    assert re.search(r"BroadcastHashJoin \[k#\d+\], \[k#\d+\], LeftSemi, BuildRight", text)
    # The one shuffle of target keys comes after they were cut to those of the load.
    updates, inserts = text.split("LeftAnti")
    assert "Exchange hashpartitioning" not in updates
    kept = inserts[: inserts.index("LeftSemi")]
    assert kept.rindex("HashAggregate") > kept.rindex("Exchange hashpartitioning")


@pytest.fixture
def small_skew_limits(spark):
    """Adaptive execution as on a large cluster, at the size of test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_target_key_can_be_split(spark, plan, tmp_path, small_skew_limits):
    """A third of the target under one key, beyond the broadcast limit: adaptive
    execution splits the wide rows of that key, and all of them are there."""
    schema = columns("k int, v string, pad string")
    spark.range(60000).selectExpr(
        "int(if(id < 20000, 7, id)) k", "string(id) v", "repeat(uuid(), 20) AS pad"
    ).write.parquet(f"{tmp_path}/t")
    spark.range(50000, 70000).union(spark.range(7, 8)).selectExpr(
        "int(id) k", "'new' v", "'' AS pad"
    ).write.parquet(f"{tmp_path}/s")
    target, load = (read_table(spark, f"{tmp_path}/{n}", schema) for n in "ts")
    merged = upsert(target, load, ["k"], single_keys=True).groupBy("v").count()
    rows = {r.v: r["count"] for r in merged.collect()}
    assert rows["new"] == 20000 + 10000 + 10000 and sum(rows.values()) == 70000
    final = plan(merged).split("Initial Plan")[0]
    assert re.search(r"SortMergeJoin\(skew=true\)[^\n]*LeftOuter", final)


def test_hot_day_of_the_calendar_join_can_be_split(spark, plan, tmp_path, small_skew_limits):
    """A third of all holidays on one day, joined row by row."""
    spark.range(60000).selectExpr(
        "date_add(date'2024-01-01', int(if(id < 20000, 7, id % 300))) data",
        "'SP' estado",
        "uuid() AS nome",
    ).write.parquet(f"{tmp_path}/h")
    holidays = read_table(spark, f"{tmp_path}/h", columns("data date, estado string, nome string"))
    spine = date_spine(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    joined = calendar_join(spine, holidays).groupBy("dia_semana").agg(
        F.count("nome").alias("n"), F.count("*").alias("rows")
    )
    rows = joined.collect()
    assert sum(r.n for r in rows) == 60000 and sum(r.rows for r in rows) == 60000 + 66
    final = plan(joined).split("Initial Plan")[0]
    assert re.search(r"SortMergeJoin\(skew=true\)[^\n]*Inner", final)


def test_large_load_is_not_broadcast(spark, plan, tmp_path):
    """Beyond Spark's size limit the same operator sorts and merges, with the same rows."""
    schema = columns("k int, v string")
    spark.range(1000).selectExpr("int(id) k", "string(id) v").write.parquet(f"{tmp_path}/t")
    target = read_table(spark, f"{tmp_path}/t", schema)
    small = sorted(upsert(target, target, ["k"]).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(target, target, ["k"])
        assert "SortMergeJoin" in plan(merged) and "BroadcastHashJoin" not in plan(merged)
        assert sorted(merged.collect()) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_one_row_per_key_is_cut_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    text = plan(first_per_key(df, ["k"], [F.desc("id")]))
    assert re.search(r"Exchange hashpartitioning(.|\n)*WindowGroupLimit .*Partial", text)


def test_repeated_source_keys_are_cut_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("int(id % 3) AS k", "string(id) AS v")
    text = plan(upsert(df, df, ["k"]))
    assert re.search(r"WindowGroupLimit .* 2, Partial", text)


def test_region_list_is_small_enough_by_spark_own_measure(spark, plan):
    holidays = spark.range(10).selectExpr(
        "date'2024-01-01' AS data", "concat('S', char(75 + id)) AS estado", "'n' AS nome"
    )
    assert "BroadcastHashJoin" in plan(holidays_by_region(holidays, region_map(spark)))


def test_holidays_are_counted_before_they_meet_the_regions(spark, plan):
    records = i.raw_records(spark, SF_DIR).selectExpr("CAST(data AS date) data", "estado", "nome")
    text = plan(region_holiday_counts(records, i.states(spark, SF_DIR)))
    assert re.search(r"partial_count\(1\)", text)
    # Nothing wider than the counts is shuffled.
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert all(re.match(r"(estado|regiao|r_name)#", k) for k in keys)


def test_facts_are_summed_before_the_calendar(spark, plan):
    text = plan(QUERIES["shipments_on_workdays"](spark, SF_DIR))
    scan = text.index("lineitem.parquet")
    above = text[:scan]
    # The only shuffle between the fact scan and the calendar carries partial sums.
    last = above.rindex("Exchange hashpartitioning")
    assert "partial_sum" in above[last:]
