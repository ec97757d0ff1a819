"""Sources and sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from workcal.schemas import columns
from workcal.sinks import overwrite_partitions, write_csv, write_json, write_partitioned
from workcal.sources import (
    from_rows,
    json_columns_seen,
    missing_json_columns,
    read_csv,
    read_json_lines,
    read_table,
    table_exists,
)


def _text(tmp_path, *lines):
    file = tmp_path / "in.json"
    file.write_text("\n".join(lines) + "\n")
    return str(file)


def test_rows(spark):
    df = from_rows(spark, [("maré", 7), ("vento", -3)], columns("sinal string, grau bigint"))
    assert df.count() == 2 and df.dtypes == [("sinal", "string"), ("grau", "bigint")]
    empty = from_rows(spark, [], columns("a int, d date, t timestamp"))
    assert empty.isEmpty() and empty.columns == ["a", "d", "t"]
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    stamped = from_rows(spark, [(None, None, moment)], columns("a int, d date, t timestamp"))
    assert tuple(stamped.first()) == (None, None, moment)


def test_csv(spark, tmp_path):
    schema = columns("porto string, navios bigint")
    rows = [("Belém", 12), ("Ilhéus", 0), ("Santos", 310)]
    write_csv(from_rows(spark, rows, schema), f"{tmp_path}/ports")
    assert sorted(map(tuple, read_csv(spark, f"{tmp_path}/ports", schema).collect())) == rows
    as_text = read_csv(spark, f"{tmp_path}/ports")
    assert as_text.dtypes == [("porto", "string"), ("navios", "string")]


def test_broken_json_line(spark, tmp_path):
    path = _text(
        tmp_path, '{"data":"2024-01-01","nome":"a"}', "{bad", "", '{"data":"2024-01-02"}'
    )
    rows = read_json_lines(spark, path, columns("data string, nome string")).collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("2024-01-01", "a", None),
        ("2024-01-02", None, None),
        (None, None, "{bad"),
    ]


def test_clean_json_has_the_corrupt_column_too(spark, tmp_path):
    rows = read_json_lines(spark, _text(tmp_path, '{"data":"x"}'), columns("data string")).collect()
    assert [tuple(r) for r in rows] == [("x", None)]


def test_every_line_of_every_part_file_is_read(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("data")).repartition(2)
    write_json(df, f"{tmp_path}/out")
    assert read_json_lines(spark, f"{tmp_path}/out", columns("data string")).count() == 10


def test_json_document_over_several_lines(spark, tmp_path):
    path = _text(tmp_path, "{", '"data": "x"', "}")
    rows = read_json_lines(spark, path, columns("data string"), multi_line=True).collect()
    assert [r.data for r in rows] == ["x"]


def test_json_columns(spark, tmp_path):
    path = _text(tmp_path, '{"a":1}', "{bad", '{"b":null}', '{"a":2,"c":{"d":3}}')
    seen = {r.coluna: (r.registros, r.presente) for r in json_columns_seen(spark, path, ["a", "b", "d"]).collect()}
    assert seen == {"a": (2, True), "b": (1, True), "d": (0, False)}
    assert missing_json_columns(spark, path, ["a", "c"]) == []  # one line has both
    assert missing_json_columns(spark, path, ["a", "b"]) == []  # none has, but each occurs
    assert missing_json_columns(spark, path, ["a", "d", "e"]) == ["d", "e"]


def test_json_overwrite_replaces(spark, tmp_path):
    for n in (5, 3):
        write_json(spark.range(n), f"{tmp_path}/out")
    assert read_json_lines(spark, f"{tmp_path}/out", columns("id bigint")).count() == 3


def test_partitioned_append_and_dynamic_overwrite(spark, tmp_path):
    schema = columns("v bigint, ano int, mes int")
    path = f"{tmp_path}/t"
    assert not table_exists(spark, path)
    write_partitioned(from_rows(spark, [(1, 2024, 1), (2, 2024, 2)], schema), path, ["ano", "mes"])
    write_partitioned(from_rows(spark, [(3, 2024, 2)], schema), path, ["ano", "mes"])
    assert table_exists(spark, path)
    table = read_table(spark, path, schema)
    assert sorted(r.v for r in table.collect()) == [1, 2, 3]
    # Replaces one partition of the table it reads.
    changed = table.filter("mes = 2").withColumn("v", F.col("v") * 10)
    overwrite_partitions(changed, path, ["ano", "mes"])
    assert sorted(r.v for r in read_table(spark, path, schema).collect()) == [1, 20, 30]


def test_unknown_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, f"{tmp_path}/none", columns("a int"))
