"""Upsert against the rules of the operator, restated row by row."""

import random

import pytest
from pyspark.sql import functions as F
from workcal.operators.upsert import clear_partitions, match_table, upsert, upsert_table
from workcal.schemas import columns
from workcal.sources import from_rows, read_table
from workcal.sinks import write_partitioned

KV = columns("k int, v string")
KVS = columns("k int, v string, st string")
TARGET = [(1, "a"), (2, "b"), (4, "d"), (None, "n")]
SOURCE = [
    (2, None, "OK"),
    (3, "C", "BAD"),
    (4, "D", "BAD"),
    (5, "E", "OK"),
    (None, "N", "OK"),
    (6, "F", None),
]
OK = "source.st = 'OK'"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _sorted(rows):
    return sorted(rows, key=str)


@pytest.fixture
def tables(spark):
    return from_rows(spark, TARGET, KV), from_rows(spark, SOURCE, KVS)


GATED = [(1, "a"), (2, None), (4, "d"), (5, "E"), (None, "n"), (None, "N")]


def test_gated_update_and_insert(tables):
    assert _rows(upsert(*tables, ["k"], update_if=OK, insert_if=OK)) == _sorted(GATED)


def test_unconditional_insert(tables):
    got = _rows(upsert(*tables, ["k"], update_if=OK))
    assert got == _sorted([*GATED, (3, "C"), (6, "F")])


def test_update_and_insert_all(tables):
    got = _rows(upsert(*tables, ["k"]))
    want = [(1, "a"), (2, None), (3, "C"), (4, "D"), (5, "E"), (6, "F"), (None, "n"), (None, "N")]
    assert got == _sorted(want)


def test_column_lists(spark):
    schema = columns("k int, a string, b string")
    target = from_rows(spark, [(1, "a1", "b1")], schema)
    source = from_rows(spark, [(1, "A1", "B1"), (2, "A2", "B2")], schema)
    got = _rows(upsert(target, source, ["k"], update_cols=["b"], insert_cols=["k", "a"]))
    assert got == [(1, "a1", "B1"), (2, "A2", None)]


def test_condition_on_both_sides(spark):
    schema = columns("k int, n int")
    target = from_rows(spark, [(1, 5), (2, 5), (3, None)], schema)
    source = from_rows(spark, [(1, 9), (2, 1), (3, 7)], schema)
    got = _rows(upsert(target, source, ["k"], update_if="source.n > target.n"))
    assert got == [(1, 9), (2, 5), (3, None)]


def test_repeated_source_key_fails(spark):
    target, source = from_rows(spark, TARGET, KV), from_rows(spark, [(2, "x"), (2, "y")], KV)
    with pytest.raises(Exception, match="several source rows for key 2"):
        upsert(target, source, ["k"]).collect()
    # Repeated NULL keys are no repetition: they equal nothing.
    nulls = from_rows(spark, [(None, "x"), (None, "x")], KV)
    assert upsert(target, nulls, ["k"]).count() == len(TARGET) + 2


def test_keep_first(spark):
    target, source = from_rows(spark, TARGET, KV), from_rows(spark, [(2, "y"), (2, "x"), (7, "z"), (7, "w")], KV)
    got = _rows(upsert(target, source, ["k"], keep_first=["v"]))
    assert got == _sorted([(1, "a"), (2, "x"), (4, "d"), (7, "w"), (None, "n")])


def _restated(target, source, update_ok, insert_ok):
    """The operator row by row, for two-column keys."""
    by_key = {s[:2]: s for s in source if None not in s[:2]}
    present = {t[:2] for t in target if None not in t[:2]}
    out = []
    for t in target:
        s = by_key.get(t[:2])
        out.append((*t[:2], s[2]) if s and update_ok(s) else t)
    for s in source:
        if (None in s[:2] or s[:2] not in present) and insert_ok(s):
            out.append((*s[:2], s[2]))
    return _sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_random_tables_with_a_hot_target_key(spark, seed):
    """Repeated keys in the target (one in a third of its rows), NULLs everywhere."""
    pick = random.Random(seed)

    def key(n):
        return pick.choice([None, *range(n)]), pick.choice([None, "a", "b"])

    target = [((1, "a") if k < 200 else key(40)) + (f"t{k}",) for k in range(600)]
    distinct = {key(60) for _ in range(150)}
    source = [(*k, f"s{n}", pick.choice(["OK", "BAD", None])) for n, k in enumerate(sorted(distinct, key=str))]
    t = from_rows(spark, target, columns("a int, b string, v string"))
    s = from_rows(spark, source, columns("a int, b string, v string, st string"))
    ok = lambda r: r[3] == "OK"
    assert _rows(upsert(t, s, ["a", "b"], update_if=OK, insert_if=OK)) == _restated(target, source, ok, ok)
    once = upsert(t, s, ["a", "b"], update_if=OK)
    assert _rows(once) == _restated(target, source, ok, lambda r: True)


def test_applying_a_load_twice_changes_nothing_more(spark):
    target = from_rows(spark, [(k, f"t{k}") for k in range(50)], KV)
    source = from_rows(spark, [(k, f"s{k}") for k in range(30, 80)], KV)
    once = upsert(target, source, ["k"])
    assert _rows(upsert(once, source, ["k"])) == _rows(once)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("null_keys", ["insert", "match"])
def test_large_load_gives_the_same_rows(spark, seed, null_keys):
    """Both forms of the operator, on repeated target keys and NULLs everywhere."""
    pick = random.Random(seed)
    target = [(pick.choice([None, 7, 7, *range(30)]), pick.choice([None, "a", "b"]), f"t{n % 9}") for n in range(300)]
    source = {(pick.choice([None, *range(45)]), pick.choice([None, "a", "b"])): f"{pick.choice('st')}{n % 9}" for n in range(90)}
    schema = columns("a int, b string, v string")
    t, s = from_rows(spark, target, schema), from_rows(spark, [(*k, v) for k, v in source.items()], schema)
    for condition in (None, "source.v > target.v"):
        options = dict(update_if=condition, insert_if="source.v <> 's3'", null_keys=null_keys, identity=["a", "b", "v"])
        got = upsert(t, s, ["a", "b"], single_keys=True, large_load=True, **options)
        assert _rows(got) == _rows(upsert(t, s, ["a", "b"], **options))


def test_large_load_reads_the_other_columns_of_the_target_once(spark, plan, tmp_path):
    schema = columns("k int, v string, pad string")
    spark.range(1000).selectExpr("int(id) k", "string(id) v", "uuid() pad").write.parquet(f"{tmp_path}/t")
    spark.range(900, 1900).selectExpr("int(id) k", "string(id) v", "uuid() pad").write.parquet(f"{tmp_path}/s")
    target, load = (read_table(spark, f"{tmp_path}/{n}", schema) for n in "ts")
    result = upsert(target, load, ["k"], single_keys=True, large_load=True)
    scans = [line for line in plan(result).splitlines() if f"{tmp_path}/t]" in line]
    assert sorted("pad#" in line for line in scans) == [False, True]
    assert result.count() == 1900


def test_match_table(spark, tmp_path):
    """Only keys, partitions and what the condition names are read."""
    schema = columns("k int, v string, ano int")
    target = from_rows(spark, [(1, "a", 2023), (1, "z", 2024), (2, "b", 2024), (None, "c", 2024), (3, "d", 2024)], schema)
    load = from_rows(spark, [(1, "m", 2025), (2, "a", 2024), (None, "x", 2024), (9, "n", 2025)], schema)
    found = match_table(target, load, ["k"], update_if="source.v > target.v", by=["ano"])
    assert found.columns == ["k", "_old_ano", "_new_ano", "_takes"]
    assert _rows(found) == [(1, 2023, 2025, True), (1, 2024, 2025, False), (2, 2024, 2024, False)]


def test_incomplete_keys_are_known_again(spark):
    schema = columns("k int, v string")
    once = [(None, "a"), (None, "a"), (None, None), (1, "b")]
    target = upsert(from_rows(spark, [], schema), from_rows(spark, once, schema), ["k"], null_keys="match", identity=["k", "v"])
    assert _rows(target) == _sorted(once)
    again = from_rows(spark, [*once, (None, "new")], schema)
    got = upsert(target, again, ["k"], null_keys="match", identity=["k", "v"])
    assert _rows(got) == _sorted([*once, (None, "new")])
    with pytest.raises(ValueError):
        upsert(target, again, ["k"], null_keys="equal")


# --- stored tables -----------------------------------------------------------

PART = columns("k int, v string, ano int, mes int")
BY = ["ano", "mes"]


def _stored(spark, path):
    return _rows(read_table(spark, path, PART))


def _put(spark, path, rows, **options):
    options.setdefault("partitions_follow_keys", False)
    upsert_table(from_rows(spark, rows, PART), path, PART, ["k"], BY, **options)


def _files(tmp_path):
    return {str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*.parquet")}


def test_create_and_merge(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1), (2, "b", 2024, 2), (3, "c", None, None)])
    _put(spark, path, [(2, "B", 2024, 2), (4, "d", 2025, 1), (3, "C", None, None)])
    want = [(1, "a", 2024, 1), (2, "B", 2024, 2), (3, "C", None, None), (4, "d", 2025, 1)]
    assert _stored(spark, path) == _sorted(want)


def test_creation_is_gated_like_later_loads(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1), (2, "bad", 2024, 1)], insert_if="source.v <> 'bad'")
    assert _stored(spark, path) == [(1, "a", 2024, 1)]


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = tmp_path / "t"
    _put(spark, str(path), [(1, "a", 2024, 1), (2, "b", 2024, 2)])
    before = {f for f in _files(path) if "mes=1" in f}
    _put(spark, str(path), [(2, "B", 2024, 2)])
    assert {f for f in _files(path) if "mes=1" in f} == before


@pytest.mark.parametrize("follow", [True, False])
def test_a_load_of_new_keys_rewrites_nothing(spark, tmp_path, follow):
    path = tmp_path / "t"
    _put(spark, str(path), [(1, "a", 2024, 1), (2, "b", None, 2)])
    before = _files(path)
    _put(spark, str(path), [(3, "c", 2024, 1), (4, "d", None, 2)], partitions_follow_keys=follow)
    assert _files(path) > before
    assert _stored(spark, str(path)) == _sorted(
        [(1, "a", 2024, 1), (2, "b", None, 2), (3, "c", 2024, 1), (4, "d", None, 2)]
    )


@pytest.mark.parametrize("name", ["target.v", "TARGET.V", "`target`.v"])
def test_condition_may_name_the_target_in_any_spelling(spark, tmp_path, name):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "b", 2024, 1), (2, "b", 2024, 1)])
    _put(spark, path, [(1, "a", 2024, 2), (2, "c", 2024, 2)], update_if=f"{name} < source.v")
    assert _stored(spark, path) == [(1, "b", 2024, 1), (2, "c", 2024, 2)]


def test_partition_left_by_its_row_and_not_filled_by_the_load(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1), (2, "b", 2024, 3)])
    # Row 1 leaves month 1; row 2 would go there, but is not updated.
    _put(spark, path, [(1, "A", 2024, 2), (2, "x", 2024, 1)], update_if="source.v = 'A'")
    assert _stored(spark, path) == [(1, "A", 2024, 2), (2, "b", 2024, 3)]


def test_timestamp_key_in_a_repeated_hour(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        schema = columns("t timestamp, v string, ano int")
        path = f"{tmp_path}/t"
        for value in "ab":
            load = spark.range(1).select(
                F.timestamp_seconds(F.lit(1730615400)).alias("t"),  # 2024-11-03 06:30 UTC
                F.lit(value).alias("v"),
                F.lit(2024).alias("ano"),
            )
            upsert_table(load, path, schema, ["t"], ["ano"], partitions_follow_keys=True)
        assert [r.v for r in read_table(spark, path, schema).collect()] == ["b"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_moved_row_leaves_its_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1), (2, "b", 2024, 1), (3, "c", 2024, 2)])
    _put(spark, path, [(1, "A", 2024, 3), (3, "C", 2024, 3)])
    want = [(1, "A", 2024, 3), (2, "b", 2024, 1), (3, "C", 2024, 3)]
    assert _stored(spark, path) == want  # month 2 lost its only row


def test_partition_left_empty_and_refilled_elsewhere(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1), (2, "b", None, None)])
    _put(spark, path, [(1, "A", 2025, 1), (2, "B", 2024, 2)])
    assert _stored(spark, path) == [(1, "A", 2025, 1), (2, "B", 2024, 2)]


def test_match_in_another_partition_is_not_inserted(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1)])
    _put(spark, path, [(1, "A", 2024, 2), (5, "E", 2024, 2)], update_if="source.v <> 'A'")
    assert _stored(spark, path) == [(1, "a", 2024, 1), (5, "E", 2024, 2)]


def test_moves_with_repeated_keys_in_the_load(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1), (2, "b", 2024, 2)])
    _put(spark, path, [(1, "x", 2024, 2), (1, "y", 2024, 3)], keep_first=["v"])
    assert _stored(spark, path) == [(1, "x", 2024, 2), (2, "b", 2024, 2)]


def test_update_without_the_partition_columns_does_not_move(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1)])
    _put(spark, path, [(1, "A", 2024, 2)], update_cols=["v"])
    assert _stored(spark, path) == [(1, "A", 2024, 1)]


def test_empty_load_and_failed_load_change_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    _put(spark, path, [(1, "a", 2024, 1)])
    _put(spark, path, [])
    with pytest.raises(Exception, match="several source rows"):
        _put(spark, path, [(1, "x", 2024, 1), (1, "y", 2024, 1)])
    assert _stored(spark, path) == [(1, "a", 2024, 1)]


def test_clear_partitions_with_odd_values(spark, tmp_path):
    schema = columns("v int, g string, n int")
    path = f"{tmp_path}/t"
    rows = [(1, "it's", 1), (2, "a b/c", 2), (3, None, None), (4, "back\\slash", 4)]
    write_partitioned(from_rows(spark, rows, schema), path, ["g", "n"])
    parts = read_table(spark, path, schema).filter("v <> 2").select("g", "n").collect()
    clear_partitions(spark, path, schema, ["g", "n"], parts)
    assert _rows(read_table(spark, path, schema)) == [(2, "a b/c", 2)]


@pytest.mark.parametrize("seed", range(2))
def test_random_moves(spark, tmp_path, seed):
    path, pick = f"{tmp_path}/t", random.Random(seed)

    def place():
        return pick.choice([2023, 2024, None]), pick.choice([1, 2])

    first = [(k, f"t{k}", *place()) for k in range(25)]
    second = [(k, f"s{k}", *place()) for k in range(15, 40)]
    _put(spark, path, first)
    _put(spark, path, second, update_if="source.mes = 1")
    merged = {r[0]: r for r in first}
    for r in second:
        if r[0] not in merged or r[3] == 1:
            merged[r[0]] = r
    assert _stored(spark, path) == _sorted(merged.values())


def test_load_without_an_update_rewrites_nothing(spark, tmp_path):
    """Every row of the load matches and fails ``update_if``."""
    path = tmp_path / "t"
    _put(spark, str(path), [(1, "a", 2024, 1), (2, "b", 2024, 2)])
    before = _files(path)
    load = from_rows(spark, [(1, "x", 2024, 2), (2, "y", 2024, 2)], PART)
    touched = upsert_table(load, str(path), PART, ["k"], BY, partitions_follow_keys=False, update_if="source.v > 'z'")
    assert touched == [] and _files(path) == before


def test_partitions_changed_are_returned(spark, tmp_path):
    path = f"{tmp_path}/t"

    def put(rows, **options):
        load = from_rows(spark, rows, PART)
        return [tuple(p) for p in upsert_table(load, path, PART, ["k"], BY, partitions_follow_keys=False, **options)]

    assert put([(1, "a", 2024, 1), (2, "b", None, 2)]) == [(None, 2), (2024, 1)]
    assert put([(3, "c", 2025, 7)]) == [(2025, 7)]
    # Row 1 moves and leaves its partition empty; row 9 is new.
    assert put([(1, "A", 2025, 7), (9, "n", 2023, 1)]) == [(2023, 1), (2024, 1), (2025, 7)]
    assert put([]) == []


@pytest.mark.parametrize("follow", [True, False])
def test_stored_load_with_incomplete_keys_can_be_repeated(spark, tmp_path, follow):
    path, schema = f"{tmp_path}/t", columns("k int, v string, ano int")
    rows = [(None, "a", 2024), (None, "a", 2024), (None, None, None), (None, "b", None), (5, "c", 2024)]

    def put(more=()):
        load = from_rows(spark, [*rows, *more], schema)
        upsert_table(load, path, schema, ["k"], ["ano"], partitions_follow_keys=follow, null_keys="match", identity=["k", "v"])
        return _rows(read_table(spark, path, schema))

    assert put() == put() == put() == _sorted(rows)
    assert put([(None, "d", 2024)]) == _sorted([*rows, (None, "d", 2024)])
