"""Upsert: update the rows of a table that a load has, insert the ones it lacks.

``upsert`` is the relational operator; ``upsert_table`` applies it to a
partitioned table and rewrites only the partitions the load touches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stage
from ..sinks import overwrite_partitions, write_partitioned
from ..sources import from_rows, read_table, table_exists
from ..storage import remove_folder
from .cleaning import first_per_key

Condition = str | Column | None


def _condition(given: Condition) -> Column:
    """NULL counts as false, no condition as true."""
    if given is None:
        return F.lit(True)
    given = F.expr(given) if isinstance(given, str) else given
    return F.coalesce(given, F.lit(False))


def _complete(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))


def single_source_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, failing at run time if two rows share a key.

    Ranks above two cannot matter, so Spark keeps at most two rows per key and
    map task before the shuffle: a much repeated key fails cheaply.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*keys))
    message = F.concat_ws(" ", F.lit("several source rows for key"), *(F.col(k).cast("string") for k in keys))
    single = F.when(F.col("_rank") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    return source.withColumn("_rank", rank).filter("_rank <= 2").filter(single).drop("_rank")


def one_row_per_key(
    source: DataFrame, keys: Sequence[str], keep_first: Sequence[str | Column] | None = None
) -> DataFrame:
    """``source`` with single keys: repeated ones fail, or the first in the order
    ``keep_first`` is taken. Rows without a complete key all stay."""
    # A row without a complete key is told from all others by a number of its own, so
    # one window serves both kinds and the source is evaluated once.
    own = F.when(~_complete(keys), F.monotonically_increasing_id())
    numbered = source.withColumn("_own", own)
    if keep_first is None:
        single = single_source_rows(numbered, [*keys, "_own"])
    else:
        single = first_per_key(numbered, [*keys, "_own"], keep_first)
    return single.drop("_own")


def _null_policy(null_keys: str, identity: Sequence[str] | None, keys: Sequence[str]) -> list[str] | None:
    """The columns that tell rows without a complete key apart, or None if none are matched."""
    if null_keys not in ("insert", "match"):
        raise ValueError("null_keys is 'insert' or 'match'")
    return list(identity or keys) if null_keys == "match" else None


def _without_known(rows: DataFrame, known: DataFrame, identity: Sequence[str]) -> DataFrame:
    """``rows`` whose record ``known`` lacks; NULL equals NULL."""
    same = [F.col(f"source.{c}").eqNullSafe(F.col(f"known.{c}")) for c in identity]
    return rows.alias("source").join(known.select(*identity).alias("known"), same, "left_anti")


def _updated(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_if: Condition, update_cols: Sequence[str]
) -> DataFrame:
    """``target`` with ``update_cols`` taken from ``source`` where the keys agree and ``update_if`` holds."""
    same_key = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    # A key that was found is not NULL, so no mark is needed beside it.
    take = F.col(f"source.{keys[0]}").isNotNull() & _condition(update_if)
    return (
        target.alias("target")
        .join(source.alias("source"), same_key, "left")
        .select(
            *(
                F.when(take, F.col(f"source.{c}")).otherwise(F.col(f"target.{c}")).alias(c)
                if c in update_cols
                else F.col(f"target.{c}")
                for c in target.columns
            )
        )
    )


def _as_new(rows: DataFrame, schema: T.StructType, insert_if: Condition, insert_cols: Sequence[str]) -> DataFrame:
    """The rows that may be inserted, with the columns of the table."""
    new = [
        F.col(f"source.{f.name}").cast(f.dataType).alias(f.name)
        if f.name in insert_cols
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return rows.alias("source").filter(_condition(insert_if)).select(*new)


def match_table(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, update_if: Condition = None, by: Sequence[str] = ()
) -> DataFrame:
    """One staged row per target row whose key ``source`` has: the key, ``_takes`` (whether
    ``update_if`` holds), and for the columns ``by`` the old value ``_old_x`` and the one in
    the source, ``_new_x``.

    It reads only keys, ``by`` and what the condition names, within the source's key range.
    Updates, inserts and the partitions they touch all follow from it, so the table's other
    columns are read once, for the rows that are written. ``source`` must have single
    keys and should be staged: it is read again.
    """
    # A condition may name any column, in any spelling; Spark reads those it needs.
    wanted = target.select(*dict.fromkeys([*keys, *by])) if update_if is None else target
    found = wanted.filter(_key_range(source, keys)).alias("target")
    same_key = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    rows = found.join(source.alias("source"), same_key).select(
        *(F.col(f"source.{k}").alias(k) for k in keys),
        *(F.col(f"target.{c}").alias(f"_old_{c}") for c in by),
        *(F.col(f"source.{c}").alias(f"_new_{c}") for c in by),
        _condition(update_if).alias("_takes"),
    )
    return stage(rows, "matches")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update_if: Condition = None,
    update_cols: Sequence[str] | None = None,
    insert_if: Condition = None,
    insert_cols: Sequence[str] | None = None,
    keep_first: Sequence[str | Column] | None = None,
    single_keys: bool = False,
    null_keys: str = "insert",
    identity: Sequence[str] | None = None,
    large_load: bool = False,
) -> DataFrame:
    """``target`` after the load ``source``, with the columns of ``target``.

    A target row whose key the source has takes ``update_cols`` (default: all)
    from it where ``update_if`` holds; a source row whose key the target lacks is
    inserted with ``insert_cols`` (default: all, the rest NULL) where
    ``insert_if`` holds; all other target rows stay. Conditions may use the names
    ``source.x`` and, for updates, ``target.x``. NULL keys equal nothing: such
    target rows stay and such source rows are inserted. With ``null_keys="match"`` a source
    row without a complete key is left out if a target row without one has the same
    ``identity`` (default: the keys), NULL being equal to NULL: then a load can be repeated.

    Two source rows with one key are an error, unless ``keep_first`` gives the
    order in which the first of them is taken. ``single_keys`` says that there are
    none. The source is read for updates and for inserts: stage one that is costly.

    The work is a left join for the updates and, for the inserts, an anti join
    with the keys both sides have, rather than one full outer join: a small load can be
    broadcast to the target, which is then not shuffled, and a repeated target key
    can be split. Rows with a NULL key take part in no join on keys.

    ``large_load`` is the form for a load that is too large to be broadcast: the target is
    read and shuffled once with all its columns and once with its keys alone, the load once
    for updates and once for inserts, and nothing else.
    """
    columns = target.columns
    update_cols = columns if update_cols is None else update_cols
    insert_cols = columns if insert_cols is None else insert_cols
    known_by = _null_policy(null_keys, identity, keys)
    complete = _complete(keys)
    if not single_keys:
        source = one_row_per_key(source, keys, keep_first)
    keyed = source.filter(complete)
    without_key = source.filter(~complete)
    if known_by:
        without_key = _without_known(without_key, target.filter(~complete), known_by)

    if large_load:
        updated = _updated(target, source, keys, update_if, update_cols)
        present = target.select(*keys).filter(complete)
        # A NULL key is never present, so without an identity such rows go the same way.
        rows = [(source if known_by is None else keyed).join(present, list(keys), "left_anti")]
        rows += [] if known_by is None else [without_key]
        inserted = [_as_new(r, target.schema, insert_if, insert_cols) for r in rows]
        return reduce(DataFrame.unionByName, [updated, *inserted])

    keyed_target = target.filter(complete)
    updated = _updated(keyed_target, keyed, keys, update_if, update_cols)
    same_key = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    # The load's keys that the target has: as few as the load, however large the
    # target, and each once, however often the target repeats it.
    present = (
        keyed_target.select(*keys)
        .alias("target")
        .join(keyed.select(*keys).alias("source"), same_key, "left_semi")
        .distinct()
    )
    unmatched = keyed.alias("source").join(present.alias("target"), same_key, "left_anti")
    inserted = [_as_new(rows, target.schema, insert_if, insert_cols) for rows in (unmatched, without_key)]
    return reduce(DataFrame.unionByName, [updated, target.filter(~complete), *inserted])


def _in_partitions(parts: Sequence[Row], by: Sequence[str]) -> Column:
    """Predicate on partition columns, short enough to prune with: the values of
    the last column are listed per value of the ones before it."""
    groups: dict[tuple, set] = defaultdict(set)
    for part in parts:
        groups[tuple(part)[:-1]].add(part[-1])

    def among(column: str, values: set) -> Column:
        known = [v for v in values if v is not None]
        found = F.col(column).isin(known) if known else F.lit(False)
        return found | F.col(column).isNull() if None in values else found

    clauses = [
        reduce(Column.__and__, [*(among(c, {v}) for c, v in zip(by, lead)), among(by[-1], last)])
        for lead, last in groups.items()
    ]
    return reduce(Column.__or__, clauses, F.lit(False))


def _key_range(staged: DataFrame, keys: Sequence[str]) -> Column:
    """Bounds of the load's keys, which Parquet statistics can prune by."""
    # A timestamp passes the driver as microseconds: as a local time, one in a repeated
    # hour would come back as another moment.
    stamps = {k for k in keys if isinstance(staged.schema[k].dataType, T.TimestampType)}
    value = {k: F.unix_micros(k) if k in stamps else F.col(k) for k in keys}
    literal = {k: (lambda v: F.timestamp_micros(F.lit(v).cast("long"))) if k in stamps else F.lit for k in keys}
    bounds = staged.agg(
        *(f(value[k]).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max)))
    ).first()
    return reduce(
        Column.__and__,
        (
            F.col(k).between(literal[k](bounds[f"lo{i}"]), literal[k](bounds[f"hi{i}"]))
            for i, k in enumerate(keys)
        ),
    )


def clear_partitions(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], parts: Sequence[Row]
) -> None:
    """Remove the folders of the given partitions."""
    held = spark.read.schema(schema).parquet(path).filter(_in_partitions(parts, by))
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    for row in held.select(folder.alias("folder")).distinct().collect():
        remove_folder(spark, unquote(row.folder))


def upsert_table(
    source: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    partition_by: Sequence[str],
    *,
    partitions_follow_keys: bool,
    update_if: Condition = None,
    update_cols: Sequence[str] | None = None,
    insert_if: Condition = None,
    insert_cols: Sequence[str] | None = None,
    keep_first: Sequence[str | Column] | None = None,
    single_keys: bool = False,
    null_keys: str = "insert",
    identity: Sequence[str] | None = None,
) -> list[Row]:
    """``upsert`` into the partitioned Parquet table at ``path``; returns the partitions it
    wrote to or emptied.

    A missing table is created from the rows that qualify for insertion. For an
    existing one the load, with its keys made single, is written to the scratch
    folder once (``single_keys`` says it is such a table already), and its ``match_table``
    is made. Only partitions with a row that takes an update, or to which such a row
    moves, are read and replaced; new rows are appended. So a load of new keys, or one whose
    matches all fail ``update_if``, rewrites nothing. ``partitions_follow_keys`` says that equal
    keys always lie in one partition, so that only the load's partitions are searched;
    otherwise rows may move, and a partition left without rows is cleared.

    Updates come before inserts: a load that broke off between them is made whole by
    repeating it. Only lists of partitions, one row each, pass through the driver, so
    partition by columns of few values. One writer at a time: nothing guards against a
    second one.
    """
    spark = source.sparkSession
    by = list(partition_by)
    known_by = _null_policy(null_keys, identity, keys)
    update_cols = schema.names if update_cols is None else update_cols
    insert_cols = schema.names if insert_cols is None else insert_cols
    if not single_keys:
        source = one_row_per_key(source, keys, keep_first)
    if not table_exists(spark, path):
        return write_partitioned(_as_new(source, schema, insert_if, insert_cols), path, by)

    load = source if single_keys else stage(source, "load")
    target = read_table(spark, path, schema)
    incoming = _in_order(set(load.select(*by).distinct().collect()))
    if not incoming:
        return []
    searched = target.filter(_in_partitions(incoming, by)) if partitions_follow_keys else target
    matches = match_table(searched, load, keys, update_if=update_if, by=by)
    old, new = [f"_old_{c}" for c in by], [f"_new_{c}" for c in by]
    moves = matches.filter("_takes").groupBy(*old, *new).agg(F.count("*").alias("_moved")).collect()
    may_move = not partitions_follow_keys and bool(set(by) & set(update_cols))
    width = len(by)
    rewritten = {_part(m[:width], by) for m in moves}
    if may_move:
        rewritten |= {_part(m[width : 2 * width], by) for m in moves}
    if rewritten:
        emptied = _left_partitions(target, moves, by) if may_move else set()
        held = target.filter(_in_partitions(_in_order(rewritten), by))
        changes = load.join(matches.filter("_takes").select(*keys), list(keys), "left_semi")
        overwrite_partitions(_updated(held, changes, keys, update_if, update_cols), path, by)
        if emptied:
            clear_partitions(spark, path, schema, by, _in_order(emptied))

    fresh = load.join(matches.select(*keys), list(keys), "left_anti")
    if known_by:
        # Read anew: files of the partitions just replaced are gone.
        now = read_table(spark, path, schema).filter(~_complete(keys))
        now = now.filter(_in_partitions(incoming, by)) if partitions_follow_keys else now
        nameless = _without_known(fresh.filter(~_complete(keys)), now, known_by)
        fresh = fresh.filter(_complete(keys)).unionByName(nameless)
    appended = write_partitioned(_as_new(fresh, schema, insert_if, insert_cols), path, by)
    return _in_order(rewritten | set(appended))


def _part(values: Sequence, by: Sequence[str]) -> Row:
    return Row(**dict(zip(by, values)))


def _in_order(parts: set[Row]) -> list[Row]:
    return sorted(parts, key=lambda p: [(v is not None, v) for v in p])


def _left_partitions(target: DataFrame, moves: Sequence[Row], by: Sequence[str]) -> set[Row]:
    """Partitions that all their rows leave, and none moves to."""
    leaving: dict[tuple, int] = defaultdict(int)
    reached = set()
    for m in moves:
        old, new = tuple(m)[: len(by)], tuple(m)[len(by) : 2 * len(by)]
        reached.add(new)
        if old != new:
            leaving[old] += m["_moved"]
    left = {p: n for p, n in leaving.items() if p not in reached}
    if not left:
        return set()
    parts = [_part(p, by) for p in left]
    held = target.filter(_in_partitions(parts, by)).groupBy(*by).count().collect()
    return {_part(h[:-1], by) for h in held if left[tuple(h)[:-1]] == h[-1]}
