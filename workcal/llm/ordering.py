"""Places of rows in a global order, found by a range sort instead of one window.

A window over a group would bring the whole group into one task. Here the rows are
sorted in ranges, a task counts within its range, and only the first group of a range
may go on from the ranges before it: two rows per range settle its offset.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stage
from ..sources import from_rows
from .texts import batch_of, map_batches

_ADDED = [
    T.StructField("_range", T.IntegerType()),
    T.StructField("_place", T.LongType()),
    T.StructField("_edge", T.BooleanType()),
]


def _changes(batch: pa.RecordBatch, groups: Sequence[str], last: tuple | None) -> np.ndarray:
    """Which rows are of another group than the row before (null is a group)."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    for k, name in enumerate(groups):
        column = batch.column(name)
        now, before = column[1:], column[:-1]
        same = pc.or_(pc.fill_null(pc.equal(now, before), False), pc.and_(now.is_null(), before.is_null()))
        changed[1:] |= ~same.to_numpy(zero_copy_only=False)
        changed[0] |= last is None or column[0].as_py() != last[k]
    return changed


def _counted(groups: Sequence[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        last, carry, waiting = None, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = np.arange(n, dtype=np.int64)
            begun = np.maximum.accumulate(np.where(_changes(batch, groups, last), at, -1))
            place = np.where(begun >= 0, at - begun, carry + at)
            edge = np.zeros(n, dtype=bool)
            if waiting is None:
                edge[0] = True
            else:
                yield batch_of(**waiting)
            last, carry = tuple(batch.column(g)[n - 1].as_py() for g in groups), int(place[-1]) + 1
            waiting = dict(zip(batch.schema.names, batch.columns))
            waiting |= {"_range": np.full(n, number, dtype=np.int32), "_place": place, "_edge": edge}
        if waiting is not None:
            waiting["_edge"][-1] = True
            yield batch_of(**waiting)

    return task


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``_rank``: the place, from 0, of a row among those of its group.

    The order is ascending with nulls first; rows that tie are numbered in any order, so
    give an order that tells apart what must be. The sorted rows are staged (``name``),
    so a rank never changes when a task is run again.
    """
    spark = df.sparkSession
    keys = [F.asc_nulls_first(c) for c in (*groups, *order)]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    schema = T.StructType([*df.schema.fields, *_ADDED])
    rows = stage(map_batches(placed, df.columns, _counted(list(groups)), schema), name)

    # Two rows per range reach the driver: they say with which group it begins and ends.
    ends: dict[int, list] = {}
    for row in rows.filter("_edge").select("_range", "_place", *groups).collect():
        ends.setdefault(row[0], []).append(row)
    before, open_group, offsets = 0, None, []
    for number in sorted(ends):
        in_order = sorted(ends[number], key=lambda r: ([(v is not None, v) for v in r[2:]], r[1]))
        first, final = in_order[0], in_order[-1]
        offset = before if first[2:] == open_group else 0
        if offset:
            offsets.append((number, offset, *first[2:]))
        before, open_group = final[1] + 1 + (offset if final[2:] == first[2:] else 0), final[2:]
    fields = [T.StructField("_at", T.IntegerType()), T.StructField("_offset", T.LongType())]
    fields += [T.StructField(f"_g{k}", df.schema[g].dataType) for k, g in enumerate(groups)]
    known = from_rows(spark, offsets, T.StructType(fields))
    match = F.col("_range") == F.col("_at")
    for k, g in enumerate(groups):
        match &= F.col(g).eqNullSafe(F.col(f"_g{k}"))
    rank = F.col("_place") + F.coalesce("_offset", F.lit(0))
    return rows.join(known, match, "left").select(*df.columns, rank.alias("_rank"))
