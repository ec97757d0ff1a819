"""Benchmark decontamination by templates.

Words become a template: numbers, names and units turn into typed placeholders, all
other words lose case and outer punctuation. Every window of eight template words is
hashed, at every place of items and documents alike, and is an anchor, so a question whose
values were changed has the anchors of the original. Documents meet benchmark items by a
hash join on anchors; what stood in the slots comes along. An anchor counts if it is
consistent with its alignment: each of its slots holds the item's own value, or the value
that stands for it most often there. An item is in a document if enough of its anchors count.

A window with fewer than four plain words is too general for placeholders: many other
texts have its template. It is hashed with its own values and counts where it stands
verbatim. An item's share is that of all its anchors, or of those with placeholders alone
where that is more, as changed values change every general window.

Most windows of documents are no item's. A filter of 2^``FILTER_BITS`` bits, whose size does
not depend on the benchmark, is broadcast, and only windows whose bit is set are handed on;
the join is exact, so the filter loses nothing and what it lets through wrongly is dropped
there. Windows without slots say the same wherever they stand: each is listed once for a text.

The benchmark side of the join is broadcast only after its anchors are counted and found to be
at most ``BROADCAST_ANCHORS``; beyond that the same join is a sort-merge join, whose hot
anchors adaptive execution splits. Only matches are shuffled and grouped, by document,
item and alignment: a group has at most as many rows as the item has anchors.

Items shorter than a window are one window of their own length, and documents are searched for
windows of these lengths at every place: a short item is found wherever it stands, however short.

Whole texts are read. Null and empty texts have no anchors, and an empty table of documents
or items finds nothing. Rows that share a doc_id count as one document, items that share an
item_id as one item; of equal texts under different ids each is found. Of other columns,
whatever their names, none is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import stage
from .texts import WordHashes, batch_of, map_batches, table, texts_of, windows

WINDOW = 8
LEAST_PLAIN = 4
#: Share of an item's anchors that must match.
SHARE = 0.4
#: A benchmark with more anchors than this (some 40 bytes each) is not broadcast.
BROADCAST_ANCHORS = 500_000
#: Bits of the filter for the windows of documents: 8 MB, whatever the benchmark.
FILTER_BITS = 26

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Words for units, counted as such behind a number.
UNITS = {
    w.encode()
    for w in (
        "mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hours hour minutes minute seconds second days day "
        "weeks week months month years year percent usd eur gbp dollars dollar euros euro cents cent miles mile meters "
        "meter metres metre kilometers kilometres kilograms grams pounds ounces liters litres degrees c f w kw kwh v a hz"
    ).split()
}
_NUMBER, _CAPITAL, _ENDS, _UNIT, _EMPTY = (np.uint64(1 << k) for k in range(5))
_FLAGS = np.uint64(31)
_HOLDERS = {k: np.uint64(xxhash.xxh3_64_intdigest(k)) for k in ("<number>", "<name>", "<unit>")}


class _Words(WordHashes):
    """The hash of the bare word in lower case, with flags in its low bits."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        bare = word.strip(_PUNCTUATION).decode("utf-8", "surrogatepass")
        low = bare.casefold().encode("utf-8", "surrogatepass")
        flags = 0
        if not bare:
            flags = int(_EMPTY)
        elif bare[:1].isdigit():
            flags = int(_NUMBER)
        elif bare[:1].isupper() and not bare[1:].isupper():
            flags = int(_CAPITAL)
        if bare and low in UNITS:
            flags |= int(_UNIT)
        if word.rstrip(b"\"')]*").endswith((b".", b"!", b"?", b":")):
            flags |= int(_ENDS)
        self[word] = value = (xxhash.xxh3_64_intdigest(low) & ~int(_FLAGS)) | flags
        return value


def template(text: str, words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template hashes, hashes of the words themselves, and which are slots."""
    packed = words.of(text.encode("utf-8", "surrogatepass").split())
    flags = packed & _FLAGS
    ends = np.concatenate(([True], (flags[:-1] & _ENDS) != 0)) if len(packed) else np.zeros(0, bool)
    keep = (flags & _EMPTY) == 0
    packed, flags, starts = packed[keep], flags[keep], ends[keep]
    value = packed & ~_FLAGS
    number = (flags & _NUMBER) != 0
    after_number = np.concatenate(([False], number[:-1])) if len(number) else number
    unit = ((flags & _UNIT) != 0) & after_number & ~number
    name = ((flags & _CAPITAL) != 0) & ~starts & ~unit
    code = value.copy()
    code[number], code[name], code[unit] = (_HOLDERS[k] for k in ("<number>", "<name>", "<unit>"))
    return code, value, number | name | unit


Template = tuple[np.ndarray, np.ndarray, np.ndarray]
Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _windows(made: Template, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all windows, and which of them are general."""
    code, value, slot = made
    hashes = windows(code, size)
    general = np.convolve(~slot, np.ones(size, dtype=np.int64), "valid") < min(LEAST_PLAIN, size)
    return np.where(general, windows(value, size), hashes) if general.any() else hashes, general


def _chosen(made: Template, size: int, hashes: np.ndarray, general: np.ndarray, at: np.ndarray) -> Found:
    """Size, places and hashes of windows, their slot values in order, how many each has, and
    which are general. Of equal windows without slots the first one."""
    _, value, slot = made
    held = slot[at[:, None] + np.arange(size)] & ~general[at, None]
    bare = np.flatnonzero(~held.any(axis=1))
    again = np.ones(len(bare), dtype=bool)
    again[np.unique(hashes[at[bare]], return_index=True)[1]] = False
    kept = np.ones(len(at), dtype=bool)
    kept[bare[again]] = False
    at, held = at[kept], held[kept]
    slots = value[at[:, None] + np.arange(size)][held].view(np.int64)
    return np.full(len(at), size), at, hashes[at].view(np.int64), slots, held.sum(axis=1), general[at]


def anchors(made: Template) -> list[Found]:
    """All windows; a text shorter than a window is one."""
    size = min(WINDOW, len(made[0]))
    if not size:
        return []
    hashes, general = _windows(made, size)
    return [_chosen(made, size, hashes, general, np.arange(len(hashes)))]


class _Wanted(NamedTuple):
    """The sizes of the items' windows, and the filter of their hashes."""

    sizes: list[int]
    bits: np.ndarray

    def places(self, hashes: np.ndarray) -> np.ndarray:
        held = self.bits[(hashes >> np.uint64(70 - FILTER_BITS)).astype(np.int64)]
        return np.flatnonzero((held >> (hashes >> np.uint64(64 - FILTER_BITS) & np.uint64(63))) & np.uint64(1))


def doc_anchors(made: Template, wanted: _Wanted) -> list[Found]:
    """All windows of the sizes that items have and whose hashes the filter lets through."""
    found = []
    for size in wanted.sizes:
        if len(made[0]) >= size:
            hashes, general = _windows(made, size)
            found.append(_chosen(made, size, hashes, general, wanted.places(hashes)))
    return found


def anchor_rows(rows: DataFrame, key: str, found_in: Callable[[Template], list[Found]]) -> DataFrame:
    """``<key>, size, place, anchor, slots, general`` for the texts of ``rows``; windows without
    slots have place 0, as they need no alignment."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        none = (*(np.zeros(0, np.int64) for _ in range(5)), np.zeros(0, bool))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [(k, f) for k, t in enumerate(texts_of(part)) for f in found_in(template(t, words))]
                sizes, places, hashes, slots, counts, general = map(np.concatenate, zip(none, *(f for _, f in found)))
                owner = np.repeat([k for k, _ in found], [len(f[0]) for _, f in found]).astype(np.int64)
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                yield batch_of(
                    owner=part.column(key).take(pa.array(owner)), size=sizes.astype(np.int32),
                    place=np.where(counts, places, 0).astype(np.int32), anchor=hashes.astype(np.int64),
                    slots=pa.ListArray.from_arrays(ends, slots.astype(np.int64)), general=general,
                ).rename_columns([key, "size", "place", "anchor", "slots", "general"])

    kinds = f"{key} bigint, size int, place int, anchor bigint, slots array<bigint>, general boolean"
    return map_batches(rows, [key, "text"], task, kinds)


def _wanted(items: DataFrame) -> _Wanted:
    """The filter is put together by Spark, 64 bits in a row."""
    sizes = [row["size"] for row in items.select("size").distinct().collect()]
    word = F.expr(f"shiftrightunsigned(anchor, {70 - FILTER_BITS})").alias("word")
    bit = F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(anchor, {64 - FILTER_BITS}) & 63 AS int)))")
    rows = items.groupBy(word).agg(bit.alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return _Wanted(sorted(sizes), bits)


def _fitting(aligned: DataFrame) -> DataFrame:
    """Of the ``rows`` (anchor, slot pairs) of each alignment those whose slots are consistent:
    each holds the item's own value, or the value that stands most often for it (of several
    the smallest). Pairs are weighed only where they conflict."""
    pairs = aligned.withColumn("every", F.flatten(F.transform("rows", lambda r: r["pairs"])))
    pairs = pairs.withColumn("kinds", F.array_distinct("every"))
    conflict = F.size("kinds") > F.size(F.array_distinct(F.transform("kinds", lambda p: p["item_slots"])))
    counted = F.transform(
        "kinds",
        lambda p: F.struct(F.size(F.filter("every", lambda q: q == p)).alias("n"), p.alias("pair")),
    )
    votes = pairs.withColumn("votes", F.when(conflict, counted))

    def beaten(v: Column) -> Column:
        more = lambda o: (o["n"] > v["n"]) | ((o["n"] == v["n"]) & (o["pair"]["slots"] < v["pair"]["slots"]))
        return F.exists("votes", lambda o: (o["pair"]["item_slots"] == v["pair"]["item_slots"]) & more(o))

    chosen = F.transform(F.filter("votes", lambda v: ~beaten(v)), lambda v: v["pair"])
    weighed = votes.withColumn("usual", F.when(F.col("votes").isNotNull(), chosen))
    fits = lambda p: (p["item_slots"] == p["slots"]) | F.array_contains("usual", p)
    kept = F.filter("rows", lambda r: F.forall(r["pairs"], fits))
    return weighed.select("doc_id", "item_id", F.when(F.col("usual").isNull(), F.col("rows")).otherwise(kept).alias("rows"))


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, item_id, matched, anchors, share, changed``: one row for each document
    and item found in it; ``changed`` says that its slots hold other values."""
    rows = stage(anchor_rows(benchmark, "item_id", anchors), "decontaminate-items")
    shared = docs.sparkSession.sparkContext.broadcast(_wanted(rows))
    items = rows.select(
        "item_id", F.col("place").alias("item_place"), "anchor", F.col("slots").alias("item_slots"), "general"
    )
    typed = F.when(~F.col("general"), F.col("anchor"))
    totals = items.groupBy("item_id").agg(
        F.countDistinct("anchor").alias("anchors"), F.countDistinct(typed).alias("typed_anchors")
    )
    if items.limit(BROADCAST_ANCHORS + 1).count() <= BROADCAST_ANCHORS:
        items = F.broadcast(items)
    found_in = lambda made: doc_anchors(made, shared.value)
    hits = anchor_rows(docs, "doc_id", found_in).drop("general").join(items, "anchor")
    pairs = F.arrays_zip("item_slots", "slots").alias("pairs")
    aligned = hits.groupBy("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).agg(
        F.collect_list(F.struct("anchor", "general", pairs)).alias("rows")
    )
    differs = F.exists("rows", lambda r: F.exists(r["pairs"], lambda p: p["item_slots"] != p["slots"]))
    distinct = lambda rows: F.size(F.array_distinct(F.flatten(F.collect_list(rows["anchor"])))).cast("long")
    found = _fitting(aligned).groupBy("doc_id", "item_id").agg(
        distinct(F.col("rows")).alias("matched"),
        distinct(F.filter("rows", lambda r: ~r["general"])).alias("typed"),
        F.bool_or(differs).alias("changed"),
    )
    return (
        found.join(totals, "item_id")
        .withColumn("share", F.greatest(F.col("matched") / F.col("anchors"), F.try_divide("typed", "typed_anchors")))
        .filter(F.col("share") >= share)
        .select("doc_id", "item_id", "matched", "anchors", "share", "changed")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that hold an item, all columns as they were.

    Each row without a doc_id is a document by itself: such rows are written once, each
    as a struct beside a key of its own, which then stays the same for the search and the
    removal and clashes with no column. Null texts stay.
    """
    named = docs.filter("doc_id IS NOT NULL")
    found = contaminated(named, benchmark).select("doc_id").distinct()
    clean = named.join(found, "doc_id", "left_anti")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.filter("doc_id IS NULL").select(F.monotonically_increasing_id().alias("doc_id"), whole)
    keyed = stage(keyed, "decontaminate-nameless")
    found = contaminated(keyed.select("doc_id", "row.text"), benchmark).select("doc_id").distinct()
    nameless = keyed.join(found, "doc_id", "left_anti").select("row.*")
    return clean.select(*(f"`{c}`" for c in docs.columns)).unionByName(nameless)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op3_decontaminate": op3_decontaminate}
SQL: dict[str, str] = {}
