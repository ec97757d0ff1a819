"""The trie of conversation prefixes, by vertical bitmaps.

A node is a sequence of turns that some conversation begins with. Conversations are taken
in shards of bounded size. A shard has an index from (position, turn) to the bitset of its
conversations with that turn there. From the bitset of a node, those that end there are
its end list; the others are split depth first: the turn of the lowest bit names a
posting, the intersection with it is one child, its popcount the child's members, and
what remains gives the next child. All shards' rows of a node are then added up.

A node is known across shards by the exclusive or of two 64-bit hashes per (position,
turn) of its sequence. So the hash of a part does not depend on what is before it, and a
conversation is cut into blocks of ``BLOCK`` turns: a block begins at the node that the
turns before it give, and no task holds a whole conversation, however long.

Sums over a subtree need each node once, though many shards have it. A node belongs to
its smallest member; the nodes that a conversation owns are the last of its path, from
some depth on. With that depth per conversation a second pass over the shards counts
every node in one place only, and the sums of shards can be added: no step per level.

Defined cases: null role or text are empty; rows without a conv_id are in no conversation;
turns with an equal number are ordered by the hash of role and text; repeated rows are turns
of their own; no rows give no node, not even a root. Columns that are not named are
never read, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import stage
from .op13_merkle import crc32_sql
from .ordering import numbered
from .texts import batch_of, map_batches, table

#: Turns in a block of a conversation; blocks and turns in a shard.
BLOCK = 1024
SHARD_BLOCKS = 2048
SHARD_TURNS = 200_000
#: Conversations whose ids agree but for so many low bits share a piece of an end list.
PIECE_BITS = 16
#: Conversations of one hundred take their first turns from the one that begins it.
GROUP = 100
MOST_SHARED = 6

_SEEDS = (7, 11)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, turn1, turn2, chars``: turns by hashes, from position 1 on."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn",
        *(F.xxhash64(F.lit(s), role, text).alias(f"turn{k}") for k, s in enumerate(_SEEDS, 1)),
        F.length(text).cast("bigint").alias("chars"),
    )
    # The sort has hashes only: the texts are read once.
    ranked = numbered(stage(turns, "trie-turns"), ["conv_id"], ["turn", "turn1", "turn2"], "trie-places")
    return ranked.select("conv_id", (F.col("_rank") + 1).alias("position"), "turn1", "turn2", "chars")


def _keys(seed: int) -> Column:
    """A hash of each turn of a block with its position in the conversation."""
    return F.transform(
        "turns", lambda t, i: F.xxhash64(F.lit(seed), F.col("start") + i + 1, t["turn1"], t["turn2"])
    )


def blocks(turns: DataFrame, head: Column | None = None, size: int = BLOCK) -> DataFrame:
    """Conversations cut into blocks, each with the node it begins at.

    ``head`` is the number of first turns, by conv_id and below ``MOST_SHARED``, that a
    conversation takes from the one that begins its group instead of its own (default: none).
    """
    head = F.lit(0) if head is None else head
    turn = F.struct("position", "turn1", "turn2", "chars")
    own = turns.groupBy("conv_id", F.floor((F.col("position") - 1) / size).alias("block")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    own = own.withColumns({"first": F.col("conv_id") - F.col("conv_id") % GROUP, "head": head.cast("bigint")})
    shared = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("position") < MOST_SHARED))
    heads = shared.groupBy(F.col("conv_id").alias("first")).agg(F.array_sort(F.collect_list(turn)).alias("opening"))
    taken = F.slice(F.coalesce("opening", F.array().cast(own.schema["turns"].dataType)), 1, F.col("head").cast("int"))
    moved = own.join(heads, "first", "left").withColumn("taken", taken).select(
        "conv_id",
        "block",
        F.when(F.col("block") == 0, F.concat("taken", F.filter("turns", lambda t: t["position"] > F.col("head"))))
        .otherwise(F.col("turns"))
        .alias("turns"),
        F.when(F.col("block") == 0, F.lit(0).cast("bigint"))
        .otherwise(F.col("block") * size - F.col("head") + F.size("taken"))
        .alias("start"),
    )
    keys = [_keys(seed).alias(f"key{k}") for k, seed in enumerate(_SEEDS, 1)]
    rows = moved.select("conv_id", "block", "start", *keys, F.transform("turns", lambda t: t["chars"]).alias("chars"))
    return stage(_with_entries(rows, size), "trie-blocks")


def _with_entries(rows: DataFrame, size: int) -> DataFrame:
    """What stands before and after a block in its conversation, from its blocks' sums."""

    def xor(column: str) -> Column:
        return F.aggregate(column, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseXOR(b))

    total = F.aggregate("chars", F.lit(0).cast("bigint"), lambda a, b: a + b)
    sums = rows.select("conv_id", "block", xor("key1").alias("x1"), xor("key2").alias("x2"), total.alias("sum"))
    # Only sums of blocks meet in a window: one row for each thousand turns.
    each = W.partitionBy("conv_id").orderBy("block")
    before, after = each.rowsBetween(W.unboundedPreceding, -1), each.rowsBetween(1, W.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    placed = sums.select(
        "conv_id", "block",
        F.coalesce(F.bit_xor("x1").over(before), zero).alias("entry1"),
        F.coalesce(F.bit_xor("x2").over(before), zero).alias("entry2"),
        F.coalesce(F.sum("sum").over(after), zero).alias("later"),
        F.lead("block").over(each).isNull().alias("final"),
    )
    return rows.join(placed, ["conv_id", "block"]).select(
        "conv_id", "start", "entry1", "entry2", "key1", "key2", "chars", "later", "final"
    )


class Shard:
    """Blocks of conversations and their index of bitsets."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.starts: list[int] = []
        self.keys: list[list[tuple[int, int]]] = []
        self.chars: list[list[int]] = []
        self.rest: list[tuple] = []
        self.turns = 0
        self.ascending = True
        self.postings: dict[tuple[int, int], int] = defaultdict(int)
        self.stops: dict[int, int] = defaultdict(int)
        self.entries: dict[tuple[int, int, int], int] = defaultdict(int)

    def add(self, conv_id: int, start: int, entry: tuple[int, int], keys: list, chars: list[int], rest: tuple) -> None:
        bit = 1 << len(self.ids)
        self.ascending = self.ascending and (not self.ids or self.ids[-1] <= conv_id)
        self.ids.append(conv_id)
        self.starts.append(start)
        self.keys.append(keys)
        self.chars.append(chars)
        self.rest.append(rest)
        self.turns += len(keys)
        for key in keys:  # a key says the position too
            self.postings[key] |= bit
        self.stops[start + len(keys)] |= bit
        self.entries[(start, *entry)] |= bit

    def nodes(self, sums: bool) -> Iterator[tuple]:
        """``(node, parent, depth, members, stopped, chars, weight)`` of every node, children
        before parents. ``members`` and ``stopped`` are bitsets. ``weight`` is, with
        ``sums``, ``[characters saved, leaves]`` over the subtree as far as this shard
        counts them. A node that a block begins at is not repeated, unless it is the root.
        """
        for (start, *entry), members in self.entries.items():
            top = (tuple(entry), None, start, members, 0, [0, 0])
            stack = [[top, None]]
            while stack:
                frame = stack[-1]
                (node, parent, depth, inside, chars, weight), left = frame
                if left is None:
                    left = inside & ~self.stops.get(depth, 0)
                    frame[1] = left
                if left:
                    row = (left & -left).bit_length() - 1
                    at = depth - self.starts[row]
                    key = self.keys[row][at]
                    child = left & self.postings[key]
                    frame[1] = left & ~child
                    name = (node[0] ^ key[0], node[1] ^ key[1])
                    stack.append([(name, node, depth + 1, child, self.chars[row][at], [0, 0]), None])
                    continue
                stack.pop()
                stopped = inside & self.stops.get(depth, 0)
                if sums:
                    self._weigh(depth, inside, stopped, chars, weight)
                if stack:
                    above = stack[-1][0][5]
                    above[0] += weight[0]
                    above[1] += weight[1]
                if start == 0 or depth > start:
                    yield node, parent, depth, inside, stopped, chars, weight

    def _weigh(self, depth: int, inside: int, stopped: int, chars: int, weight: list[int]) -> None:
        """Adds the node itself, and what its stopped blocks have behind them."""
        weight[0] += chars * inside.bit_count()
        first = self.rest[self._smallest(inside)]
        if first[2] <= depth:  # the node's owner is here
            weight[0] -= chars
        for row in bits(stopped):
            later, final, owned_from, owned, leaf = self.rest[row]
            if not final:
                weight[0] += later - (later if owned_from <= depth else owned)
            weight[1] += leaf

    def _smallest(self, members: int) -> int:
        """The row with the smallest conversation, which is the lowest bit if rows ascend."""
        if self.ascending:
            return (members & -members).bit_length() - 1
        return min(bits(members), key=self.ids.__getitem__)


def bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def _shards(batches: Iterator[pa.RecordBatch], rest: list[str], most: int) -> Iterator[Shard]:
    shard = Shard()
    # A few rows at a time become Python values: a row may have as many turns as a block.
    for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "start", "entry1", "entry2", "key1", "key2", "chars", *rest)]
        for conv_id, start, e1, e2, k1, k2, chars, *more in zip(*columns):
            shard.add(conv_id, start, (e1, e2), list(zip(k1, k2)), chars, tuple(more))
            if len(shard.ids) >= most or shard.turns >= SHARD_TURNS:
                yield shard
                shard = Shard()
    if shard.ids:
        yield shard


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield batch_of(**{f.name: pa.array(c, f.type) for f, c in zip(schema, zip(*held))})
            held = []
    if held:
        yield batch_of(**{f.name: pa.array(c, f.type) for f, c in zip(schema, zip(*held))})


_NODES = (
    "node1 bigint, node2 bigint, parent1 bigint, parent2 bigint, depth bigint, n bigint, conv_id bigint, "
    "chars bigint, piece bigint, ends binary"
)
_KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in schema.split(", ")])


def _listed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Shards' nodes: members, the smallest of them, and pieces of end lists on rows of their own."""

    def rows() -> Iterator[tuple]:
        for shard in _shards(batches, ["final"], most):
            for node, parent, depth, inside, stopped, chars, _ in shard.nodes(sums=False):
                above = parent or (None, None)
                yield *node, *above, depth, inside.bit_count(), shard.ids[shard._smallest(inside)], chars, None, None
                pieces: dict[int, list[int]] = defaultdict(list)
                for row in bits(stopped):
                    if shard.rest[row][0]:
                        pieces[shard.ids[row] >> PIECE_BITS].append(shard.ids[row])
                for piece, ids in pieces.items():
                    yield *node, None, None, None, None, None, None, piece, np.array(sorted(ids), dtype="<i8").tobytes()

    yield from _batches(rows(), _arrow(_NODES))


_SUMS = "node1 bigint, node2 bigint, saved bigint, leaves bigint"


def _summed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for shard in _shards(batches, ["later", "final", "owned_from", "owned", "leaf"], most):
            for node, *_, weight in shard.nodes(sums=True):
                yield *node, *weight

    yield from _batches(rows(), _arrow(_SUMS))


_ID = ["node1", "node2"]
_INPUT = ["conv_id", "start", "entry1", "entry2", "key1", "key2", "chars"]


def prefix_trie(cut: DataFrame, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """The nodes of the conversations in ``blocks`` and their end lists.

    Nodes: ``node1, node2, parent1, parent2`` (null for the root), ``depth``, ``conv_id`` (the
    smallest member), ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``. End lists: ``node1, node2, piece, ends``, the conv_ids as 64-bit integers in
    ascending order, in one or more rows for each piece of 2 to the power of ``PIECE_BITS`` ids.
    """
    listed = stage(map_batches(cut, [*_INPUT, "final"], partial(_listed, most=shard_blocks), _NODES), "trie-shards")
    parts = listed.filter("n IS NOT NULL")
    ends = listed.filter("ends IS NOT NULL").select(*_ID, "piece", "ends")
    nodes = stage(
        parts.groupBy(*_ID).agg(
            F.min("parent1").alias("parent1"), F.min("parent2").alias("parent2"), F.min("depth").alias("depth"),
            F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("chars").alias("chars"),
        ),
        "trie-nodes",
    )
    below = nodes.filter("depth > 0").groupBy(F.col("parent1").alias("node1"), F.col("parent2").alias("node2"))
    children = stage(below.agg(F.count("*").alias("n_children")), "trie-children")
    counted = nodes.join(children, _ID, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    # Of the nodes a conversation owns only the last can be without children.
    owners = counted.groupBy("conv_id").agg(
        F.min("depth").alias("owned_from"), F.sum("chars").alias("owned"),
        F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaf"),
    )
    # A conversation that owns no node counts for none; the leaf is counted by its last block.
    none = F.lit(1 << 62).cast("bigint")
    owned = cut.join(owners, "conv_id", "left").withColumns(
        {
            "owned_from": F.coalesce("owned_from", none),
            "owned": F.coalesce("owned", F.lit(0).cast("bigint")),
            "leaf": F.coalesce("leaf", F.lit(0).cast("bigint")),
        }
    )
    weights = map_batches(owned, [*_INPUT, "later", "final", "owned_from", "owned", "leaf"], partial(_summed, most=shard_blocks), _SUMS)
    sums = weights.groupBy(*_ID).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    above = nodes.select(
        F.col("node1").alias("parent1"), F.col("node2").alias("parent2"), F.col("conv_id").alias("parent_conv_id")
    )
    whole = counted.join(sums, _ID).join(above, ["parent1", "parent2"], "left").select(
        *_ID, "parent1", "parent2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
    )
    return whole, ends


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node over its pieces, which come in order; one piece is held at a time."""

    def rows() -> Iterator[tuple]:
        node, piece, held, digest, begun = None, None, [], None, False

        def flush() -> None:
            nonlocal begun
            ids = np.sort(np.concatenate([np.frombuffer(e, dtype="<i8") for e in held]))
            digest.update((("," if begun else "") + ",".join(map(str, ids.tolist()))).encode())
            begun = True

        for batch in batches:
            for n1, n2, at, ends in zip(*(batch.column(c).to_pylist() for c in ("node1", "node2", "piece", "ends"))):
                if held and ((n1, n2) != node or at != piece):
                    flush()
                    held = []
                if (n1, n2) != node:
                    if node is not None:
                        yield *node, digest.hexdigest()
                    node, digest, begun = (n1, n2), hashlib.sha256(), False
                piece = at
                held.append(ends)
        if held:
            flush()
            yield *node, digest.hexdigest()

    yield from _batches(rows(), pa.schema([("node1", pa.int64()), ("node2", pa.int64()), ("ends_sha256", pa.string())]))


def end_digests(ends: DataFrame) -> DataFrame:
    """``node1, node2, ends_sha256``: SHA-256 of the ascending conv_ids, joined by commas.

    Such a hash is one sequence by its nature; it is fed piece by piece, with memory for one.
    """
    placed = ends.repartition(*_ID).sortWithinPartitions(*_ID, "piece")
    return map_batches(placed, [*_ID, "piece", "ends"], _digested, "node1 bigint, node2 bigint, ends_sha256 string")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED
    nodes, ends = prefix_trie(blocks(numbered_turns(table(spark, sf_dir, "conversations")), shared))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(end_digests(ends), _ID, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )


SQL = {
    "op11_prefix_trie": f"""WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS first, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own),
turns AS (
  SELECT h.conv_id, 0 AS own, o.place, o.role, o.text
  FROM heads h JOIN own o ON o.conv_id = h.first AND o.place <= h.h
  UNION ALL
  SELECT h.conv_id, 1, o.place, o.role, o.text FROM heads h JOIN own o ON o.conv_id = h.conv_id AND o.place > h.h),
rebuilt AS (
  SELECT conv_id, sha256(strlen(role) || ':' || role || text) AS turn, length(text) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM turns),
paths AS (
  SELECT conv_id, depth, chars,
    string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node, coalesce(string_agg(turn, '') OVER (
      PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent,
    count(*) OVER (PARTITION BY conv_id) = depth AS final
  FROM rebuilt),
members AS (
  SELECT conv_id, depth, chars, sha256(node) AS node, sha256(parent) AS parent, final FROM paths
  UNION ALL
  SELECT conv_id, 0, 0, sha256(''), NULL, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM heads),
nodes AS (
  SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (final), '')) AS ends_sha256
  FROM members GROUP BY node, parent, depth),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (SELECT DISTINCT m.node AS top, n.node FROM members m JOIN members n ON m.conv_id = n.conv_id AND n.depth >= m.depth),
sums AS (
  SELECT top AS node, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens, count(*) FILTER (c.n IS NULL) AS n_leaves
  FROM above a JOIN nodes n ON n.node = a.node LEFT JOIN children c ON c.node = a.node GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
  s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN children c ON c.node = n.node
  LEFT JOIN nodes p ON p.node = n.parent"""
}
QUERIES = {"op11_prefix_trie": op11_prefix_trie}
