"""LM scoring: an n-gram model as a weighted automaton with failure arcs.

Tokens are words with A-Z lower-cased, and one end per text. Every word, pair and triple
of the learned texts counts, seen once or often. States are the empty context (root), the
learned words and the learned pairs. A state has an arc for each word that follows its
context in the learned texts, with the smoothed log-probability

    p(w | h) = (c(h w) + mass * p(w | h without its first word)) / (c(h) + mass)

(a hierarchical Dirichlet model), and a failure arc to the shorter context, with weight
mass / (c(h) + mass). As every occurrence of a context but the end of a text is followed
by a token, the probabilities after each state add up to one, the unknown word included.
A text is scored by one traversal from left to right that carries the state.

Counting and looking up are one pass, so that no automaton has to fit into memory:

1. Rows are staged in blocks of bounded size.
2. Each block sends its distinct n-grams, each with its count in the block's learned
   rows, to a bucket by hash: sorted hashes, packed as differences. The number of buckets
   follows the number of tokens, so a bucket's size is bounded at every size of input; an
   n-gram comes at most once per block, so none is hot.
3. A bucket adds up and answers each block with the totals in the order it asked.
4. The answers come to their block, give its part of the automaton, and its texts are
   traversed.

Nothing but two sums passes through the driver, and nothing is broadcast by demand.

Null texts count as empty: one end token. Repeated rows, also those with one doc_id, are
scored (and learned) each by itself; other columns are not read, so names cannot clash.
An empty table gives no rows; with nothing to learn from every token is unknown. A row
whose ``learn`` is null is not learned from. Words are told apart by 64-bit hashes, pairs
and triples by 56 bits: among ten thousand million of them, one new n-gram in seven
million is taken for a learned one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import stage
from .op01_quality_fm import fold
from .texts import WordHashes, batch_of, map_batches, mix, table, words_of

#: Mass of the shorter context's distribution after a word, and after a pair: the best of five settings on a fold of the
#: training rows, learned from the others.
MASS = (300.0, 100.0)
#: A block ends with the row that brings it to so many characters.
BLOCK = 5_000_000
#: Expected n-grams sent to a bucket by all blocks, at most (times two).
BUCKET = 2_000_000
#: Leading bits by which pairs and triples are told apart (words: all 64).
WIDTH = 56
#: Words whose hashes a task remembers.
WORDS = 250_000
#: Positions whose weights a task holds as Python numbers at a time.
STEPS = 50_000

END = np.uint64(0x5F3759DF5F3759DF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ROWS = pa.schema([("doc_id", pa.int64()), ("learn", pa.bool_()), ("text", pa.string())])


def pack(values: np.ndarray) -> bytes:
    """64-bit integers, small ones in few bytes: bytes of equal weight together, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _to_bytes(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _from_bytes(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all().combine_chunks()


def _tokens(rows: pa.Table, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts in one array, where each text ends, and the row of each token."""
    parts, lengths = [np.zeros(0, np.uint64)], []
    for text in rows.column("text").to_pylist():
        h = hashes.of(words_of(text or ""))
        parts += [h, np.array([END])]
        lengths.append(len(h) + 1)
    return np.concatenate(parts), np.cumsum(lengths, dtype=np.int64), np.repeat(np.arange(len(lengths)), lengths)


def _ngrams(tokens: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words, pairs, triples: the places of their last words, and one hash for each.
    None runs over the end of a text. Hashes of words have 64 bits, the others ``WIDTH``."""
    yield np.arange(len(tokens)), tokens
    first = np.zeros(len(tokens), dtype=bool)
    first[ends[:-1]] = True
    first[:1] = True
    pairs = np.zeros(len(tokens), np.uint64)
    pairs[1:] = mix(mix(tokens[:-1]) + tokens[1:] * _ODD)
    cut = np.uint64(64 - WIDTH)
    at = np.flatnonzero(~first)
    yield at, pairs[at] >> cut
    second = np.zeros(len(tokens), dtype=bool)
    second[1:] = first[:-1]
    at = np.flatnonzero(~first & ~second)
    yield at, mix(mix(pairs[at - 1]) + tokens[at] * _ODD) >> cut


def blocks(docs: DataFrame, learn: Column, size: int = BLOCK) -> DataFrame:
    """``block, tokens, learned, rows``: the rows of ``docs`` in blocks, and how many tokens
    they hold, and those to learn from."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.Table] = []
        filled = 0

        def block() -> pa.RecordBatch:
            rows = pa.concat_tables(held).combine_chunks()
            lengths = np.array([len((t or "").encode("utf-8", "surrogatepass").split()) + 1 for t in rows.column("text").to_pylist()])
            learned = rows.column("learn").to_numpy(zero_copy_only=False).astype(bool)
            return batch_of(
                block=[number], tokens=[int(lengths.sum())], learned=[int(lengths[learned].sum())],
                rows=pa.array([_to_bytes(rows)], pa.binary()),
            )

        for batch in batches:
            sizes = np.array([len(t or "") for t in batch.column("text").to_pylist()], dtype=np.int64)
            rows = pa.Table.from_arrays([batch.column(k).cast(_ROWS.field(k).type) for k in _ROWS.names], schema=_ROWS)
            begin = 0
            for at, n in enumerate(sizes.tolist(), 1):
                filled += n + 1
                if filled >= size:
                    held.append(rows.slice(begin, at - begin))
                    yield block()
                    held, filled, begin = [], 0, at
                    number += 1
            if begin < len(rows):
                held.append(rows.slice(begin))
        if held:
            yield block()

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    return map_batches(given, _ROWS.names, task, "block bigint, tokens bigint, learned bigint, rows binary")


def requests(staged: DataFrame, bits: int) -> DataFrame:
    """``n, bucket, block, keys, own``: the distinct n-grams of each block, sorted, and their
    counts in its rows to learn from, cut at the leading ``bits`` of their hashes."""
    edges = {n: np.arange(1 << bits, dtype=np.uint64) << np.uint64((64 if n == 1 else WIDTH) - bits) for n in (1, 2, 3)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(WORDS)
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("rows")):
                rows = _from_bytes(packed.as_buffer())
                tokens, ends, row = _tokens(rows, hashes)
                learned = rows.column("learn").to_numpy()[row]
                for n, (at, keys) in enumerate(_ngrams(tokens, ends), 1):
                    keys, place = np.unique(keys, return_inverse=True)
                    own = np.bincount(place, learned[at], len(keys)).astype(np.uint64)
                    cuts = [*np.searchsorted(keys, edges[n]).tolist(), len(keys)]
                    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if a < b:
                            steps = np.diff(keys[a:b], prepend=np.uint64(0))
                            yield batch_of(
                                n=pa.array([n], pa.int32()), bucket=[bucket], block=[block],
                                keys=pa.array([pack(steps)], pa.binary()), own=pa.array([pack(own[a:b])], pa.binary()),
                            )

    return map_batches(staged, ["block", "rows"], task, "n int, bucket bigint, block bigint, keys binary, own binary")


def answers(asked: DataFrame, buckets: int) -> DataFrame:
    """``n, bucket, block, counts, kinds``: the totals of each request, in its order. One row
    of each bucket has in ``kinds`` how many of its n-grams the learned texts hold."""

    def total(n: int, bucket: int, group: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        keys = [np.cumsum(unpack(k), dtype=np.uint64) for _, k, _ in group]
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        own = np.concatenate([unpack(o) for _, _, o in group])
        # Integer sums, as doubles would round beyond 2^53.
        counts = np.zeros(len(known), np.uint64)
        np.add.at(counts, place, own)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        kinds = int((counts > 0).sum())
        for (block, _, _), part in zip(group, np.split(place, cuts)):
            yield batch_of(
                n=pa.array([n], pa.int32()), bucket=[bucket], block=[block],
                counts=pa.array([pack(counts[part])], pa.binary()), kinds=[kinds],
            )
            kinds = 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, int, bytes, bytes]]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for (n, bucket), group in groupby(rows(), key=lambda r: r[:2]):
            yield from total(n, bucket, [r[2:] for r in group])

    # The count of partitions is given, so a large shuffle is not cut into few.
    gathered = asked.repartition(buckets, "n", "bucket").sortWithinPartitions("n", "bucket")
    return map_batches(gathered, asked.columns, task, "n int, bucket bigint, block bigint, counts binary, kinds bigint")


class Automaton:
    """The part of the automaton that a block's texts pass: per place of a token, the arcs
    that its word may have after the contexts before it, and the failure arcs of these.
    Weights are log10; an arc that is not there has weight 1."""

    def __init__(self, counts: list[np.ndarray], norm: float, mass: tuple[float, float]):
        """``counts``: of the word, pair and triple that end at each place, 0 where none does."""
        one, two, three = counts
        before_one, before_two = (np.concatenate([np.zeros(1), c[:-1]]) for c in (one, two))
        p = (one + 0.5) / norm
        self.root, self.known = np.log10(p), one > 0
        p = (two + mass[0] * p) / (before_one + mass[0])
        self.after_word = np.where(two > 0, np.log10(p), 1.0)
        self.word_fails = np.log10(mass[0] / (before_one + mass[0]))
        p = (three + mass[1] * p) / (before_two + mass[1])
        self.after_pair = np.where(three > 0, np.log10(p), 1.0)
        self.pair_fails = np.log10(mass[1] / (before_two + mass[1]))

    def traverse(self, begin: int, end: int) -> float:
        """Log10 probability of the text at these places."""
        total, state = 0.0, 0  # length of the context that the state stands for
        for at in range(begin, end, STEPS):
            part = slice(at, min(at + STEPS, end))
            arcs = (self.after_pair, self.pair_fails, self.after_word, self.word_fails, self.root, self.known)
            for pair_arc, pair_fails, word_arc, word_fails, root_arc, known in zip(*(a[part].tolist() for a in arcs)):
                if state == 2:
                    if pair_arc <= 0:
                        total += pair_arc
                        continue
                    total += pair_fails
                    state = 1
                if state == 1:
                    if word_arc <= 0:
                        total += word_arc
                        state = 2
                        continue
                    total += word_fails
                total += root_arc
                state = 1 if known else 0
        return total


def _scored(staged: DataFrame, answered: DataFrame, norm: float, mass: tuple[float, float]) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(WORDS)
        for batch in batches:
            for packed, found in zip(batch.column("rows"), batch.column("found")):
                rows = _from_bytes(packed.as_buffer())
                tokens, ends, row = _tokens(rows, hashes)
                parts: dict[int, list[np.ndarray]] = {1: [], 2: [], 3: []}
                for part in found.as_py():
                    parts[part["n"]].append(unpack(part["counts"]))
                counts = []
                for n, (at, keys) in enumerate(_ngrams(tokens, ends), 1):
                    here = np.zeros(len(tokens))
                    if len(at):
                        here[at] = np.concatenate(parts[n])[np.unique(keys, return_inverse=True)[1]]
                    counts.append(here)
                automaton = Automaton(counts, norm, mass)
                begins = [0, *ends[:-1].tolist()]
                yield batch_of(
                    doc_id=rows.column("doc_id").combine_chunks(), n_tokens=np.diff(ends, prepend=0),
                    n_known=np.bincount(row, automaton.known, len(ends)).astype(np.int64),
                    base_score=np.bincount(row, automaton.root, len(ends)),
                    score=np.array([automaton.traverse(a, b) for a, b in zip(begins, ends.tolist())]),
                )

    # A block has at most one answer per bucket and length, in all as many counts as it has n-grams.
    found = answered.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("n", "bucket", "counts"))).alias("found"))
    columns = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    return map_batches(staged.join(found, "block"), ["rows", "found"], task, columns)


def score(
    docs: DataFrame, learn: Column, mass: tuple[float, float] = MASS, size: int = BLOCK, bucket: int = BUCKET
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``,
    with a model of the rows for which ``learn`` is true."""
    staged = stage(blocks(docs, learn, size), "lm-blocks")
    tokens, learned = staged.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0))).first()
    bits = max(1, int(np.ceil(np.log2(max(tokens / bucket, 1)))))
    answered = stage(answers(requests(staged, bits), 3 << bits), "lm-answers")
    kinds = answered.filter("n = 1").agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    scored = _scored(staged, answered, learned + 0.5 * (kinds + 1), mass)
    return scored.withColumn("train_tokens", F.lit(int(learned)).cast("long"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out: Column = F.coalesce(fold() == 1, F.lit(False))
    return score(docs, fold() != 1).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


QUERIES = {"op9_lm_score": op9_lm_score}
SQL: dict[str, str] = {}
