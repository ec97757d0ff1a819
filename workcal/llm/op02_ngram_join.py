"""N-gram Jaccard self-join by set relations, exact, up to connected classes.

Documents are sets of word shingles; two link when their Jaccard similarity reaches
the threshold. Two relations between sets save work:

* Answers of a highly similar set. Equal sets share one representative. Then sets with
  a common min-hash are compared with one leader of their group, the one whose shingles
  are the most common in the corpus and so the least edited copy. A set that links with
  its leader has the leader's class: pairs inside that class need no comparison, so a
  group of thousands of near copies costs thousands of comparisons and not millions.
* Skipping in index lists. Shingles are ordered rare first (by the counts of a sketch
  of fixed size in steps of their scatter, then longer ones first), and each set enters the lists of its first
  n - ceil(t * n) + 1 shingles with the place it has there. Lists are sorted by set
  size; from a set's entry all following ones up to the size limit are visited, one by
  one, and then dropped by place and class. Only entries whose place leaves too few
  shingles for any partner are skipped as starting points. No block of a list is jumped
  over, a list is held in one task, and a member's links to other classes are searched
  anew and not derived from its leader's.

Pairs that survive are compared by the parities of their shingles, about a bit for each:
where two sets' parities differ, one of the sets has a shingle that the other has not, and
more differences than the threshold allows settle a pair. So the whole sets travel for
pairs that are linked or nearly so, and not for every pair with a common shingle.

Whatever is left is verified on the whole sets, so neither the sketch nor the leaders
can lose or add a link: any linked pair has a common shingle in both prefixes within
those bounds. The result is one row per document with the smallest doc_id of its class;
pairs inside a class are never listed.

Null or empty texts have no shingles, link with nothing and are their own class. Rows
that share a doc_id count as one document. A null doc_id is not named as a class; its
row takes the class of the other documents with the same set. Shingles are told apart
by 64-bit hashes, sets by 128 bits. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import stage
from .components import components
from .texts import WordHashes, batch_of, map_batches, mix, table, texts_of, windows, words_of

SHINGLE = 3
PERCENT = 90
#: Counters of the sketch that orders shingles: 4 MB, whatever the corpus.
SKETCH_BITS = 20
_BLOCK = 4096
_TEXTS = 64
_WORDS = 100_000
#: Min-hash keys by which leaders are found.
KEYS = 3
#: The filter for the documents whose sets are fetched has 2^FILTER_BITS buckets at least
#: and 2^FILTER_MOST at most (16 MB), and between them SPARSE or more for each document.
FILTER_BITS, FILTER_MOST, SPARSE = 20, 27, 16

_KEY_SEEDS = [np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)]


def shingle_set(words: list[bytes], hashes: WordHashes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, and the length of each shingle's words."""
    h = hashes.of(words)
    size = min(size, len(h))
    if not size:
        return h, np.zeros(0, dtype=np.int64)
    found, first = np.unique(windows(h, size), return_index=True)
    lengths = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))))
    return found, (lengths[size:] - lengths[:-size])[first]


def _sets(batch: pa.RecordBatch, hashes: WordHashes, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    # A few texts at a time: those of a batch, as strings, are more than the batch.
    for k in range(0, batch.num_rows, _TEXTS):
        for text in texts_of(batch.slice(k, _TEXTS)):
            yield shingle_set(words_of(text), hashes, size)


def _print(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


_DESCRIBED = "doc_id bigint, n bigint, print binary, block int, counts binary"


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """A row per document with its set's size and fingerprint, and rows of sketch counters."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(_WORDS)
        counters = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            sizes, prints = [], []
            for found, _ in _sets(batch, hashes, size):
                # A document counts once in a counter; that is enough for an order.
                counters[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] += 1
                sizes.append(len(found))
                prints.append(_print(found))
            none = pa.nulls(len(sizes), pa.int32())
            yield batch_of(
                doc_id=batch.column("doc_id"), n=pa.array(sizes, pa.int64()), print=pa.array(prints, pa.binary()),
                block=none, counts=pa.nulls(len(sizes), pa.binary()),
            )
        blocks = [k for k in range(0, len(counters), _BLOCK) if counters[k : k + _BLOCK].any()]
        yield batch_of(
            doc_id=pa.nulls(len(blocks), pa.int64()), n=pa.nulls(len(blocks), pa.int64()),
            print=pa.nulls(len(blocks), pa.binary()), block=pa.array(blocks, pa.int32()),
            counts=pa.array([zlib.compress(counters[k : k + _BLOCK].tobytes(), 1) for k in blocks], pa.binary()),
        )

    return stage(map_batches(docs, ["doc_id", "text"], task, _DESCRIBED), "ngram-sets")


def _sketch(described: DataFrame) -> np.ndarray:
    """Counters of all tasks added up; tasks add the rows of a block as a stream."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                own = sums.setdefault(block, np.zeros(_BLOCK, dtype=np.uint32))
                own += np.frombuffer(zlib.decompress(counts.as_buffer()), dtype=np.uint32)
        yield batch_of(
            block=pa.array(list(sums), pa.int32()), counts=pa.array([s.tobytes() for s in sums.values()], pa.binary())
        )

    parts = described.filter("block IS NOT NULL").select("block", "counts").repartition("block")
    total = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for row in map_batches(parts, ["block", "counts"], task, "block int, counts binary").collect():
        total[row.block : row.block + _BLOCK] = np.frombuffer(row["counts"], dtype=np.uint32)
    return total


def parities(found: np.ndarray) -> bytes:
    """Bit k tells whether an odd number of shingles end in k; as many bits as shingles, up to
    the next power of two, and 64 at least."""
    width = max(6, (len(found) - 1).bit_length())
    ends = (found & np.uint64((1 << width) - 1)).astype(np.int64)
    return np.packbits((np.bincount(ends, minlength=1 << width) & 1).astype(np.uint8), bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """A number of shingles that one of two sets has and the other has not, or fewer."""
    one, two = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    long, short = max(len(x), len(y)), min(len(x), len(y))
    if len(x) < len(y):
        one, two = two, one
    while long > short:
        # Shingles with the same shorter end come together.
        long //= 2
        one = (one >> 8 * long) ^ (one & ((1 << 8 * long) - 1))
    return (one ^ two).bit_count()


_PREFIXES = (
    "doc_id bigint, n bigint, print binary, weight double, keys array<bigint>, tokens array<bigint>, bits binary"
)


def _prefixes(docs: DataFrame, sketch: np.ndarray, size: int, percent: int) -> DataFrame:
    """Per document its prefix in the global order, its min-hash keys, how common its
    shingles are, and their parities."""
    # Shingles that occur once still scatter, by what shares their counter: a count says no
    # more than steps of that scatter, however large the corpus.
    steps = np.minimum(sketch / max(1.0, float(sketch.mean()) ** 0.5), 65535).astype(np.uint16)
    shared = docs.sparkSession.sparkContext.broadcast((np.log2(sketch + 1.0).astype(np.float32), steps))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (logs, steps) = WordHashes(_WORDS), shared.value
        for batch in batches:
            made = []
            for found, lengths in _sets(batch, hashes, size):
                n = len(found)
                if not n:
                    made.append((0, b"", 0.0, [], found.view(np.int64), b""))
                    continue
                counter = (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                order = np.lexsort((found, -lengths, steps[counter]))
                prefix = found[order[: n + (-percent * n // 100) + 1]]
                keys = [int(mix(found * s).min().view(np.int64)) for s in _KEY_SEEDS[:KEYS]]
                weight = float(logs[counter].mean())
                made.append((n, _print(found), weight, keys, prefix.view(np.int64), parities(found)))
            ends = np.cumsum([0, *(len(m[4]) for m in made)]).astype(np.int32)
            flat = np.concatenate([m[4] for m in made]) if made else np.zeros(0, np.int64)
            yield batch_of(
                doc_id=batch.column("doc_id"), n=pa.array([m[0] for m in made], pa.int64()),
                print=pa.array([m[1] for m in made], pa.binary()), weight=pa.array([m[2] for m in made], pa.float64()),
                keys=pa.array([m[3] for m in made], pa.list_(pa.int64())), tokens=pa.ListArray.from_arrays(ends, flat),
                bits=pa.array([m[5] for m in made], pa.binary()),
            )

    return map_batches(docs, ["doc_id", "text"], task, _PREFIXES)


def _alike(percent: int):
    """Sizes that leave the threshold within reach."""
    return F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent


def _leader_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each set with the leader of its group, for every min-hash key."""
    keyed = sets.select("id", "n", "weight", F.posexplode("keys").alias("k", "key"))
    best = F.max(F.struct("weight", (-F.col("id")).alias("low"), F.col("n").alias("size"))).alias("best")
    leaders = keyed.groupBy("k", "key").agg(best, F.count("*").alias("members")).filter("members > 1")
    leaders = leaders.select("k", "key", (-F.col("best.low")).alias("leader"), F.col("best.size").alias("n2"))
    pairs = keyed.join(leaders, ["k", "key"]).filter((F.col("id") != F.col("leader")) & _alike(percent))
    return pairs.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()


def _list_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """``a, b`` from the index lists: candidates that sizes, places and classes leave."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in ("token", "id", "class", "n", "place")])
            waiting.append(rows)
            held = np.concatenate(waiting, axis=1)
            # The last list may go on in the next batch.
            last = int(np.flatnonzero(held[0] != held[0, -1])[-1]) + 1 if held[0, 0] != held[0, -1] else 0
            if last:
                yield from _found(held[:, :last], percent)
            waiting = [held[:, last:]]
        if waiting:
            yield from _found(waiting[0], percent)

    ordered = entries.repartition("token").sortWithinPartitions("token", "n", "place", "id")
    return map_batches(ordered, ["token", "id", "class", "n", "place"], task, "a bigint, b bigint").distinct()


def _found(rows: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    token, ids, group, n, place = rows
    left = n - place
    # A set this far down its order has too few shingles left for any set not smaller:
    # its block is skipped as a starting point.
    active = np.flatnonzero(left * (100 + percent) >= 2 * percent * n)
    pairs: list[np.ndarray] = []
    step, held = 1, 0
    while len(active):
        active = active[active + step < len(token)]
        other = active + step
        reach = (token[active] == token[other]) & (n[active] * 100 >= n[other] * percent)
        active, other = active[reach], other[reach]
        good = (np.minimum(left[active], left[other]) * (100 + percent) >= percent * (n[active] + n[other])) & (
            group[active] != group[other]
        )
        if good.any():
            a, b = ids[active[good]], ids[other[good]]
            pairs.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
            held += len(a)
        if held > 200_000:
            yield _pairs(pairs)
            pairs, held = [], 0
        step += 1
    if pairs:
        yield _pairs(pairs)


def _pairs(parts: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.unique(np.concatenate(parts, axis=1), axis=1)
    return batch_of(a=a, b=b)


def _near(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose parities leave the threshold within reach; ``bits`` has ``id, n, bits``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "both"))
            good = [apart(x, y) * (100 + percent) <= both * (100 - percent) for x, y, both in zip(*columns)]
            part = batch.filter(pa.array(good, pa.bool_()))
            yield batch_of(a=part.column("a"), b=part.column("b"))

    left = bits.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    right = bits.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("both", F.col("n_a") + F.col("n_b"))
    return map_batches(both, ["a", "b", "bits_a", "bits_b", "both"], task, "a bigint, b bigint").distinct()


def _filter_bits(pairs: int) -> int:
    """For the documents of so many pairs."""
    return min(FILTER_MOST, max(FILTER_BITS, (2 * SPARSE * pairs - 1).bit_length()))


def verified(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of doc_ids whose whole sets reach the threshold.

    Only documents in pairs have their sets made again and shuffled, and few others: they
    are picked by a filter of buckets, a bit each.
    """
    pairs = stage(pairs.select("a", "b"), "ngram-pairs", narrow=True)
    width = _filter_bits(pairs.count())
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << width)).cast("int")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(bucket("id").alias("bucket"))
    bits = wanted.groupBy(F.expr("shiftright(bucket, 5)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1, bucket & 31))").alias("bits")
    )
    found = bits.toArrow()
    mask = np.zeros(1 << (width - 5), dtype=np.int32)
    mask[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(mask)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(_WORDS)
        for batch in batches:
            at = batch.column("bucket").to_numpy(zero_copy_only=False)
            chosen = (shared.value[at >> 5] >> (at & 31)) & 1
            part = batch.filter(pa.array(chosen.astype(bool)))
            made = [found.tobytes() for found, _ in _sets(part, hashes, size)]
            yield batch_of(id=part.column("doc_id"), items=pa.array(made, pa.binary()))

    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", bucket("doc_id").alias("bucket"))
    sets = map_batches(rows, ["doc_id", "text", "bucket"], make, "id bigint, items binary")
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b")):
                one, two = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if not len(one) or not len(two):
                    good.append(False)
                    continue
                at = np.minimum(np.searchsorted(two, one), len(two) - 1)
                common = int((two[at] == one).sum())
                good.append(100 * common >= percent * (len(one) + len(two) - common))
            part = batch.filter(pa.array(good, pa.bool_()))
            yield batch_of(a=part.column("a"), b=part.column("b"))

    both = pairs.join(left, "a").join(right, "b")
    links = map_batches(both, ["a", "b", "items_a", "items_b"], compare, "a bigint, b bigint").distinct()
    return stage(links, "ngram-links", narrow=True)


def similar_classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    described = _describe(docs, size)
    rows = described.filter("block IS NULL").select("doc_id", "n", "print")
    equal = rows.filter("n > 0").groupBy("n", "print").agg(F.min("doc_id").alias("id"))
    equal = stage(equal, "ngram-equal", narrow=True)

    prefixes = _prefixes(docs, _sketch(described), size, percent).filter("n > 0").dropDuplicates(["doc_id", "print"])
    kept = prefixes.join(
        equal, (prefixes["doc_id"] == equal["id"]) & (prefixes["print"] == equal["print"]), "left"
    ).select(
        "doc_id", "id", prefixes["n"], "weight",
        *(F.expr(f"IF(id IS NULL, NULL, {c})").alias(c) for c in ("keys", "tokens")), "bits",
    )
    kept = stage(kept, "ngram-prefixes")
    sets = kept.filter("id IS NOT NULL").select("id", "n", "weight", "keys", "tokens")
    # Of all texts of a doc_id: verified() compares all of them.
    bits = kept.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "n", "bits")

    known = verified(docs, _near(_leader_pairs(sets, percent), bits, percent), size, percent)
    # Each set takes the class of one leader it links with, and that leader's in turn.
    leader = known.groupBy("a").agg(F.min("b").alias("first"))
    further = leader.select(F.col("a").alias("first"), F.col("first").alias("second"))
    classes = leader.join(further, "first", "left").select(
        F.col("a").alias("id"), F.coalesce("second", "first").alias("class")
    )
    entries = (
        sets.select("id", "n", "tokens")
        .join(classes, "id", "left")
        .select(
            "id", F.coalesce("class", "id").alias("class"), "n", F.posexplode("tokens").alias("place", "token")
        )
        .withColumn("place", F.col("place").cast("long"))
    )
    links = known.unionByName(verified(docs, _near(_list_pairs(entries, percent), bits, percent), size, percent))
    reached = components(links)

    members = rows.join(equal, ["n", "print"], "left")
    return members.join(reached, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id", "doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each class, that with the smallest doc_id; all columns as they were.

    Of rows that share that doc_id one stays. Rows without a doc_id cannot be named by a
    class and stay.
    """
    first = similar_classes(docs, size, percent).filter("component_id = doc_id").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter("doc_id IS NULL")).select(*(f"`{c}`" for c in docs.columns))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op2_ngram_join": op2_ngram_join}
SQL: dict[str, str] = {}
