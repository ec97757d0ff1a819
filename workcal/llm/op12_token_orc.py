"""Token ids as ORC files, in ascending order of their documents.

A dataset is a folder of ORC files, one per range of document ids, each written by one
task in order. A row is a document: its ids as an integer array, which ORC stores with
its run-length encoding, the number of the range, and how many ids stand before it in
that range. ORC keeps statistics per stripe and per group of rows, and a Bloom filter on
``doc_id`` per group, so a reader that asks for documents skips the rest (``lookup``), and
the stripes of a file can be read by different tasks (``read_tokens``): a row says where
it stands, so no reader depends on another.

Texts, not ids, are shuffled into the ranges: the column files of the input are smaller
than ids, and a range is encoded, written and forgotten by one task, batch by batch. A
task that is lost is run again, and Spark's commit lets only whole files into the folder.

Encoding: for a byte-level vocabulary whose merges are listed by id, pairs merged by rank
give the tokenizers library's ids, many times faster; ``encoder`` reads vocabulary and
merges from the tokenizer's own file, compares both ways on texts made of its own tokens,
and takes the library itself for any file of another kind and for texts with special
tokens or very long runs of white space.

Defined cases: a null or empty text has the end id only; a null doc_id comes first, rows
with one doc_id are ordered by their number of code points and a hash of the text, so
repeated rows follow each other and have rows of their own; an empty table gives an empty
dataset. Other columns are not read, so names cannot clash.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ..scratch import scratch_dir, stage
from ..sources import from_rows
from .texts import batch_of, map_batches, table, texts_of

#: Id behind the ids of every document.
END_ID = 2
#: ORC: bytes of a stripe, rows of an index group, false hits of its Bloom filter.
STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1000
BLOOM_FPP = 0.01
#: A run of white space from this length on goes to the tokenizers library.
LONG_SPACE = 4096

Encode = Callable[[str], np.ndarray]
_SCHEMA = "doc_id bigint, part int, at bigint, ids array<int>"
_BASES = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("base", T.LongType())])


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones
    stand for themselves, the others follow from U+0100 on in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of byte strings, if merging by rank says the same as the file's merges."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not plain or spec.get("normalizer") or any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges")):
        return None
    if model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    vocabulary, byte_of = model["vocab"], _byte_of()
    added = {a["content"] for a in spec["added_tokens"]}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [vocabulary[a + b] for a, b in pairs]
    if merged != sorted(set(merged)) or len(merged) + 256 != len(vocabulary.keys() - added):
        return None
    return {bytes(byte_of[c] for c in w): n for w, n in vocabulary.items() if w not in added}


@lru_cache(maxsize=4)
def encoder(path: str) -> Encode:
    """Text to ids, as the tokenizers library encodes it without adding special tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def whole(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ranks = _ranks(spec)
    if ranks is None:
        return whole
    special = [a["content"] for a in spec["added_tokens"]]
    gaps, spaces = re.compile(r"\s"), re.compile(r"\s{%d}" % LONG_SPACE)
    by_rank = tiktoken.Encoding("by_rank", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def fast(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return whole(text)
        # A run of that length covers two neighbours of this grid of places, a cheap first look.
        if len(text) >= LONG_SPACE and "  " in gaps.sub(" ", text[:: LONG_SPACE // 2]) and spaces.search(text):
            return whole(text)
        return np.array(by_rank.encode_ordinary(text), dtype=np.uint32)

    step = max(1, len(ranks) // 2000)
    sample = "".join(w.decode("utf-8", "ignore") for w in list(ranks)[::step])
    return fast if np.array_equal(fast(sample), whole(sample)) else whole


def _encoded(path: str, end_id: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            found, lengths = [], []
            for text in texts_of(batch):
                found += (ids := encode(text)), end
                lengths.append(len(ids) + 1)
            if not lengths:
                continue
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            values = pa.array(np.concatenate(found).view(np.int32))
            yield batch_of(
                doc_id=batch.column("doc_id"), part=np.full(batch.num_rows, part, dtype=np.int32), at=at + offsets[:-1],
                ids=pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
            )
            at += int(offsets[-1])

    return task


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> None:
    """Writes the ids of all ``docs`` (``doc_id, text``) to ``folder``, ascending by doc_id."""
    spark = docs.sparkSession
    order = [F.asc_nulls_first("doc_id"), F.asc(F.length("text")), F.asc(F.xxhash64("text"))]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.select("doc_id", "text").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = map_batches(placed, ["doc_id", "text"], _encoded(tokenizer_path, end_id), _SCHEMA)
    (
        rows.write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.compress", "ZSTD")
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, part, at, ids`` of a dataset; Spark deals the stripes of its files to tasks."""
    return spark.read.schema(_SCHEMA).orc(folder)


def lookup(spark: SparkSession, folder: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of some documents: other stripes and groups are left out by their
    statistics and Bloom filters."""
    return read_tokens(spark, folder).filter(F.col("doc_id").isin(list(doc_ids)))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        data = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        bounds = ids.offsets.to_numpy()
        sums = [zlib.crc32(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        yield batch_of(
            doc_id=batch.column("doc_id"), part=batch.column("part"), at=batch.column("at"),
            n_tokens=np.diff(bounds).astype(np.int64), ids_crc32=pa.array(sums, pa.int64()),
        )


def measure(tokens: DataFrame, name: str = "token-digests") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the rows of ``read_tokens``.

    The rows are read once, in any number of tasks. What stands before a range is the sum
    of the ranges before it: one number per file reaches the driver.
    """
    spark = tokens.sparkSession
    schema = "doc_id bigint, part int, at bigint, n_tokens bigint, ids_crc32 bigint"
    rows = stage(map_batches(tokens, ["doc_id", "part", "at", "ids"], _measured, schema), name)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before = np.concatenate([[0], np.cumsum([r.n for r in totals])]).astype(int).tolist()
    bases = from_rows(spark, [(r.part, b) for r, b in zip(totals, before)], _BASES)
    return rows.join(bases, "part").select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def op12_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-ids")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return measure(read_tokens(spark, folder))


# Tokenizers are beyond SQL; the tests hold the rows against the library.
QUERIES = {"op12_token_orc": op12_token_orc}
SQL: dict[str, str] = {}
