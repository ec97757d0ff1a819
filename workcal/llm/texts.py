"""What the text operators share: Arrow batches through Python, words, hashes.

Python runs once per Arrow batch, never per row from Spark's side, and a batch is
bounded by Spark in rows and bytes. Null texts count as empty texts.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# ASCII white space ends a word; only A-Z are lower-cased.
SPACES = b" \t\n\x0b\x0c\r"
_REPOSITORY = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, columns: Iterable[str], task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``task`` over the Arrow batches of the named columns; other columns are not read.

    The workers find this package on the path the driver found it on.
    """
    paths = df.sparkSession.sparkContext.environment
    known = paths.get("PYTHONPATH", "").split(os.pathsep)
    if _REPOSITORY not in known:
        paths["PYTHONPATH"] = os.pathsep.join([_REPOSITORY, *filter(None, known)])
    return df.select(*columns).mapInArrow(task, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def batch_of(**columns) -> pa.RecordBatch:
    """A batch from arrays or numpy arrays by name."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()],
        names=list(columns),
    )


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered; forgotten together when there are many."""

    def __init__(self, bound: int = 1_000_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    h = (h ^ (h >> np.uint64(32))) * _MIX[3]
    h = (h ^ (h >> np.uint64(29))) * _MIX[1]
    return h ^ (h >> np.uint64(32))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each window of ``size`` consecutive values."""
    count = len(hashes) - size + 1
    if count <= 0:
        return hashes[:0]
    out = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        out = mix(out * _MIX[0] + hashes[k : k + count])
    return out
