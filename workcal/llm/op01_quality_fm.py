"""Quality classifier: a factorisation machine over words, structure and length.

Features of a text are its hashed words, bucketed structure statistics and its
length. Every pair of features interacts through low-rank factors; with the identity
2 * sum_{i<j} <v_i, v_j> x_i x_j = |sum_i v_i x_i|^2 - sum_i |v_i x_i|^2 a text is
scored in time linear in its distinct words.

The model is fitted on at most ``SAMPLE`` labelled rows (those with the smallest hash
of their id; the only bound, and a parameter) and is a table of fixed size, whatever
the size of the input. Scoring reads each whole text once: no shuffle. Null and empty
texts get a score from their structure features like any other text. Without labels
every score is 0.5. Repeated rows get repeated scores; labels that contradict each
other both count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import WordHashes, batch_of, map_batches, table, texts_of

#: Labelled rows to fit on, at most.
SAMPLE = 8000
WORD_BITS = 16
FACTORS = 8
EPOCHS = 6
THRESHOLD = 0.3

_BUCKETS = 12
# Kinds of bytes whose shares are features.
_KINDS = ("lower", "upper", "digit", "space", "line", "stop", "comma", "loud", "symbol", "other", "high")
_KIND_OF = np.full(256, 9, dtype=np.uint8)
for _kind, _bytes in (
    (0, b"abcdefghijklmnopqrstuvwxyz"), (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b" \t\r\x0b\x0c"),
    (4, b"\n"), (5, b".;:?"), (6, b",-'\"()"), (7, b"!"), (8, b"#*$%&|<>@^~{}[]_=+\\"), (10, bytes(range(128, 256))),
):
    _KIND_OF[list(_bytes)] = _kind
N_STATS = len(_KINDS) + 5
N_FEATURES = (1 << WORD_BITS) + N_STATS * _BUCKETS


def _log_bucket(x: float) -> int:
    return min(_BUCKETS - 1, int(np.log2(x + 1.0)))


def _share_bucket(x: float) -> int:
    """0 is exactly none; then finer for small shares."""
    return 0 if x <= 0 else min(_BUCKETS - 1, 1 + int(x**0.5 * (_BUCKETS - 1)))


class Features:
    """``(indices, values)`` of texts; word values have length one together, statistics
    have a fixed weight."""

    def __init__(self):
        self.hashes = WordHashes()

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        data = text.encode("utf-8", "surrogatepass")
        words = data.lower().split()
        hashed = self.hashes.of(words) & np.uint64((1 << WORD_BITS) - 1)
        distinct, counts = np.unique(hashed.astype(np.int32), return_counts=True)
        kinds = np.bincount(_KIND_OF[np.frombuffer(data, dtype=np.uint8)], minlength=len(_KINDS))
        size, n = max(1, len(data)), max(1, len(words))
        buckets = [_share_bucket(k / size) for k in kinds.tolist()]
        buckets += [
            _log_bucket(len(data)),
            _log_bucket(len(words)),
            min(_BUCKETS - 1, len(data) // n),
            _share_bucket(len(distinct) / n),
            _share_bucket(int(counts.max()) / n if len(counts) else 0.0),
        ]
        places = (1 << WORD_BITS) + np.arange(N_STATS) * _BUCKETS + np.array(buckets)
        weights = 1.0 + np.log(counts)
        norm = np.sqrt((weights**2).sum()) if len(weights) else 1.0
        indices = np.concatenate((distinct, places.astype(np.int32)))
        values = np.concatenate((weights / norm, np.full(N_STATS, 0.5)))
        return indices, values.astype(np.float32)


class FactorisationMachine:
    def __init__(self, features: int = N_FEATURES, factors: int = FACTORS, seed: int = 11):
        r = np.random.default_rng(seed)
        self.bias = 0.0
        self.linear = np.zeros(features, dtype=np.float32)
        self.factors = r.normal(0.0, 0.05, (features, factors)).astype(np.float32)

    def margins(self, indices: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid of rows that lie one behind the other; none is empty."""
        weighted = self.factors[indices] * values[:, None]
        sums = np.add.reduceat(weighted, starts, axis=0)
        squares = np.add.reduceat((weighted * weighted).sum(axis=1), starts)
        linear = np.add.reduceat(self.linear[indices] * values, starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)

    def fit(
        self, rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
        rate: float = 0.1, decay: float = 1e-4, size: int = 64, seed: int = 5,
    ) -> FactorisationMachine:
        """Logistic loss, AdaGrad over small batches."""
        if not len(rows):
            return self
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.bias = float(np.log(share / (1 - share)))
        seen_linear = np.full(self.linear.shape, 1e-6, dtype=np.float32)
        seen_factors = np.full(self.factors.shape, 1e-6, dtype=np.float32)
        r = np.random.default_rng(seed)
        for _ in range(epochs):
            order = r.permutation(len(rows))
            for at in range(0, len(order), size):
                chosen = order[at : at + size]
                indices = np.concatenate([rows[i][0] for i in chosen])
                values = np.concatenate([rows[i][1] for i in chosen])
                lengths = np.array([len(rows[i][0]) for i in chosen])
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                row = np.repeat(np.arange(len(chosen)), lengths)
                error = 1 / (1 + np.exp(-self.margins(indices, values, starts))) - labels[chosen]
                self.bias -= rate * 0.1 * float(error.mean())
                weighted = self.factors[indices] * values[:, None]
                sums = np.add.reduceat(weighted, starts, axis=0)
                slope = (error[row] * values / len(chosen)).astype(np.float32)
                by_factor = slope[:, None] * (sums[row] - weighted)
                touched, inverse = np.unique(indices, return_inverse=True)
                linear = np.bincount(inverse, slope, len(touched)).astype(np.float32) + decay * self.linear[touched]
                factors = np.stack([np.bincount(inverse, g, len(touched)) for g in by_factor.T], axis=1)
                factors = factors.astype(np.float32) + decay * self.factors[touched]
                seen_linear[touched] += linear**2
                seen_factors[touched] += factors**2
                self.linear[touched] -= rate * linear / np.sqrt(seen_linear[touched])
                self.factors[touched] -= rate * factors / np.sqrt(seen_factors[touched])
        return self


def _flat(made: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([0, *(len(i) for i, _ in made)])
    return np.concatenate([i for i, _ in made]), np.concatenate([v for _, v in made]), ends


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        if not batch.num_rows:
            continue
        indices, values, ends = _flat([features.of(t) for t in texts_of(batch)])
        ends = ends.astype(np.int32)
        yield batch_of(
            label=batch.column("_label"), indices=pa.ListArray.from_arrays(ends, indices),
            values=pa.ListArray.from_arrays(ends, values),
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine:
    """Fitted on at most ``sample`` rows of ``labels`` (doc_id, quality 0 or 1)."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    chosen = (
        known.select("doc_id", F.col("quality").cast("double").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_label")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    got = map_batches(rows, ["text", "_label"], _featurise, "label double, indices array<int>, values array<float>")
    made = got.toArrow()
    vectors = [
        (np.asarray(i.values), np.asarray(v.values)) for i, v in zip(made.column("indices"), made.column("values"))
    ]
    # Order of arrival must not matter.
    order = sorted(range(len(vectors)), key=lambda k: (vectors[k][0].tobytes(), made.column("label")[k].as_py()))
    target = np.array([made.column("label")[k].as_py() for k in order])
    return FactorisationMachine().fit([vectors[k] for k in order], target)


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """``doc_id, score``: probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size, see N_FEATURES

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                indices, values, ends = _flat([features.of(t) for t in texts_of(part)])
                margins = shared.value.margins(indices, values, ends[:-1]).astype(np.float64)
                yield batch_of(doc_id=part.column("doc_id"), score=1 / (1 + np.exp(-np.clip(margins, -30, 30))))

    return map_batches(docs, ["doc_id", "text"], task, "doc_id bigint, score double")


def fold(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(column).cast("string")) % 5


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    model = train(docs, labels.filter(fold() != 0))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op1_quality_fm": op1_quality_fm}
SQL: dict[str, str] = {}
