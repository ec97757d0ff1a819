"""Secret scans: fixed patterns, and character Markov models for strings without one.

Two models give the probability of the next character after the last two: one of
random strings (keys, digests, passwords), one of ordinary identifiers and words,
both counted from labelled samples. A string of ``LEAST_RANDOM`` characters or more that
no pattern covers is a secret if random is so much likelier that the log-likelihood ratio
per character passes the threshold of its length. The thresholds come from the labelled
samples too: each half is scored by models of the other half, and a threshold lies where
at most ``FALSE_SHARE`` of the ordinary strings of about that length, by the curve through
their mean and spread, would pass. Digits alone never count: they are card, phone and order
numbers. Strings of letters count like all others.

Rows are read one by one: no shuffle, texts of any length, matching takes linear
time. Null texts count as empty; repeated rows give repeated results, and equal strings
are judged alike wherever they stand; an empty table gives no rows, and models of the generated
samples alone. Other columns, whatever their names, are not read, or kept (``mask_secrets``).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import batch_of, map_batches, table, texts_of

# The patterns whose finds are compared. ASCII letters only, in either case.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
# Runs at least as long as the least: the same finds as to match all runs and drop the short ones.
_ACCESS_LONG = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX_LONG = re.compile(r"[0-9a-f]{16,}")
_LETTER = re.compile(r"[A-Za-z]")
KINDS = ("assign", "access", "hex", "random")

#: Strings of so many characters or more are scored by the models.
LEAST_RANDOM = 12
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RANDOM)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODES = np.full(256, len(_ALPHABET) + 1, dtype=np.int64)
for _k, _c in enumerate(_ALPHABET):
    _CODES[ord(_c)] = _k + 1
_STATES = len(_ALPHABET) + 2  # 0 starts a string, the last is any other character

#: Share of ordinary strings that may pass, and the least ratio of the likelihoods (natural log).
FALSE_SHARE = 0.0005
FLOOR = 4.0
#: At most so many documents, those with the smallest hash of their id, give labelled strings.
SAMPLE_DOCS = 2000
#: At most so many distinct strings of them, none longer than this, are used.
SAMPLE_STRINGS = 100_000
LONGEST_SAMPLE = 256


class Span(NamedTuple):
    start: int
    kind: str
    end: int


def _transitions(string: str) -> np.ndarray:
    codes = np.concatenate(([0, 0], _CODES[np.frombuffer(string.encode("latin-1", "replace"), dtype=np.uint8)]))
    return (codes[:-2] * _STATES + codes[1:-1]) * _STATES + codes[2:]


class MarkovPair:
    """Log-likelihood ratio of random against ordinary, from labelled strings."""

    def __init__(self, samples: Iterable[tuple[str, bool]]):
        halves = [{label: np.zeros(_STATES**3) for label in (True, False)} for _ in range(2)]
        ordinary: list[set[str]] = [set(), set()]
        for string, label in samples:
            half = xxhash.xxh32_intdigest(string) % 2  # a repeated string stays in its half
            np.add.at(halves[half][bool(label)], _transitions(string), 1.0)
            if not label and len(string) >= LEAST_RANDOM:
                ordinary[half].add(string)
        scored = [
            (len(string), self._sum(ratio, string) / len(string))
            for half in (0, 1)
            for ratio in [self._ratio(halves[1 - half])]
            for string in ordinary[half]
        ]
        self.ratio = self._ratio({label: halves[0][label] + halves[1][label] for label in (True, False)})
        self.mean, self.spread = self._calibrate(scored)
        self.known: dict[str, bool] = {}

    @classmethod
    def _ratio(cls, counts: dict[bool, np.ndarray]) -> np.ndarray:
        logs = {k: cls._smoothed(c.reshape(_STATES, _STATES, _STATES)) for k, c in counts.items()}
        return (logs[True] - logs[False]).astype(np.float32).ravel()

    @staticmethod
    def _calibrate(scored: list[tuple[int, float]]) -> tuple[float, float]:
        """Mean of the ratio per character of ordinary strings, and ``c`` such that
        ``mean + c / sqrt(length)`` lets at most ``FALSE_SHARE`` of them pass."""
        if not scored:
            return 0.0, 0.0
        lengths, values = (np.array(x, dtype=np.float64) for x in zip(*scored))
        mean = float(values.mean())
        return mean, float(np.quantile((values - mean) * np.sqrt(lengths), 1.0 - FALSE_SHARE))

    @staticmethod
    def _sum(ratio: np.ndarray, string: str) -> float:
        return float(ratio[_transitions(string)].sum())

    def threshold(self, length: int) -> float:
        """The least score of a random string of ``length`` characters."""
        return max(FLOOR, length * self.mean + self.spread * length**0.5)

    def is_random(self, string: str) -> bool:
        known = self.known.get(string)
        if known is None:
            if len(self.known) >= 200_000:
                self.known.clear()
            known = len(string) >= LEAST_RANDOM and bool(_LETTER.search(string)) and self.score(string) > self.threshold(len(string))
            if len(string) <= 40:
                self.known[string] = known
        return known

    @staticmethod
    def _smoothed(c: np.ndarray) -> np.ndarray:
        """Two characters back, mixed with one back, mixed with none and with uniform."""
        single = c.sum(axis=(0, 1))
        p1 = (single + 1.0) / (single.sum() + _STATES)
        pair = c.sum(axis=0)
        p2 = (pair + 5.0 * p1) / (pair.sum(axis=1, keepdims=True) + 5.0)
        return np.log((c + 5.0 * p2[None]) / (c.sum(axis=2, keepdims=True) + 5.0))

    def score(self, string: str) -> float:
        return self._sum(self.ratio, string)


_PARTS = (
    "get set put new old user name file path data index value count item list map key node tree page link text line "
    "word char buffer stream reader writer handler manager service client server config option default base model view "
    "table column row field type class object method function module package import export build test main init load "
    "save open close read write update delete create find search sort filter group join order date time zone year month "
    "day hour minute second local remote request response header body content length size max min sum total average "
    "first last next previous parent child root left right inner outer source target input output error message result"
).split()


def generated_samples(count: int = 3000, seed: int = 7) -> list[tuple[str, bool]]:
    """Labelled strings of common kinds: keys in usual alphabets, and names in usual styles."""
    r = random.Random(seed)
    alphabets = [_ALPHABET[:62], _ALPHABET[:64], "0123456789abcdef", _ALPHABET[:26] + "0123456789", _ALPHABET[26:62]]
    alphabets += [_ALPHABET[:52], _ALPHABET[:26], _ALPHABET[26:52]]
    made = [(c * size, False) for c in _ALPHABET for size in range(LEAST_RANDOM, LEAST_RANDOM + 10)]  # fillers
    for k in range(count):
        alphabet = alphabets[k % len(alphabets)]
        made.append(("".join(r.choices(alphabet, k=r.randint(LEAST_RANDOM, 64))), True))
        parts = r.choices(_PARTS, k=r.randint(2, 7))
        style = k % 7
        if style == 0:
            name = "_".join(parts)
        elif style == 1:
            name = parts[0] + "".join(p.title() for p in parts[1:])
        elif style == 2:
            name = "-".join(parts) + (str(r.randint(1, 2030)) if k % 4 == 0 else "")
        elif style == 3:
            name = "/".join(parts)
        elif style == 4:
            name = "_".join(parts).upper()
        elif style == 5:
            name = "".join(parts)
        else:  # numbers among names: dates, versions, paths
            year, month, day = r.randint(1950, 2050), r.randint(1, 12), r.randint(1, 28)
            date = f"{year}-{month:02}-{day:02}"
            name = r.choice([f"{date}T{r.randint(0, 23):02}", f"/{'/'.join(parts)}/{date}", f"{parts[0]}-{year}{month:02}{day:02}",
                             f"{parts[0]}_v{r.randint(1, 20)}_{parts[1]}", f"{parts[0]}{r.randint(1, 99)}={parts[1]}"])
        made.append((name, False))
    return made


#: Words as people write them: parts of one case, joined by signs. Anything else (digits among
#: letters, case that jumps) may be a bare key and gets no label from the text.
_WRITTEN = re.compile(r"(?:[a-z]+|[A-Z][a-z]+|[A-Z]+)(?:[-_/](?:[a-z]+|[A-Z][a-z]+|[A-Z]+))*=?")


def text_samples(texts: Iterable[str], least: int = 8) -> Iterator[tuple[str, bool]]:
    """Labelled strings of texts: what the patterns find, and other long words as people write them."""
    for text in texts:
        rest = []
        end = 0
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                yield m[2], True
                rest.append(text[end : m.start()])
                end = m.end()
        rest.append(text[end:])
        for word in re.findall(r"[A-Za-z0-9+/_=-]+", " ".join(rest)):
            if len(word) >= least and not _HEX_LONG.search(word) and not ACCESS.match(word) and _WRITTEN.fullmatch(word):
                yield word, False


def base_spans(text: str) -> list[Span]:
    found = [Span(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [Span(m.start(), "access", m.end()) for m in _ACCESS_LONG.finditer(text)]
    found += [Span(m.start(), "hex", m.end()) for m in _HEX_LONG.finditer(text)]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def model_spans(text: str, model: MarkovPair, known: list[Span]) -> list[Span]:
    """Strings outside the known spans that the models call random."""
    found = []
    ahead = sorted(known)
    at, reach = 0, 0  # the furthest end of the known spans that start before the string's end
    for m in CANDIDATE.finditer(text):
        if not model.is_random(m[0]):
            continue
        start, end = m.span()
        while at < len(ahead) and ahead[at].start < end:
            reach = max(reach, ahead[at].end)
            at += 1
        if reach <= start:
            found.append(Span(start, "random", end))
    return found


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
_SCHEMA = "doc_id bigint, base array<struct<start: bigint, kind: string, end: bigint>>, added array<struct<start: bigint, kind: string, end: bigint>>, masked string"  # noqa: E501


def mask(text: str, spans: Iterable[Span], sign: str = "[SECRET]") -> str:
    """The text with every span, or union of overlapping ones, replaced by ``sign``."""
    parts, at = [], 0
    reach = None
    for s in sorted(spans):
        if reach is not None and s.start < reach:
            reach = max(reach, s.end)
            continue
        if reach is not None:
            at = reach
        parts += [text[at : s.start], sign]
        reach = s.end
    return "".join(parts) + text[reach if reach is not None else 0 :]


def scan_secrets(docs: DataFrame, model: MarkovPair, masked: bool = False) -> DataFrame:
    """Per row the spans of the patterns, the spans the models add, and (if asked for)
    the text with all of them masked. Ends are exclusive, places are code points."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            base = [base_spans(t) for t in texts]
            added = [model_spans(t, model, b) for t, b in zip(texts, base)]
            as_structs = lambda all_spans: pa.array([[s._asdict() for s in spans] for spans in all_spans], _SPANS)
            clean = [mask(t, [*b, *a]) for t, b, a in zip(texts, base, added)] if masked else [None] * len(texts)
            yield batch_of(
                doc_id=batch.column("doc_id"), base=as_structs(base), added=as_structs(added),
                masked=pa.array(clean, pa.string()),
            )

    return map_batches(docs, ["doc_id", "text"], task, _SCHEMA)


def mask_secrets(docs: DataFrame, model: MarkovPair) -> DataFrame:
    """``docs`` with all secrets in ``text`` masked; other columns, and null texts, as they were."""

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        known = base_spans(text)
        return mask(text, [*known, *model_spans(text, model, known)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([clean(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, "text", texts)

    return map_batches(docs, [f"`{c}`" for c in docs.columns], task, docs.schema)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_strings: int = SAMPLE_STRINGS) -> MarkovPair:
    """The models from generated samples and from a bounded sample of documents: those with the
    smallest hashes of their ids, and of their distinct strings those with the smallest hashes,
    each counted three times at most, and words once more in capitals. So neither repeated rows nor long texts grow the sample."""
    chosen = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    ids = [row.doc_id for row in chosen.collect()]
    texts = docs.filter(F.col("doc_id").isin(ids)).select("text") if ids else docs.select("text").limit(0)
    labelled = map_batches(texts, ["text"], _labelled, "string string, secret boolean, n bigint")
    counted = labelled.groupBy("string", "secret").agg(F.sum("n").alias("n"))
    kept = counted.orderBy(F.xxhash64("string"), "string", "secret").limit(sample_strings).collect()
    samples = [(row.string, row.secret) for row in kept for _ in range(min(row.n, 3))]
    shouted = [(row.string.upper(), False) for row in kept if not row.secret and row.string.islower()]
    return MarkovPair([*generated_samples(), *samples, *shouted])


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(x, secret) for x, secret in text_samples(texts_of(batch)) if len(x) <= LONGEST_SAMPLE]
        yield batch_of(
            string=pa.array([s for s, _ in found], pa.string()), secret=pa.array([x for _, x in found], pa.bool_()),
            n=pa.array([1] * len(found), pa.int64()),
        )


def _listed(spans):
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    place = lambda kind: F.array_position(F.array(*map(F.lit, KINDS)), kind)
    keyed = F.transform(spans, lambda s: F.struct(s["start"], place(s["kind"]).alias("place"), s["kind"], s["end"]))
    in_order = F.sort_array(keyed)
    return F.array_join(F.transform(in_order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan_secrets(docs, train(docs))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.size("added").cast("long").alias("n_random"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )


QUERIES = {"op4_secret_scan": op4_secret_scan}
SQL: dict[str, str] = {}
