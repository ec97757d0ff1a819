"""Licence scans: phrases by Aho-Corasick, tag expressions by a shunting yard.

A text becomes its words (A-Z lower-cased, words are runs of ASCII letters, digits
and non-ASCII characters), joined by single spaces. One Aho-Corasick automaton over
notice phrases and tag names passes over that string once, whatever the number of
phrases, and finds overlapping ones too. Where it meets the identifier tag, the
licence expression behind the tag is read from the text itself: a shunting-yard
parser puts ``WITH`` before ``AND`` before ``OR`` and evaluates how binding the
expression is. Only identifiers of a known licence family become labels; an expression
with any other operand ("see file") keeps the known ones and has no value, and the other
operands are listed by themselves. Notices count besides tags: a text binds as its strictest part.

Each row is read by itself: no shuffle, any length of text, hot sources do not
matter. Null and empty texts have no words and score 0, an empty table gives none.
Repeated rows are repeated results; of other columns, whatever their names, none is read. A
malformed expression keeps the known identifiers that it names, without a value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .texts import batch_of, map_batches, table, texts_of

# The phrases and labels that results are compared by.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases and their labels.
NOTICE_PHRASES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "2 clause bsd": "bsd-2-clause",
    "3 clause bsd": "bsd-3-clause",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
CUES = ("licensed under", "released under", "distributed under", "available under")

# How binding a licence is, by the start of its identifier: 0 permissive, 1 strong copyleft.
BINDING = {
    "agpl": 1.0, "gpl": 1.0, "cc-by-nc": 0.9, "cc-by-nd": 0.9, "cc-by-sa": 0.8, "lgpl": 0.6, "mpl": 0.5, "epl": 0.5,
}
_DEFAULT_BINDING = 0.1
#: How identifiers of licences begin, up to their first hyphen. ``LicenseRef-`` names one's own.
FAMILIES = frozenset(
    "0bsd aal afl agpl apache apl apsl artistic beerware blueoak bsd bsl busl c cc cc0 cddl cecill cpal cpl ecl efl epl "
    "eupl fdl ftl gfdl gpl hpnd icu ijg imatix ipl isc jpnic lgpl libpng libtiff licenseref lppl mit mpl ms mulanpsl ncsa "
    "nasa netcdf ofl ogl olfl openssl osl php postgresql psf python qpl ruby sgi sissl sleepycat spl ssh tcl ubl ucl "
    "unicode unlicense upl vim w3c wtfpl x11 xnet zlib zpl".split()
)


def is_licence(identifier: str) -> bool:
    """``mit``, ``gpl-2.0-only``, ``apache-2.0+``; case does not matter."""
    return identifier.lower().rstrip("+").partition("-")[0] in FAMILIES

_TAG_TEXT = re.compile(r"spdx-license-identifier:[ \t]*([^\n]*)", re.IGNORECASE)
_SYMBOL = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}

# Bytes that belong to no word become spaces, A-Z become a-z.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class Found(NamedTuple):
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: str
    labels: str
    score: float
    binding: float | None
    phrases: list[tuple[str, int]]
    unknown: str


def binding_of(identifier: str) -> float:
    known = [v for k, v in BINDING.items() if identifier == k or identifier.startswith(f"{k}-")]
    return max(known, default=_DEFAULT_BINDING)


def to_postfix(symbols: list[str]) -> list[str] | None:
    """Shunting yard: operands in order, operators behind theirs; None if malformed."""
    output: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for s in symbols:
        if s == "(":
            if not operand_next:
                return None
            waiting.append(s)
        elif s == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif s in _RANK:
            if operand_next:
                return None
            while waiting and _RANK.get(waiting[-1], 0) >= _RANK[s]:
                output.append(waiting.pop())
            waiting.append(s)
            operand_next = True
        else:
            if not operand_next:
                return None
            output.append(s)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return output + waiting[::-1]


def evaluate(expression: str) -> tuple[list[str], float | None]:
    """``(identifiers, binding)``: a choice binds as its mildest side, a conjunction as
    its strictest, an exception halves. Reading stops where the expression ends."""
    symbols: list[str] = []
    open_brackets, expects = 0, True
    for s in (m.group().lower() for m in _SYMBOL.finditer(expression)):
        operand = s not in _RANK and s not in "()"
        if not expects and (operand or s == "("):
            break  # ordinary words follow on the line
        if s == ")" and not open_brackets:
            break
        open_brackets += (s == "(") - (s == ")")
        expects = s in _RANK or s == "("
        symbols.append(s.rstrip(".:") if operand else s)
    exceptions = {b for a, b in zip(symbols, symbols[1:]) if a == "with"}
    names = [s for s in symbols if s not in _RANK and s not in "()"]
    postfix = to_postfix(symbols)
    identifiers = sorted(set(names) - exceptions)
    if postfix is None:
        return identifiers, None
    stack: list[float] = []
    for s in postfix:
        if s in _RANK:
            right, left = stack.pop(), stack.pop()
            stack.append({"or": min(left, right), "and": max(left, right), "with": left / 2}[s])
        else:
            stack.append(binding_of(s))
    return identifiers, stack[0]


def automaton(phrases: Mapping[str, str]) -> ahocorasick.Automaton:
    """Over words between spaces, so that a phrase only matches whole words."""
    found = ahocorasick.Automaton()
    for phrase, label in phrases.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


class Scanner:
    def __init__(self, notices: Mapping[str, str] = NOTICE_PHRASES):
        self.automaton = automaton({**{p: "" for p in (TAG, *CUES)}, **notices, **BASE_PHRASES})

    def scan(self, text: str) -> Found:
        words = text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
        line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        base: list[int] = []
        base_labels: set[str] = set()
        labels: set[str] = set()
        phrases: list[tuple[str, int]] = []
        score, tagged = 0.0, False
        counted, at, cue_end = 0, 0, -1
        for end, (phrase, label) in self.automaton.iter(line):
            start = end - len(phrase) - 1
            # Matches come by their end; the words before a start are counted onwards or back.
            counted += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            if phrase == TAG:
                tagged = True
                continue
            if phrase in CUES:
                cue_end = counted + 2
                continue
            labels.add(label)
            phrases.append((phrase, counted))
            if phrase in BASE_PHRASES:
                base.append(counted)
                base_labels.add(label)
            score = max(score, 0.9 if 0 <= counted - cue_end <= 2 and cue_end >= 0 else 0.6)
        unknown: set[str] = set()
        bindings = [binding_of(label) for label in labels]
        if tagged:
            for match in _TAG_TEXT.finditer(text):
                identifiers, value = evaluate(match[1])
                known = set(filter(is_licence, identifiers))
                unknown.update(set(identifiers) - known)
                labels.update(known)
                if known:
                    score = 1.0
                if value is not None and len(known) == len(identifiers):
                    bindings.append(value)
        return Found(
            len(words), len(base), min(base, default=None), max(base, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, max(bindings, default=None),
            sorted(phrases, key=lambda p: p[1]), ",".join(sorted(unknown)),
        )


_SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, binding double, unknown string, phrases array<struct<phrase: string, word: bigint>>"
)
_PHRASES = pa.list_(pa.struct([("phrase", pa.string()), ("word", pa.int64())]))


def scan_licenses(docs: DataFrame, notices: Mapping[str, str] = NOTICE_PHRASES) -> DataFrame:
    """Per row: words, base finds, labels, ``score`` (1 a tag, 0.9 a notice behind a cue
    such as "licensed under", 0.6 a bare phrase, 0 nothing), ``binding`` (0 to 1),
    ``unknown`` operands of tags, and every phrase with the word it starts at."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            found = [scanner.scan(t) for t in texts_of(batch)]
            kinds = {name: pa.int64() for name in Found._fields[:4]} | {"base_labels": pa.string(), "labels": pa.string()}
            kinds |= {"score": pa.float64(), "binding": pa.float64(), "unknown": pa.string()}
            columns = {name: pa.array([getattr(f, name) for f in found], kind) for name, kind in kinds.items()}
            phrases = pa.array([[{"phrase": p, "word": w} for p, w in f.phrases] for f in found], _PHRASES)
            yield batch_of(doc_id=batch.column("doc_id"), **columns, phrases=phrases)

    return map_batches(docs, ["doc_id", "text"], task, _SCHEMA)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("phrases")


QUERIES = {"op7_license_scan": op7_license_scan}
SQL: dict[str, str] = {}
