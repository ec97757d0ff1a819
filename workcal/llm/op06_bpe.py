"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts every text into chunks whose borders depend on
the content around them, so that passages shared by documents give the same chunks
wherever they stand. A chunk is encoded once and its tokens are reused for every
later document that has it. A cut may fall inside a word; no join is encoded again and
compared until it agrees, but the cuts are moved to ASCII white space instead, and a
piece is put together from the tokens of its words. For a tokenizer that splits at white
space and drops it these are the tokens of the whole text encoded at once. Any other
tokenizer is refused with an error.

The store of chunks lives in the Python worker, which serves many tasks, and is
bounded in bytes. No text is shuffled to be encoded: each chunk is encoded at most
once per worker and filling of its store, which on large inputs costs less than
moving chunks and tokens to meet each other would. Words are remembered in the same
bounded way, long ones in place of several: of chunks and words those used since the
last filling stay. Ids are stored packed, four bytes each, as the stores of all workers
of an executor stay in its memory while other stages run. A lost executor only loses
what is stored; rows do not depend on it.

New words are encoded together. Where the tokenizer's file is a byte-level vocabulary with
an end-of-word sign, merges in the order of their ids, and the normalizer and splitting
pattern known here, ``RankedWords`` merges the pairs of plain words by rank, which gives the
library's ids (compared on its own tokens at the start); all other words, and all words of
other files, go to the library.

Null texts count as empty and have no tokens. Repeated rows give repeated results, an empty
table none. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .texts import SPACES, batch_of, map_batches, table, texts_of

#: A cut comes where this many bits of the rolling hash are zero: every 512 bytes on average.
CUT_BITS = 9
#: Bytes of chunks and their ids in each half of a worker's store, and number of words that each
#: half remembers; a word counts once more for every ``LONG_WORD`` bytes of itself and its ids.
STORE_BYTES = 16_000_000
STORE_WORDS = 200_000
LONG_WORD = 64

_GEAR = np.random.default_rng(2024).integers(0, 2**32, size=256, dtype=np.uint32)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def cuts(data: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """Places of ``data`` before which a chunk ends: the hash of the 16 bytes before them
    has ``bits`` zeros. Doubling makes the rolling hash in four steps for all places."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        if len(h) > step:
            shifted = h.copy()
            shifted[step:] += h[:-step] << np.uint32(step)
            h = shifted
    return np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1


def pieces(data: bytes, bits: int = CUT_BITS) -> Iterator[tuple[bytes, bool]]:
    """``(piece, shared)`` in order: chunk bodies to be stored, and the repaired joins
    between them. Each ends at white space; a join grows over chunks without any."""
    view = np.frombuffer(data, dtype=np.uint8)
    spaces = np.flatnonzero(_IS_SPACE[view])
    borders = cuts(view, bits)
    borders = borders[borders < len(data)]
    if not len(spaces) or not len(borders):
        yield data, len(data) >= 1 << (bits - 1)
        return
    after = np.searchsorted(spaces, borders)  # the first white space at or after each cut
    start = 0
    for k in after.tolist():
        left = int(spaces[k - 1]) if k else -1
        right = int(spaces[k]) if k < len(spaces) else len(data)
        if left >= start:
            yield data[start:left], True
            start = left
        if right > start:
            yield data[start:right], False
            start = right
    if start < len(data):
        yield data[start:], True


class Generations(dict):
    """A bounded memory: when the young half is full it becomes the old half."""

    def __init__(self, bound: int, size: Callable[[bytes, bytes], int]):
        super().__init__()
        self.bound, self.size, self.used, self.old = bound, size, 0, {}

    def recall(self, key):
        found = self.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.remember(key, found)
        return found

    def remember(self, key, value) -> None:
        size = self.size(key, value)
        if self.used + size > self.bound:
            self.old, self.used = dict(self), 0
            self.clear()
        self[key] = value
        self.used += size


def require_dropped_space(tokenizer: Tokenizer) -> None:
    """Raises unless the tokenizer splits at ASCII white space and gives it no tokens."""
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    for space in map(chr, SPACES):
        if ids(f"{space}{space}a{space}{space}b{space}") != ids("a") + ids("b"):
            raise ValueError(f"the tokenizer does not drop white space ({space!r}); its texts cannot be encoded by words")


# The normalizer, the pattern and the sign of the files that merge by rank.
_NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"
#: Words of these letters only are the same for all normalizers in question but for their case.
_PLAIN = regex.compile("[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017e]+")


def _byte_of() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands."""
    printable = [*range(ord("!"), 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(printable))
    return dict(zip(map(chr, (*printable, *range(0x100, 0x100 + len(hidden)))), (*printable, *hidden)))


class RankedWords:
    """Ids of plain words by merging pairs by rank. A zero byte behind each part stands for
    the end-of-word sign; its pairs have the lowest ranks, so they are merged first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.line = ranks[b"\n"]
        self.split = regex.compile(_SPLIT)
        self.encoding = tiktoken.Encoding(
            "words", pat_str=r"[^\x00\n]+\x00|\n", mergeable_ranks=ranks, special_tokens={}
        )

    @classmethod
    def of(cls, spec: dict) -> RankedWords | None:
        """None for a file for which merging by rank is not known to say the same."""
        model, split = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        same = model.get("type") == "BPE" and model.get("end_of_word_suffix") == _WORD_END
        same &= not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "continuing_subword_prefix"))
        same &= (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS and len(split) == 2
        same &= split[0].get("pattern") == {"Regex": _SPLIT} and split[0].get("behavior") == "Removed" and bool(split[0].get("invert"))
        same &= split[-1].get("type") == "ByteLevel" and not split[-1].get("use_regex") and not split[-1].get("add_prefix_space")
        if not same:
            return None
        vocabulary, byte_of = model["vocab"], _byte_of()
        added = {a["content"] for a in spec["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merged = [vocabulary.get(a + b, -1) for a, b in pairs]
        single = [vocabulary.get(c + end, -1) for end in ("", _WORD_END) for c in byte_of]
        ids = sorted(n for w, n in vocabulary.items() if w not in added)
        if merged != sorted(merged) or sorted(single) != ids[:512] or sorted(single + merged) != ids:
            return None

        def key(word: str) -> bytes:
            end = word.endswith(_WORD_END) and word not in byte_of
            return bytes(byte_of[c] for c in (word[: -len(_WORD_END)] if end else word)) + (b"\0" if end else b"")

        ranks = {key(w): n for w, n in vocabulary.items() if w not in added and key(w) != b"\0"}
        ranks[b"\0"] = vocabulary[next(c for c, b in byte_of.items() if b == 0)]
        zero = any(b"\0" in k[:-1] for k in ranks if len(k) > 2)
        return None if zero or len(ranks) != len(ids) else cls(ranks)

    def ids(self, words: list[str]) -> list[tuple[int, ...]]:
        """Of words of ``_PLAIN`` letters, without a special token."""
        if not words:
            return []
        marked = self.split.sub("\\g<0>\0", "\n".join(words).lower())
        found = self.encoding.encode_ordinary(marked)
        ends = np.flatnonzero(np.array(found, dtype=np.int64) == self.line).tolist()
        return [tuple(found[a:b]) for a, b in zip((0, *(e + 1 for e in ends)), (*ends, len(found)))]


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        require_dropped_space(self.tokenizer)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.ranked = RankedWords.of(spec)
        if self.ranked is not None:
            known = [w for t in list(spec["model"]["vocab"])[::20] if _PLAIN.fullmatch(w := t.removesuffix(_WORD_END)) and not self._special(w)]
            if self.ranked.ids(known) != self._by_library(known):
                self.ranked = None
        # Without a decoder the library joins the tokens by spaces.
        self.tokens = None
        if spec.get("decoder") is None:
            self.tokens = {n: t for t, n in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.words = Generations(STORE_WORDS, lambda word, ids: 1 + (len(word) + len(ids)) // LONG_WORD)
        self.chunks = Generations(STORE_BYTES, lambda piece, ids: len(piece) + len(ids) + 40)
        self.reused = self.encoded = 0

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        return [np.frombuffer(x, dtype=np.int32).tolist() for x in self.packed_all(texts)]

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed. What no chunk in store covers is encoded for all texts together."""
        plans: list[list[bytes]] = []
        done: dict[bytes, bytes] = {}
        wanted: set[bytes] = set()
        for text in texts:
            plan: list[bytes] = []
            for piece, shared in pieces(text.encode("utf-8", "surrogatepass")):
                known = self.chunks.recall(piece) if shared else None
                if known is not None or piece in wanted:
                    self.reused += 1
                elif shared:
                    self.encoded += 1
                if known is None:
                    wanted.add(piece)
                else:
                    done[piece] = known
                plan.append(piece)
            plans.append(plan)
        split = {piece: piece.split() for piece in wanted}
        ids_of = self._ids_of(set().union(*split.values()))
        for piece, words in split.items():
            done[piece] = ids = b"".join(map(ids_of.__getitem__, words))
            if len(piece) >= 64:
                self.chunks.remember(piece, ids)
        return [b"".join(map(done.__getitem__, plan)) for plan in plans]

    def _ids_of(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The packed ids of each word; those that are not remembered are encoded together."""
        found = {w: ids for w in words if (ids := self.words.recall(w)) is not None}
        new = list(words - found.keys())
        texts = [w.decode("utf-8", "surrogatepass") for w in new]
        quick = [self.ranked is not None and _PLAIN.fullmatch(t) is not None and not self._special(t) for t in texts]
        ranked = iter(self.ranked.ids([t for t, q in zip(texts, quick) if q]) if self.ranked else ())
        other = iter(self._by_library([t for t, q in zip(texts, quick) if not q]))
        for word, q in zip(new, quick):
            found[word] = ids = array("i", next(ranked if q else other)).tobytes()
            self.words.remember(word, ids)
        return found

    def _special(self, text: str) -> bool:
        return any(x in text for x in self.special)

    def _by_library(self, texts: list[str]) -> list[tuple[int, ...]]:
        return [tuple(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def decode_all(self, ids: list[list[int]]) -> list[str]:
        if self.tokens is None:
            return self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [" ".join(map(self.tokens.__getitem__, x)) for x in ids]


@lru_cache(maxsize=2)
def _worker_encoder(path: str) -> ChunkEncoder:
    """One per Python worker, kept from task to task."""
    return ChunkEncoder(path)


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per row ``ids`` and ``decoded``, the text that they decode to."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                packed = encoder.packed_all(texts_of(part))
                flat = np.frombuffer(b"".join(packed), dtype=np.int32)
                ends = np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32)
                ids = [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]
                yield batch_of(
                    doc_id=part.column("doc_id"), ids=pa.ListArray.from_arrays(ends, flat),
                    decoded=pa.array(encoder.decode_all(ids), pa.string()),
                )

    return map_batches(docs, ["doc_id", "text"], task, "doc_id bigint, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return digests(encode(table(spark, sf_dir, "documents"), path))


QUERIES = {"op6_bpe": op6_bpe}
SQL: dict[str, str] = {}
