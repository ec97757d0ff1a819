"""HTML extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, runs of text without a block element inside, with the
tags and class words of their ancestors. The field weighs features of each block
(ancestors, length, links, punctuation, place) and the transitions between neighbours;
Viterbi decoding picks the best labelling of the whole page, and the blocks labelled
as main text are joined.

It is trained by maximum likelihood on labelled pages: ``SHIPPED`` pages made here, and at
most ``SAMPLE`` pages of the input (those with the smallest hash of their id; the only
bound) whose semantic elements label their blocks. Of both come variants in which the
article lies in other common containers, plain ones among them, and menus, notices,
forms, adverts and reader comments are put in. So a corpus without one semantic element
is read too, and an input without pages trains on the pages made here.

Every page is then read whole, one by one, without a shuffle. Null and empty pages give
empty text; markup that is cut off or not closed is read as browsers do. Repeated rows give
repeated results; of rows with one page_id the smallest html trains. Between equally likely
labellings a block is not main text. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import batch_of, map_batches, table, texts_of

#: Pages of the input that give labelled blocks, at most.
SAMPLE = 300
#: Labelled pages made here, which are always there.
SHIPPED = 60
VARIANTS = 4

# HTML elements by their role.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr input".split()
)
_HIDDEN = set("head script style template noscript svg iframe object canvas math audio video select textarea".split())
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
_CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<!--|<[!?][^>]*>|</?[a-zA-Z][^>]*>")
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")


class Block(NamedTuple):
    text: str
    tags: tuple[str, ...]  # ancestors, outermost first
    names: frozenset[str]  # words of their class, id and role
    linked: float  # share of the text in links
    inner: frozenset[str] = frozenset()  # those of the innermost ancestor that has any


def blocks_of(page: str) -> list[Block]:
    found: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    parts: list[str] = []
    linked = links = hidden = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                tags = tuple(t for t, _ in stack if t not in _INLINE)
                names = frozenset().union(*(n for _, n in stack))
                inner = next((n for _, n in reversed(stack) if n), frozenset())
                found.append(Block(text, tags, names, min(1.0, linked / max(1, len(text))), inner))
            parts.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal links, hidden
        for tag, _ in stack[to:]:
            links -= tag == "a"
            hidden -= tag in _HIDDEN
        del stack[to:]

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        stop = m.start() if m else size
        text = page[at:stop]
        if not m and (cut := re.search(r"<[/!?a-zA-Z][^<]*$", text)):
            text = text[: cut.start()]  # a tag that the page ends in
        if text and not hidden:
            parts.append(text)
            if links:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        if not m[2]:
            continue
        closing, tag = m[1], m[2].lower()
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag in _CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] not in _INLINE:
                    break
        elif tag in _SAME:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _SAME[tag]:
                    pop(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        if tag in _VOID or m[3].endswith("/") and tag not in _CLOSES_P:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "body":
            pop(0)
        names = frozenset(w for g in _CLASS.findall(m[3]) for w in _WORD.findall("".join(g).lower())) if m[3] else frozenset()
        stack.append((tag, names))
        links += tag == "a"
        hidden += tag in _HIDDEN
    flush()
    return found


def features(blocks: Sequence[Block]) -> list[list[str]]:
    """Names of the features that each block has."""
    shared: dict[tuple, list[str]] = {}
    made = []
    for k, b in enumerate(blocks):
        path = shared.get((b.tags, b.names, b.inner))
        if path is None:
            path = [f"in:{t}" for t in set(b.tags)] + [f"name:{n}" for n in b.names]
            path += [f"inner:{n}" for n in b.inner]
            path.append(f"leaf:{b.tags[-1] if b.tags else ''}")
            path += [f"under:{a}>{c}" for a, c in zip(b.tags[-3:], b.tags[-2:])]
            shared[(b.tags, b.names, b.inner)] = path
        text = b.text
        made.append([
            *path,
            f"length:{len(text).bit_length()}",
            f"linked:{int(b.linked * 4)}",
            f"commas:{min(4, text.count(','))}",
            "stops" if text[-1] in ".!?\"'" else "runs on",
            f"place:{4 * k // len(blocks)}",
            "first" if k == 0 else "inner",
            "sign" if "©" in text[:40] else "plain",
        ])
    return made


# Words of class, id and role, and elements, that mark what is not the article.
_OTHER_NAMES = frozenset(
    "ad ads advert advertisement adverts sponsored promo promotion banner cookie cookies consent notice alert popup modal "
    "sidebar widget related recommended share social sharing comment comments commentlist respond reply replies "
    "discussion nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead topbar login signup "
    "subscribe newsletter search form tags toc skip copyright legal disclaimer".split()
)
_OTHER_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog", "button"}
_CONTAINERS: list[tuple[tuple[str, ...], tuple[str, ...]]] = [
    (("article",), ()), (("main",), ()), (("main", "article"), ()), (("div",), ("content",)), (("div",), ("post",)),
    (("div",), ("post", "content")), (("div",), ("entry", "content")), (("div",), ("article", "body")),
    (("div",), ("story",)), (("section",), ("post",)), (("div",), ("main",)), (("div", "div"), ("page", "text")),
    (("td",), ("content",)), (("article", "section"), ()), (("article", "div"), ("body",)), (("main", "div"), ("content",)),
    (("div",), ()), (("div", "div"), ()), (("td",), ()), (("section",), ()), ((), ()),
]
_OTHERS: list[tuple[tuple[str, ...], tuple[str, ...], bool]] = [  # the last: texts as long as the article's
    (("nav", "ul", "li"), (), False), (("div", "ul", "li"), ("menu",), False), (("header",), ("site", "header"), False),
    (("div",), ("masthead",), False), (("footer",), (), False), (("div",), ("footer",), False),
    (("aside",), (), True), (("aside", "div"), ("sidebar", "widget"), True), (("div",), ("sidebar",), True),
    (("div",), ("ad",), True), (("div",), ("advert",), True), (("div",), ("sponsored", "promo"), True),
    (("div",), ("cookie", "notice"), True), (("div",), ("cookie", "banner"), True), (("div",), ("consent", "popup"), True),
    (("div",), ("alert", "notice"), True), (("form",), (), False), (("form", "label"), ("newsletter", "signup"), False),
    (("form", "p"), ("search",), False), (("div",), ("comments",), True), (("section", "div", "p"), ("comments", "comment"), True),
    (("ol", "li", "p"), ("commentlist", "comment"), True), (("div", "p"), ("comment", "reply"), True),
    (("section", "p"), ("discussion", "respond"), True), (("div", "ul", "li"), ("related", "recommended"), False),
    (("div",), ("share", "social"), False), (("ol", "li"), ("breadcrumb",), False), (("div",), ("pagination", "pager"), False),
    (("nav",), ("breadcrumbs", "navigation"), False), (("section",), ("newsletter", "subscribe"), True),
    (("ul", "li"), (), False), (("div",), (), False), (("div", "div"), (), False), (("td",), (), False),
]


def shipped_pages(count: int = SHIPPED, seed: int = 17) -> Iterator[list[Block]]:
    """Pages with an article element, of sentences in made-up words and several alphabets."""
    r = random.Random(seed)
    letters = ["aeioulnrstdhc", "aeiouäöüßschnrt", "оеаинтсрвлкмд", "éèaeiouçlnrstd"]

    def words(least: int, most: int, of: str) -> str:
        made = ["".join(r.choices(of, k=r.randint(1, 9))) for _ in range(r.randint(least, most))]
        return " ".join(w + r.choice(["", "", "", "", "", ","]) for w in made).rstrip(",")

    def block(text: str, *tags: str, linked: float = 0.0) -> Block:
        return Block(text, ("html", "body", *tags), frozenset(), linked)

    for _ in range(count):
        of = r.choice(letters)
        yield [
            *(block(words(1, 2, of), "nav", "ul", "li", linked=1.0) for _ in range(r.randint(3, 8))),
            block(words(3, 9, of).capitalize() + r.choice(["", "", "."]), "article", "h1"),
            *(
                block(" ".join(words(4, 14, of).capitalize() + r.choice(".....!?") for _ in range(r.randint(1, 8))), "article", "p")
                for _ in range(r.randint(1, 20))
            ),
            block(f"© {words(2, 8, of)}.", "footer"),
        ]


def semantic_labels(blocks: Sequence[Block]) -> list[bool] | None:
    """Labels by semantic elements; None for a page without an article element."""
    if not any({"article", "main"} & set(b.tags) for b in blocks):
        return None
    return [
        bool({"article", "main"} & set(b.tags)) and not _OTHER_TAGS & set(b.tags) and not _OTHER_NAMES & b.names
        for b in blocks
    ]


def labelled_pages(
    pages: Iterable[Sequence[Block]], variants: int = VARIANTS, seed: int = 3
) -> Iterator[tuple[list[Block], list[bool]]]:
    """Pages with semantic labels, and variants of each with other containers around the
    article and other parts beside and inside it."""
    r = random.Random(seed)
    pool: list[str] = []
    for blocks in pages:
        labels = semantic_labels(blocks)
        if labels is None:
            continue
        yield list(blocks), labels
        article = [b for b, good in zip(blocks, labels) if good]
        for _ in range(variants):
            tags, names = r.choice(_CONTAINERS)
            outer = r.choice([("html", "body"), ("html", "body", "div"), ("html", "body", "div", "div"), ("body",)])

            def other(inside: bool) -> list[Block]:
                add, add_names, long = r.choice(_OTHERS)
                path = (*outer, *tags, *add) if inside else (*outer, *add)
                if long and path[-1] != "p" and r.random() < 0.7:
                    path = (*path, "p")
                held = frozenset(add_names) | (frozenset(names) if inside else frozenset())
                made = []
                for _ in range(r.randint(1, 4)):
                    text = r.choice(pool) if pool else "more"
                    if not long or r.random() < 0.3:
                        text = " ".join(text.split()[: r.randint(1, 6)])
                    inner = frozenset(add_names) or (frozenset(names) if inside else frozenset())
                    made.append(Block(text or "more", path, held, r.choice([0.0, 0.0, 1.0]), inner))
                return made

            made: list[tuple[Block, bool]] = []
            for _ in range(r.randint(1, 3)):
                made += [(b, False) for b in other(False)]
            for k, b in enumerate(article):
                leaf = b.tags[-1:] if b.tags[-1:] not in (("article",), ("main",), ("body",)) else ("p",)
                if r.random() < 0.08:
                    leaf = r.choice([("blockquote", "p"), ("ul", "li"), ("h2",), ("pre",), ("table", "tr", "td"), ("h3",)])
                made.append((Block(b.text, (*outer, *tags, *leaf), frozenset(names), b.linked, frozenset(names)), True))
                if k and r.random() < 0.12:
                    made += [(x, False) for x in other(True)]
            for _ in range(r.randint(1, 3)):
                made += [(b, False) for b in other(r.random() < 0.5)]
            yield [b for b, _ in made], [good for _, good in made]
        pool = (pool + [b.text for b in article])[-400:]


class ChainField:
    """Two labels; weights of the features for label 1, of the transitions and of the start."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weights = np.zeros(0)
        self.moves = np.zeros((2, 2))
        self.start = np.zeros(2)

    def _rows(self, blocks: Sequence[Block]) -> list[list[int]]:
        get = self.index.get
        return [[i for f in names if (i := get(f)) is not None] for names in features(blocks)]

    def fit(self, pages: Iterable[tuple[Sequence[Block], Sequence[bool]]], epochs: int = 8, rate: float = 0.3,
            decay: float = 1e-4, size: int = 32, seed: int = 1) -> ChainField:
        """Maximum likelihood by forward-backward and AdaGrad over batches of pages."""
        data = [(features(b), np.array(y, dtype=np.int64)) for b, y in pages if len(b)]
        for names, _ in data:
            for row in names:
                for f in row:
                    self.index.setdefault(f, len(self.index))
        sequences = [([[self.index[f] for f in row] for row in names], y) for names, y in data]
        self.weights = np.zeros(len(self.index))
        seen, seen_moves, seen_start = (np.full(x.shape, 1e-6) for x in (self.weights, self.moves, self.start))
        r = np.random.default_rng(seed)
        for _ in range(epochs):
            for chosen in np.array_split(r.permutation(len(sequences)), max(1, len(sequences) // size)):
                slope, slope_moves, slope_start = decay * self.weights, np.zeros((2, 2)), np.zeros(2)
                for i in chosen:
                    rows, y = sequences[i]
                    p, pairs = self._marginals(np.array([self.weights[x].sum() for x in rows]))
                    error = p[:, 1] - y
                    flat = np.concatenate([np.asarray(x) for x in rows])
                    np.add.at(slope, flat, np.repeat(error, [len(x) for x in rows]) / len(chosen))
                    slope_moves += pairs / len(chosen)
                    np.add.at(slope_moves, (y[:-1], y[1:]), -1.0 / len(chosen))
                    slope_start += p[0] / len(chosen)
                    slope_start[y[0]] -= 1.0 / len(chosen)
                for x, g, s in ((self.weights, slope, seen), (self.moves, slope_moves, seen_moves),
                                (self.start, slope_start, seen_start)):
                    s += g * g
                    x -= rate * g / np.sqrt(s)
        return self

    def _marginals(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each label at each place, and sums of those of neighbouring pairs."""
        n = len(gains)
        own = np.stack([np.zeros(n), gains], axis=1)
        ahead, behind = np.empty((n, 2)), np.zeros((n, 2))
        ahead[0] = self.start + own[0]
        for t in range(1, n):
            ahead[t] = own[t] + np.logaddexp(ahead[t - 1, 0] + self.moves[0], ahead[t - 1, 1] + self.moves[1])
        for t in range(n - 2, -1, -1):
            following = own[t + 1] + behind[t + 1]
            behind[t] = np.logaddexp(self.moves[:, 0] + following[0], self.moves[:, 1] + following[1])
        total = np.logaddexp(ahead[-1, 0], ahead[-1, 1])
        pairs = np.zeros((2, 2))
        if n > 1:
            joint = ahead[:-1, :, None] + self.moves[None] + (own[1:] + behind[1:])[:, None, :] - total
            pairs = np.exp(joint).sum(axis=0)
        return np.exp(ahead + behind - total), pairs

    def label(self, blocks: Sequence[Block]) -> list[bool]:
        """Viterbi: the likeliest labels of all blocks together."""
        if not blocks:
            return []
        weights = self.weights.tolist()
        gains = [sum(weights[i] for i in row) for row in self._rows(blocks)]
        (m00, m01), (m10, m11) = self.moves.tolist()
        zero, one = float(self.start[0]), float(self.start[1]) + gains[0]
        came: list[tuple[bool, bool]] = []
        for gain in gains[1:]:
            a, b, c, d = zero + m00, one + m10, zero + m01, one + m11
            came.append((b > a, d > c))
            zero, one = max(a, b), max(c, d) + gain
        labels = [one > zero]
        for step in reversed(came):
            labels.append(step[labels[-1]])
        return labels[::-1]


def main_text(page: str, field: ChainField) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, good in zip(blocks, field.label(blocks)) if good)


def train(pages: DataFrame, sample: int = SAMPLE) -> ChainField:
    """Fitted on the shipped pages and on at most ``sample`` pages of the table."""
    ids = pages.select("page_id").filter("page_id IS NOT NULL").distinct()
    ids = [r.page_id for r in ids.orderBy(F.xxhash64("page_id"), "page_id").limit(sample).collect()]
    chosen = pages.filter(F.col("page_id").isin(ids)) if ids else pages.limit(0)
    got = sorted((r.page_id, r.html or "") for r in chosen.groupBy("page_id").agg(F.min("html").alias("html")).collect())
    return ChainField().fit(labelled_pages([*shipped_pages(), *(blocks_of(page) for _, page in got)]))


def extract(pages: DataFrame, field: ChainField) -> DataFrame:
    """``page_id, url, text``."""
    shared = pages.sparkSession.sparkContext.broadcast(field)  # as many weights as kinds of features

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, shared.value) for page in texts_of(batch, "html")]
            yield batch_of(
                page_id=batch.column("page_id"), url=batch.column("url"), text=pa.array(texts, pa.string())
            )

    return map_batches(pages, ["page_id", "url", "html"], task, "page_id bigint, url string, text string")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages)).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op5_main_text": op5_main_text}
SQL: dict[str, str] = {}
