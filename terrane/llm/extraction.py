"""Main-text extraction (operator 4): maximum-scoring subsequence of a page's words and tags.

A page becomes a sequence of tokens. Words score positive and tags negative; a linear scan finds the contiguous run
with the largest sum. The scores come from labelled pages: every page with exactly one <article> (or else one <main>)
labels its own tokens as inside or outside. Counts of both per token signature are summed over all such pages in
Spark. A signature is hashed to one of ``SLOTS`` slots, so the weight table that tasks get has a fixed size.

Where most of the run lies in <article> or <main>, it takes whole all of these of which it holds half. Then blocks that belong to no article (menus, page headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) are left out of it, character
references are decoded, white space inside a block becomes one space and blocks are joined by one space.

Defined results: a null or empty page, or one without words, gives an empty text; unclosed, overlapping or truncated
markup ends with its parent; equal rows give equal results; extra columns are ignored; with no labelled page at all
the weights are those of zero counts.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import by_value, texts

by_value(__name__)

SLOTS = 1 << 14

# Comments and declarations, elements whose content is no markup, tags, text.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe|template|xmp|svg|math)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags inside a block of text; every other tag begins a new block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that are no part of an article.
OUTSIDE = frozenset("head nav footer aside form button select option menu dialog object audio video canvas "
                    "fieldset legend label input".split())
#: Names (class, id, role), or their parts, of blocks that are no part of an article.
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices outbrain overlay pager pagination popup promo promoted promotion recommended related replies "
    "reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar topbar "
    "widget widgets contentinfo complementary hidden".split())
#: First parts of names that tell about an article's own container, whatever follows.
CONTAINERS = frozenset("with has no entry post article content elementor hentry main".split())
#: Tags that close an open <p>.
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "nav ol p pre section table ul".split())


def slot(signature: str) -> int:
    return zlib.crc32(signature.encode()) % SLOTS


def outside_name(attrs: str) -> bool:
    for groups in NAMES.findall(attrs):
        for name in "".join(groups).lower().split():
            parts = re.split(r"[-_]+", name)
            if name in OUTSIDE_NAMES or parts[0] not in CONTAINERS and not OUTSIDE_NAMES.isdisjoint(parts):
                return True
    return False


class Page:
    """Tokens of a page in order.

    ``kind`` is 0 for words (text pieces) and 1 for tags; ``count`` the words of a piece; ``slots`` the hashed
    signature; ``pieces`` the raw text pieces; ``block`` the block number of a piece; ``out`` marks pieces inside
    an element that is no part of an article; ``home`` the innermost <article> or <main> open at a token (0: none).
    """

    def __init__(self, source: str):
        self.count: list[int] = []
        self.slots: list[int] = []
        self.pieces: list[str | None] = []
        self.block: list[int] = []
        self.out: list[bool] = []
        self.home: list[int] = []
        self.homes: Counter[str] = Counter()
        self.home_tags: list[str] = [""]
        self.home_parents: list[int] = [-1]
        self._read(source)

    def _add(self, signature: int, piece: str | None, words: int, block: int, out: bool, home: int) -> None:
        self.count.append(words)
        self.slots.append(signature)
        self.pieces.append(piece)
        self.block.append(block)
        self.out.append(out)
        self.home.append(home)

    def _read(self, source: str) -> None:
        # open elements: tag, signature of the words inside, whether inside a block that is no part of an article, home
        top = ("", slot("w@"), False, 0)
        stack = [top]
        # where each open tag stands in the stack, and for each element the open <p> that it may be closed with (0: none)
        places: dict[str, list[int]] = {}
        paragraph = [0]

        def cut(depth: int) -> None:
            for name, *_ in stack[depth:]:
                places[name].pop()
            del stack[depth:], paragraph[depth:]

        known: dict[tuple[str, str], tuple[int, int, bool]] = {}
        block = 0
        for m in TOKEN.finditer(source):
            text, tag = m["text"], m["tag"]
            if text is not None:
                _, words_at, out, home = stack[-1]
                self._add(words_at, text, len(text.split()), block, out, home)
                continue
            if tag is None:
                continue
            tag = tag.lower()
            if tag not in INLINE:
                block += 1
            if m["close"]:
                if places.get(tag):
                    cut(places[tag][-1])
                self._add(slot("/" + tag), None, 0, block, stack[-1][2], stack[-1][3])
                continue
            if tag in CLOSES_P and paragraph[-1]:  # an open <p> in this container ends here, with what is open inside it
                cut(paragraph[-1])
            attrs = m["attrs"]
            found = known.get((tag, attrs))
            if found is None:
                names = sorted({n.lower() for g in NAMES.findall(attrs) for n in "".join(g).split()})
                signature = ".".join([tag, *names])
                found = known[tag, attrs] = (slot(signature), slot("w@" + signature), outside_name(attrs))
            _, parent_words, out, home = stack[-1]
            tag_at, words_at, named_out = found
            container = tag in ("article", "main", "body", "html")
            self._add(tag_at, None, 0, block, out, home)
            if tag in VOID or m["attrs"].rstrip().endswith("/"):
                continue
            if tag in ("article", "main"):
                self.homes[tag] += 1
                self.home_tags.append(tag)
                self.home_parents.append(home)
                home = len(self.home_tags) - 1
            # blocks of text score with their container; a page header counts as outside, an article's own does not
            plain = tag in INLINE - {"a"} or tag in ("p", "br", "h1", "h2", "h3", "h4", "h5", "h6")
            stack.append((tag, parent_words if plain else words_at,
                          out or not container and (tag in OUTSIDE or named_out or tag == "header" and not home), home))
            places.setdefault(tag, []).append(len(stack) - 1)
            paragraph.append(len(stack) - 1 if tag == "p" else paragraph[-1] if tag in INLINE else 0)

    def labelled(self) -> list[bool] | None:
        """Inside or outside for each token, if the page has exactly one <article>, or none and one <main>."""
        tag = "article" if self.homes["article"] else "main"
        if self.homes[tag] != 1:
            return None
        own = self.home_tags.index(tag)
        return [h >= own if tag == "main" else h == own for h in self.home]


def weights_of(inside: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of words (positive) and tags (negative) per slot, from token counts inside and outside main texts."""
    share = (inside + 1) / (inside + outside + 2)
    return 0.001 + share ** 2, -(0.2 + 12 * (1 - share) ** 2)


def best_run(scores: np.ndarray) -> tuple[int, int]:
    """[start, end) of the first contiguous run with the largest sum; empty if no score is positive."""
    if not len(scores) or scores.max() <= 0:
        return 0, 0
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    return int(np.argmin(sums[:end])), end


def main_text(page: Page, word_weight: np.ndarray, tag_weight: np.ndarray) -> str:
    slots, count = np.array(page.slots, np.int64), np.array(page.count, np.int64)
    is_word = np.array([p is not None for p in page.pieces], bool)
    scores = np.where(is_word, word_weight[slots] * count, tag_weight[slots]) if len(slots) else np.zeros(0)
    scores[np.array(page.out, bool) & is_word] = 0  # words of blocks that never are main text
    start, end = best_run(scores)
    if end <= start:
        return ""
    held = Counter()
    for k in range(start, end):
        held[page.home[k]] += int(count[k])
    if held.most_common(1)[0][0]:  # all articles of which the run holds half, whole, with what lies inside them
        total = Counter()
        for h, n in zip(page.home, page.count, strict=True):
            total[h] += n
        homes = {h for h, n in held.items() if h and 2 * n >= total[h] > 0} | {held.most_common(1)[0][0]}
        for h, parent in enumerate(page.home_parents):
            if parent in homes:
                homes.add(h)
        outer = [k for k, h in enumerate(page.home) if h in homes]
        start, end = min(start, outer[0]), max(end, outer[-1] + 1)
        keep = lambda k: page.home[k] in homes
    else:  # the blocks at both ends belong to the run as a whole
        keep = lambda k: True
        while start > 0 and page.block[start - 1] == page.block[start]:
            start -= 1
        while end < len(page.block) and page.block[end] == page.block[end - 1]:
            end += 1
    blocks: dict[int, list[str]] = {}
    for k in range(start, end):
        if page.pieces[k] is not None and not page.out[k] and keep(k):
            blocks.setdefault(page.block[k], []).append(page.pieces[k])
    parts = (" ".join(html_lib.unescape("".join(own)).split()) for own in blocks.values())
    return " ".join(p for p in parts if p)


def token_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """slot, inside, outside: tokens of all labelled pages by hashed signature (words weighted by their number)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for source in texts(batch.column(0)):
                page = Page(source)
                label = page.labelled()
                if label is not None:
                    own = np.array(label, bool)
                    at, n = np.array(page.slots, np.int64), np.array(page.count, np.int64)
                    n[[p is None for p in page.pieces]] = 1
                    np.add.at(inside, at[own], n[own])
                    np.add.at(outside, at[~own], n[~own])
        used = np.flatnonzero(inside + outside)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(inside[used]), pa.array(outside[used])],
                                         names=["slot", "inside", "outside"])

    counted = pages.select(html_col).mapInArrow(count, "slot long, inside long, outside long")
    return counted.groupBy("slot").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def learn_weights(pages: DataFrame, html_col: str = "html") -> tuple[np.ndarray, np.ndarray]:
    """Word and tag weights from all labelled pages. At most SLOTS rows reach the driver."""
    inside, outside = np.zeros(SLOTS), np.zeros(SLOTS)
    for row in token_counts(pages, html_col).collect():
        inside[row["slot"]], outside[row["slot"]] = row["inside"], row["outside"]
    return weights_of(inside, outside)


def extract_main_text(pages: DataFrame, weights: tuple[np.ndarray, np.ndarray], id_col: str = "page_id",
                      html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Main text of every page: id, the kept columns, text, n_chars."""
    columns = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, *keep)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(Page(source), *weights) for source in texts(batch.column(len(keep) + 1))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())],
                names=[id_col, *keep, "text", "n_chars"])

    return pages.select(id_col, *keep, html_col).mapInArrow(
        extract, ", ".join([*columns, "text string", "n_chars long"]))
