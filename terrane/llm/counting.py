"""Edit-aware token counts (operator 2): per-document segment trees of pre-tokens, re-encoded only around edits.

A document's pre-tokens are grouped into leaves; a tree of sums over the leaves holds characters and token counts.
An edit re-splits the leaves that it touches, from a pre-token boundary at least ``CONTEXT`` characters before it up
to the first old leaf boundary that is a pre-token boundary again; only those pre-tokens are encoded anew and the
sums on the paths above are updated. The result equals encoding the edited text from scratch.

Edits are (start, end, replacement) in code points of the original text. They apply in order of (start, end); one
that begins before the end of an earlier one, or lies outside the text, is skipped and counted in ``n_skipped``.

Defined results: null texts are empty (0 tokens); null edits are none; a null replacement is empty; equal rows are
counted one by one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import by_value, texts, worker_state

by_value(__name__)

LEAF = 32
#: No pre-token that ends so far before a place looks at it: the longest contraction has three characters.
CONTEXT = 3
CACHE = 1_000_000


class PreTokenCounter:
    """Splits texts by a byte-pair vocabulary's pattern and counts the tokens of each pre-token (cached)."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("terrane", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, int] = {}

    def count(self, piece: str) -> int:
        got = self.cache.get(piece)
        if got is None:
            got = len(self.encoding.encode_ordinary(piece))
            if len(self.cache) < CACHE:
                self.cache[piece] = got
        return got


class SegmentTree:
    """Leaves of pre-tokens with sums of (characters, tokens) above them; the shape never changes, leaves may empty."""

    def __init__(self, text: str, counter: PreTokenCounter):
        self.counter = counter
        pieces = counter.split(text)
        self.reencoded = 0
        self.leaves = ["".join(pieces[i:i + LEAF]) for i in range(0, len(pieces), LEAF)] or [""]
        tokens = list(map(counter.count, pieces))
        self.chars = [list(map(len, self.leaves))]
        self.tokens = [[sum(tokens[i:i + LEAF]) for i in range(0, len(tokens), LEAF)] or [0]]
        for levels in (self.chars, self.tokens):
            while len(low := levels[-1]) > 1:
                levels.append([low[i] + (low[i + 1] if i + 1 < len(low) else 0) for i in range(0, len(low), 2)])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one beyond the end) and where the leaf begins."""
        node, begin = 0, 0
        for level in reversed(self.chars[:-1]):
            node *= 2
            if node + 1 < len(level) and at - begin >= level[node]:
                begin += level[node]
                node += 1
        return node, begin

    def set_leaf(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        for levels, value in ((self.chars, len(text)), (self.tokens, tokens)):
            change, node = value - levels[0][leaf], leaf
            for level in levels:
                level[node] += change
                node //= 2

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters [start, end) of the present text."""
        first, begin = self.find(max(0, start - CONTEXT))
        last, _ = self.find(end)
        last = max(first, last)
        region = "".join(self.leaves[first:last + 1])
        region = region[:start - begin] + replacement + region[end - begin:]
        while True:
            after = last + 1
            while after < len(self.leaves) and not self.leaves[after]:
                after += 1
            ahead = self.leaves[after] if after < len(self.leaves) else ""
            pieces, size = [], 0
            for piece in self.counter.split(region + ahead):
                if size >= len(region):
                    break
                pieces.append(piece)
                size += len(piece)
            if size == len(region):
                break
            region, last = region + ahead, after
        self.reencoded += len(pieces)
        self.set_leaf(first, region, sum(map(self.counter.count, pieces)))
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self.set_leaf(leaf, "", 0)

    @property
    def total(self) -> int:
        return self.tokens[-1][0]

    @property
    def text(self) -> str:
        return "".join(self.leaves)


def count_with_edits(docs: DataFrame, edits: Column, ranks_path: str, pattern: str,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts of every document before and after its edits.

    ``edits``: array of struct(start long, end long, replacement string). Returns doc_id, n_tokens, n_edits,
    n_skipped, n_tokens_edited, n_chars_edited, n_leaves, n_reencoded (pre-tokens encoded again for the edits).
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), edits.alias("edits"))
    names = ["n_tokens", "n_edits", "n_skipped", "n_tokens_edited", "n_chars_edited", "n_leaves", "n_reencoded"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(f"counter_{abs(hash((ranks_path, pattern)))}",
                               lambda: PreTokenCounter(ranks_path, pattern))
        for batch in batches:
            out = []
            for text, todo in zip(texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                tree = SegmentTree(text, counter)
                before, shift, reached, done = tree.total, 0, 0, 0
                usable = [e for e in todo or () if e and None not in (e["start"], e["end"])]
                for e in sorted(usable, key=lambda e: (e["start"], e["end"])):
                    if not reached <= e["start"] <= e["end"] <= len(text):
                        continue
                    new = e["replacement"] or ""
                    tree.edit(e["start"] + shift, e["end"] + shift, new)
                    shift += len(new) - (e["end"] - e["start"])
                    reached, done = e["end"], done + 1
                out.append((before, done, len(todo or ()) - done, tree.total, len(text) + shift, len(tree.leaves),
                            tree.reencoded))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in out], pa.int64()) for i in range(len(names)))],
                names=["doc_id", *names])

    return source.mapInArrow(counted, f"doc_id {id_type}, " + ", ".join(f"{n} long" for n in names))
