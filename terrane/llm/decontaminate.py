"""Benchmark decontamination (operator 9): one FM-index per training shard, searched for all benchmark windows.

A shard is a slice of a partition's documents. Words that no benchmark item uses can lie inside no window, so a
shard's sequence holds only the runs of benchmark words that are long enough for a window, with a separator between
them; every text is read whole. The FM-index of that sequence is its Burrows-Wheeler transform behind a wavelet matrix
for ranks, and every ``SAMPLE``-th suffix position. All windows are searched backwards at once; the rows found are
walked to the next sampled position. Windows found in a document give its hit words, and merged spans to remove.

The benchmark is dealt into blocks of about ``BLOCK_CHARS`` characters; each block is sent to the tasks for one pass
over the documents, and the findings of all blocks are merged by document. So what is broadcast never grows beyond a
block (or one item), and a larger benchmark takes more passes, not more memory.

Defined results: a null text has no words and no hits, a null item is in no document, a null item id counts as the
empty id; equal rows give equal results; extra columns are ignored; without documents or items the result has no rows
or no hits. An item shorter than a window, but not empty, is one window.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import by_value, row_id, texts, tidy
from terrane.llm.licenses import words_of
from terrane.llm.packing import slices

by_value(__name__)

WINDOW = 10
SAMPLE = 16
#: Characters of the benchmark in a block: its index and windows take about 80 bytes for each (measured: 207 MB for
#: 2.7 million) on the driver and in every worker, so about 120 MB.
BLOCK_CHARS = 1_500_000
SHARD_BYTES = 8 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEPARATOR = 1  # symbol 0 ends the sequence


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling. The last symbol must be the smallest."""
    n = len(sequence)
    rank = np.unique(sequence, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        later = np.zeros(n, np.int64)
        later[:n - width if width < n else 0] = rank[width:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Ranks of symbols in prefixes of a sequence: per bit, the number of ones before each place."""

    def __init__(self, sequence: np.ndarray):
        self.bits = max(1, int(sequence.max()).bit_length()) if len(sequence) else 1
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            own = (sequence >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(own)]))
            self.zeros.append(len(own) - int(own.sum()))
            sequence = sequence[np.argsort(own, kind="stable")]

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        first, at = np.zeros_like(places), places
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, one = self.ones[level], ((symbols >> bit) & 1).astype(bool)
            first = np.where(one, self.zeros[level] + ones[first], first - ones[first])
            at = np.where(one, self.zeros[level] + ones[at], at - ones[at])
        return at - first


class FMIndex:
    def __init__(self, sequence: np.ndarray):
        """``sequence``: symbols from 1; the end symbol 0 is added here."""
        sequence = np.append(sequence, 0)
        order = suffix_array(sequence)
        self.bwt = sequence[order - 1]
        self.ranks = WaveletMatrix(self.bwt)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence))])  # symbols smaller than each
        sampled = order % SAMPLE == 0
        self.sampled, self.sample_at = sampled, np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern (patterns of one length, one per row)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.bwt))
        live = np.flatnonzero((patterns < len(self.before) - 1).all(axis=1))
        dead = np.ones(len(patterns), bool)
        dead[live] = False
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbols = patterns[live, column]
            low[live] = self.before[symbols] + self.ranks.rank(symbols, low[live])
            high[live] = self.before[symbols] + self.ranks.rank(symbols, high[live])
            live = live[low[live] < high[live]]
        high = np.where(dead, low, np.maximum(high, low))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the next sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            symbols = self.bwt[rows[open_]]
            rows[open_] = self.before[symbols] + self.ranks.rank(symbols, rows[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.samples[self.sample_at[rows]] + steps


class Windows:
    """Distinct windows of a block of benchmark items, as symbols from 2, with the items of each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text.encode().lower())
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words)
            for at in range(max(1, len(ids) - window + 1)) if ids else ():
                holders.setdefault(ids[at:at + window], set()).add(item)
        self.items = sorted({item for own in holders.values() for item in own})
        number = {item: k for k, item in enumerate(self.items)}
        #: by length: the patterns, and for each the numbers of its items
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for length in sorted({len(w) for w in holders}):
            own = [w for w in holders if len(w) == length]
            self.by_length[length] = (np.array(own, np.int64), [sorted(number[i] for i in holders[w]) for w in own])
        self.shortest = min(self.by_length, default=window)


def scan_shard(documents: list[str], windows: Windows) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
    """Per document: number of words, merged word spans [start, end) that are hit, numbers of the items found."""
    n_words, runs, run_doc, run_word = [], [], [], []
    for d, text in enumerate(documents):
        words = words_of(text.encode().lower())
        n_words.append(len(words))
        if not windows.by_length:
            continue
        ids = np.fromiter((windows.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids > 0, [False]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= windows.shortest:
                runs += [ids[a:b], [SEPARATOR]]
                run_doc.append(d)
                run_word.append(a)
    out: list[tuple[int, list[tuple[int, int]], set[int]]] = [(n, [], set()) for n in n_words]
    if not runs:
        return out
    sequence = np.concatenate(runs).astype(np.int64)
    run_at = np.cumsum([0, *(len(r) + 1 for r in runs[::2])])[:-1]
    index = FMIndex(sequence)
    covered = np.zeros(len(sequence) + 1, np.int64)
    for length, (patterns, holders) in windows.by_length.items():
        low, high = index.search(patterns)
        found = np.flatnonzero(high > low)
        counts = (high - low)[found]
        which = np.repeat(found, counts)
        rows = np.repeat(low[found] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        places = index.locate(rows)
        np.add.at(covered, places, 1)
        np.add.at(covered, places + length, -1)
        own = np.searchsorted(run_at, places, "right") - 1
        pairs = np.unique(np.column_stack([np.array(run_doc)[own], which]), axis=0) if len(own) else []
        for d, w in pairs:
            out[d][2].update(holders[w])
    hit = np.cumsum(covered)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        run = int(np.searchsorted(run_at, a, "right")) - 1  # a separator is never hit: spans stay in a run
        shift = run_word[run] - int(run_at[run])
        out[run_doc[run]][1].append((a + shift, b + shift))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_FOUND = "n_words long, word_spans array<struct<start: long, end: long>>, items array<string>"
_DIGESTED = f"n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, {_FOUND.split(', ', 1)[1]}"


def _block_findings(docs: DataFrame, items: list[tuple[str, str]], window: int, digested: bool = False) -> DataFrame:
    """row, text columns as given; n_words, word_spans, items for one block of the benchmark, or their digests."""
    shared = docs.sparkSession.sparkContext.broadcast(Windows(items, window))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in (part for whole in batches for part in slices(whole, 1, SHARD_BYTES)):
            found = scan_shard(texts(batch.column(1)), windows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([[{"start": a, "end": b} for a, b in f[1]] for f in found], span),
                 pa.array([sorted(windows.items[k] for k in f[2]) for f in found], pa.list_(pa.string()))],
                names=["row", "n_words", "word_spans", "items"])

    row = docs.schema["row"].dataType.simpleString()
    if digested:  # in the same worker: a second Python step of the task would take a second one
        return docs.mapInArrow(tidy(lambda batches: _digests(scan(batches)), "decontamination"), f"row {row}, {_DIGESTED}")
    return docs.mapInArrow(tidy(scan, "decontamination"), f"row {row}, {_FOUND}")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document row: id, n_words, n_hit, n_items, items_sha256, contaminated, word_spans, items."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_chars))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))
    source = docs.select(row_id(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    parts = [_block_findings(source, [(r["item"], r["text"]) for r in items.where(block == k).collect()], window, n_blocks == 1)
             for k in range(n_blocks)]
    found = parts[0]
    if n_blocks > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        # equal rows of documents have equal findings: one row per (id, text) is joined back to all of them
        merged = found.groupBy("row").agg(F.max("n_words").alias("n_words"),
                                          F.array_sort(F.flatten(F.collect_set("word_spans"))).alias("word_spans"),
                                          F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        found = source.select("row").join(merged.withColumnRenamed("row", "own"), F.col("row").eqNullSafe(F.col("own")), "left")
        found = found.select("row", "n_words", "word_spans", "items").mapInArrow(
            _digests, f"row {source.schema['row'].dataType.simpleString()}, {_DIGESTED}")
    return found.select(F.col("row.id").alias(id_col), "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                        "word_spans", "items", F.col("row.h").alias("text_hash"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for n, spans, items in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
            spans = _merged([(s["start"], s["end"]) for s in spans])
            hit = sum(b - a for a, b in spans)
            out.append((n, hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), hit > 0,
                        [{"start": a, "end": b} for a, b in spans], items))
        kinds = [pa.int64()] * 3 + [pa.string(), pa.bool_(), span, pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds))],
            names=["row", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "word_spans", "items"])


def lower_ascii(text: str) -> str:
    return text.encode().lower().decode()


def cut_words(text: str, spans: list[dict]) -> str:
    """The text without its words in the word spans [start, end) and what lies between those words."""
    places = [m.span() for m in WORD.finditer(lower_ascii(text))]
    kept, at = [], 0
    for s in spans:
        kept.append(text[at:places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    return "".join([*kept, text[at:]])
