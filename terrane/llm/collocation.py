"""Phrase collocation mining (operator 13): SETM over relations of occurrences, with an exact association score.

An occurrence of a phrase is a row (place, phrase). Places number the words of a slice of the texts one by one and
leave a gap at the end of each piece, so two occurrences stand in one piece at adjacent positions exactly if their
places differ by one. The relation of each slice is persisted sorted by place, as packed columns; nothing of it depends
on another slice, so a join by piece and adjacent position is one merge of the sorted relation with itself.

1. Words. Texts are lower-cased and cut into slices of about ``SLICE_BYTES`` of one language, at piece ends. A slice
   lists its distinct words with counts; a grouped sum finds the frequent ones and a semi-join drops all occurrences
   of others.
2. Extension, for each length in turn. A slice merge-joins its relation with itself (place, place + 1): two adjacent
   frequent phrases of n words give a candidate of n + 1. Distinct candidates and their counts in the slice travel
   packed, dealt to buckets by hash; a bucket sums them (group-count) and tells each slice which of its candidates are
   frequent (semi-join); the slice keeps those occurrences as the next relation. Every phrase inside a frequent one is
   frequent, so nothing is lost.
3. Scores, on the tables of frequent phrases alone, by equi joins with their first and last parts: the counts of both
   parts of every cut are at hand; sums and products use decimals. A longer phrase that covers a candidate holds one
   that is longer by a word and at least as frequent, so the latter decides.

A bucket gets a candidate at most once from each slice, however frequent it is. Names of phrases are numbers given by
the grouping bucket (not hashes), so counts are exact.

Defined results: a null text is empty; a null language is ``und``; rows of one id or equal rows all count; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import Scratch, by_value, release_memory, texts

by_value(__name__)

LEAST, LONGEST, TOP, COVER_PERCENT = 30, 4, 2000, 80
SCALE = 2_000_000
UNKNOWN_LANG = "und"
SLICE_BYTES = 8 << 20
#: Expected candidates of a bucket, counted once for each slice that has them.
BUCKET_ROWS = 1_000_000
SPACE, PIECE_END = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"

_CODE_BITS = 32


def packed(values: np.ndarray) -> bytes:
    """Integers as planes of bytes: the planes of high bytes, mostly zeros, compress well."""
    wide = np.ascontiguousarray(values)
    return wide.view(np.uint8).reshape(len(wide), wide.itemsize).T.tobytes()


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def byte_kinds() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: 0 in a word, 1 space, 2 piece end; and its lower-case form."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(SPACE)], kinds[list(PIECE_END)] = 1, 2
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return kinds, lower


def cut_at_pieces(data: np.ndarray, ends: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Parts of about ``most`` bytes that begin behind piece ends (a longer piece comes whole)."""
    marks = np.append(ends, len(data))
    at = 0
    while at < len(data):
        stop = int(marks[np.searchsorted(marks, min(at + most, len(data)))])
        yield data[at:stop]
        at = stop


def words_of(data: np.ndarray, kinds: np.ndarray, lower: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a buffer of text, the word number of every occurrence, and where a new piece begins."""
    kind = kinds[data]
    inside = kind == 0
    marks = np.flatnonzero(kind == 2).astype(np.int32)
    del kind
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1).astype(np.int32), np.flatnonzero(edge == -1).astype(np.int32)
    del edge
    piece = np.searchsorted(marks, starts).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(lower[data[inside]]))
    del starts, ends, inside, offsets
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int32), np.diff(piece, prepend=piece[:1]) != 0


def occurrences(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Slices: slice, lang, n (words), words (distinct), counts, codes (of every word) and breaks (new piece), packed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, lower = byte_kinds()
        number = pyspark.TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                own = np.flatnonzero(langs.indices.to_numpy() == code)
                data = np.frombuffer("\n".join(texts(batch.column(1).take(pa.array(own)))).encode(), np.uint8)
                for part in cut_at_pieces(data, np.flatnonzero(kinds[data] == 2) + 1, SLICE_BYTES):
                    words, codes, breaks = words_of(part, kinds, lower)
                    if not len(codes):
                        continue
                    counts = np.bincount(codes, minlength=len(words)).astype(np.int64)
                    bounds = pa.array([0, len(words)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number]), pa.array([lang]), pa.array([len(codes)]), pa.ListArray.from_arrays(bounds, words),
                         pa.ListArray.from_arrays(bounds, pa.array(counts)), pa.array([packed(codes)]),
                         pa.array([np.packbits(breaks).tobytes()])],
                        names=["slice", "lang", "n", "words", "counts", "codes", "breaks"])
                    number += 1
                del data
            release_memory()

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang")
    return docs.select(lang, F.col(text_col).alias("text")).mapInArrow(
        cut, "slice long, lang string, n long, words array<string>, counts array<long>, codes binary, breaks binary")


RELATION = "slice long, n long, ids array<long>, places binary, codes binary"


def relation(slice_id: int, places: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
    """One slice's relation: sorted places (as differences) and, for each, the phrase's place in ``ids``."""
    if not len(places):
        return pd.DataFrame(columns=["slice", "n", "ids", "places", "codes"])
    distinct, codes = np.unique(ids, return_inverse=True)
    return pd.DataFrame({"slice": [slice_id], "n": [len(places)], "ids": [distinct],
                         "places": [packed(np.diff(places, prepend=0).astype(np.int32))],
                         "codes": [packed(codes.astype(np.int32))]})


def frequent_words(key: tuple, part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """The relation of a slice's frequent words (``known``: code, id)."""
    if part.empty or known.empty:
        return relation(0, np.zeros(0), np.zeros(0))
    row = part.iloc[0]
    codes = unpacked(row["codes"], "<i4")
    ids = np.full(int(codes.max()) + 1, -1, np.int64)
    ids[known["code"].to_numpy()] = known["id"].to_numpy()
    breaks = np.unpackbits(np.frombuffer(row["breaks"], np.uint8), count=len(codes))
    places = np.cumsum(1 + breaks, dtype=np.int64)
    own = ids[codes]
    return relation(int(row["slice"]), places[own >= 0], own[own >= 0])


def merge_adjacent(places_blob: bytes, codes_blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The relation joined with itself by place and place + 1: places of the first, and both codes in one number."""
    places = np.cumsum(unpacked(places_blob, "<i4"), dtype=np.int64)
    codes = unpacked(codes_blob, "<i4").astype(np.int64)
    first = np.flatnonzero(np.diff(places) == 1)
    return places[first], codes[first] << _CODE_BITS | codes[first + 1]


def _spread(a: np.ndarray, b: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of each pair of phrase names."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (((h >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.int64)


def candidates(rel: DataFrame, n_buckets: int) -> DataFrame:
    """Distinct candidates of each slice (names a and b of their first and last phrase) with counts, dealt to buckets."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids = batch.column(1)[k].values.to_numpy()
                _, pairs = merge_adjacent(batch.column(2)[k].as_py(), batch.column(3)[k].as_py())
                if not len(pairs):
                    continue
                distinct, counts = np.unique(pairs, return_counts=True)
                a, b = ids[distinct >> _CODE_BITS], ids[distinct & (1 << _CODE_BITS) - 1]
                with np.errstate(over="ignore"):
                    bucket = _spread(a, b, n_buckets)
                order = np.argsort(bucket, kind="stable")
                edges = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
                rows = [(int(bucket[order[x]]), packed(a[order[x:y]]), packed(b[order[x:y]]), packed(counts[order[x:y]]))
                        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([batch.column(0)[k].as_py()] * len(rows), pa.int64()),
                     *(pa.array([r[c] for r in rows], pa.binary()) for c in (1, 2, 3))],
                    names=["bucket", "slice", "a", "b", "counts"])
            release_memory()

    return rel.select("slice", "ids", "places", "codes").mapInArrow(
        extend, "bucket long, slice long, a binary, b binary, counts binary")


def count_bucket(key: tuple, part: pd.DataFrame, least: int) -> pd.DataFrame:
    """Frequent candidates of a bucket, once in all (slice null) with their sums, and for each slice that has them."""
    bucket = int(key[0])
    sizes = part["a"].map(len).to_numpy() // 8
    a, b, counts = (np.concatenate([unpacked(x, "<i8") for x in part[c]]) for c in ("a", "b", "counts"))
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    first = np.flatnonzero(new)
    sums = np.add.reduceat(counts[order], first)
    frequent = sums >= least
    names = np.where(frequent, (bucket << 32) + np.cumsum(frequent) - 1, -1)
    of = np.empty(len(order), np.int64)
    of[order] = names[np.cumsum(new) - 1]
    head = order[first[frequent]]
    none = np.zeros(0, np.int64)
    rows = [(None, a[head], b[head], names[frequent], sums[frequent])]
    at = np.concatenate([[0], np.cumsum(sizes)])
    for s, x, y in zip(part["slice"].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        kept = np.flatnonzero(of[x:y] >= 0) + x
        if len(kept):
            rows.append((s, a[kept], b[kept], of[kept], none))
    out = pd.DataFrame(rows, columns=["slice", "a", "b", "id", "f"])
    del a, b, counts, order, of
    release_memory()
    return out.assign(slice=out["slice"].astype("Int64"))


def keep_frequent(key: tuple, part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """The next relation of a slice: occurrences of its candidates that are frequent (``known``: a, b, id)."""
    if part.empty or known.empty:
        return relation(0, np.zeros(0), np.zeros(0))
    row = part.iloc[0]
    places, pairs = merge_adjacent(row["places"], row["codes"])
    a, b, names = (np.concatenate(known[c].tolist()) for c in ("a", "b", "id"))
    ids = np.asarray(row["ids"])
    wanted = np.searchsorted(ids, a) << _CODE_BITS | np.searchsorted(ids, b)
    order = np.argsort(wanted)
    wanted, names = wanted[order], names[order]
    at = np.minimum(np.searchsorted(wanted, pairs), len(wanted) - 1)
    hit = wanted[at] == pairs
    return relation(int(row["slice"]), places[hit], names[at[hit]])


def mine_phrases(scratch: Scratch, docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang",
                 text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, n), and for each length from 1 the frequent phrases: id, lang, phrase, last (word), f,
    heads and tails (counts of its beginnings and endings of 1, 2, ... words) and, from length 2, a and b (ids of the
    phrases without the last and without the first word)."""
    slices = scratch.write(occurrences(docs, lang_col, text_col), "slices")
    totals = slices.groupBy("lang").agg(F.sum("n").alias("n"))
    words = slices.select("slice", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w"))
    words = words.select("slice", "lang", "code", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    found = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    found = found.select(F.monotonically_increasing_id().alias("id"), "lang", F.col("word").alias("phrase"),
                         F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
    found = scratch.write(found, "phrases-1")
    known = words.join(found.select("id", "lang", F.col("phrase").alias("word")), ["lang", "word"])
    known = known.select(F.col("slice").alias("of"), "code", "id")
    own = slices.select("slice", "codes", "breaks").groupBy("slice")
    rel = scratch.write(own.cogroup(known.groupBy("of")).applyInPandas(frequent_words, RELATION), "relation-1")
    tables = [found]
    for length in range(2, longest + 1):
        n_buckets = max(1, math.ceil((rel.agg(F.sum("n")).first()[0] or 0) / BUCKET_ROWS))
        counted = candidates(rel, n_buckets).groupBy("bucket").applyInPandas(
            lambda key, part: count_bucket(key, part, least), "slice long, a array<long>, b array<long>, id array<long>, f array<long>")
        counted = scratch.write(counted, f"counted-{length}")
        frequent = counted.where("slice IS NULL").select(F.inline(F.arrays_zip("a", "b", "id", "f")))
        first, last = tables[-1], tables[-1]
        first = first.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("first"), F.col("heads").alias("first_heads"))
        last = last.select(F.col("id").alias("b"), "last", F.col("tails").alias("last_tails"))
        named = frequent.join(first, "a").join(last, "b").select(
            "id", "lang", F.concat_ws(" ", "first", "last").alias("phrase"), "last", "f",
            F.array_append("first_heads", F.col("f")).alias("heads"), F.array_append("last_tails", F.col("f")).alias("tails"), "a", "b")
        tables.append(scratch.write(named, f"phrases-{length}"))
        if length < longest:
            kept = counted.where("slice IS NOT NULL").select("slice", "a", "b", "id")
            rel = scratch.write(rel.groupBy("slice").cogroup(kept.groupBy("slice")).applyInPandas(keep_frequent, RELATION), f"relation-{length}")
            scratch.drop(f"relation-{length - 1}")
        scratch.drop(f"counted-{length}")
    totals = scratch.write(totals, "totals")
    scratch.drop("slices", f"relation-{longest - 1}")
    return totals, tables


def scored(phrases: DataFrame, length: int) -> DataFrame:
    """The lowest-scoring cut of every phrase: l, r, score (ties to the shortest first part)."""
    # decimals: the product of a count may pass 64 bits
    cuts = [F.struct(F.expr(f"CAST(CAST({SCALE} AS DECIMAL(7,0)) * CAST(f AS DECIMAL(20,0)) "
                            f"div (CAST(heads[{k - 1}] AS DECIMAL(20,0)) + CAST(tails[{length - k - 1}] AS DECIMAL(20,0))) AS BIGINT)").alias("score"),
                     F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[length - k - 1].alias("r"))
            for k in range(1, length)]
    return phrases.withColumn("cut", F.array_min(F.array(*cuts))).select("id", "lang", "phrase", "f", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 cover_percent: int = COVER_PERCENT, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``longest`` words that stand
    ``least`` times or more and are not covered by a longer one with ``cover_percent`` of their count or more."""
    totals, tables = mine_phrases(Scratch(docs.sparkSession, "collocation"), docs, least, longest, lang_col, text_col)
    found = None
    for length, table in enumerate(tables[1:], 2):
        own = scored(table, length)
        if length < longest:
            longer = tables[length]
            around = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f"))
            around = around.groupBy("id").agg(F.max("f").alias("longer"))
            covered = 100 * F.col("longer") >= cover_percent * F.col("f")
            own = own.join(around, "id", "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")
        found = own if found is None else found.unionByName(own)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
