"""Exact top-k search (operator 11): MaxScore over sharded inverted lists of integer vector components.

A vector's components are floor(256 * x). The terms of the index are (dimension, sign): a posting is a row whose
component there has that sign, with its magnitude. For a query component q, postings of its own sign add |q| * magnitude
to the inner product, at most |q| times the list's largest magnitude (the list's bound); postings of the other sign
only lower it (bound 0).

Rows are dealt to shards by hash; each shard's lists are built once and written. Every query meets every shard, in
blocks: a task holds one shard and the queries of one block. Per query and shard:

1. Lists are ordered by bound. The longest tail of lists whose bounds add up to less than the k-th score known so far
   is non-essential: a row that stands in none of the others cannot compete. The threshold starts with the exact scores
   of a few rows that the strongest lists favour.
2. The essential lists are traversed; their sums are the candidates' partial scores.
3. The other lists are probed for the candidates that remain, strongest first: a candidate goes when its partial score
   plus the bounds not yet probed is below the threshold (an equal score may still win by its smaller id).

The shards' results are merged by a ranked window per query. Scores are exact: sums are kept in 64-bit floats only
while every product sum stays below 2^53, else in Python's integers.

Defined results: rows whose vector is null, or holds a null or non-finite component, or whose id is null take no part;
an empty vector scores 0 with all; of vectors of different lengths, missing components count as 0; each of several rows
of one id is a row of its own (as a query it leaves out itself alone); scores beyond 64 bits are ranked
exactly and shown cut to the largest number; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import Scratch, by_value

by_value(__name__)

SCALE, TOP = 256, 5
#: Rows of a shard and queries of a block at most; smaller where the table is small, so that all cores have work.
SHARD_ROWS, BLOCK_QUERIES = 32_768, 8_192
LEAST_SHARD_ROWS, LEAST_BLOCK_QUERIES = 4_096, 512
#: Lists probed between two prunings.
PROBE = 8
EXACT = 2**53
LARGEST = 2**63 - 1


def components(vectors: pa.ListArray, scale: int) -> list[list[int] | None]:
    """floor(scale * x) of every component; None for vectors that take no part."""
    out: list[list[int] | None] = []
    for v in vectors:
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid else None
        if x is None or v.values.null_count or not np.isfinite(x).all():
            out.append(None)
            continue
        with np.errstate(over="ignore"):
            big = np.floor(x * scale)
        # numbers that a 64-bit float times the scale cannot hold
        out.append([math.floor(c) for c in big] if np.isfinite(big).all() else [math.floor(c) * scale for c in x])
    return out


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """row (unique), id, q (components as decimal texts, so that they keep any size), of the rows that take part."""
    id_type = vectors.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = components(batch.column(1), scale)
            own = [k for k, q in enumerate(found) if q is not None]
            small = [max(map(abs, found[k]), default=0) < 2**31 for k in own]
            blobs = [np.array(found[k], "<i4").tobytes() if s else ",".join(map(str, found[k])).encode() for k, s in zip(own, small, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array(blobs, pa.binary()), pa.array(small, pa.bool_())],
                                             names=["id", "q", "small"])

    kept = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    return kept.mapInArrow(cut, f"id {id_type}, q binary, small boolean").withColumn("row", F.monotonically_increasing_id())


def matrix(blobs: list[bytes], small: list[bool]) -> np.ndarray:
    """Vectors as rows, padded with zeros; 64-bit floats, or Python integers where one needs them."""
    rows = [np.frombuffer(b, "<i4") if s else [int(c) for c in b.decode().split(",")] for b, s in zip(blobs, small, strict=True)]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.float64 if all(small) else object)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


class Shard:
    """Inverted lists of one shard: per dimension and sign the rows (ascending) and magnitudes."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, values: np.ndarray):
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.values = ids[order], rows[order], values[order]
        self.lists: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        for column in self.values.T:
            at = {s: np.flatnonzero(column * s > 0) for s in (1, -1)}
            self.lists.append({s: (k, column[k] * s) for s, k in at.items()})
        self.most = {s: np.array([d[s][1].max() if len(d[s][1]) else 0 for d in self.lists], self.values.dtype) for s in (1, -1)}
        self.largest = int(max((abs(v).max() for v in self.values if len(v)), default=0))

    @functools.cached_property
    def wide(self) -> Shard:
        """The same shard with Python's integers."""
        return Shard(self.ids, self.rows, self.values.astype(np.int64).astype(object))

    def search(self, query: np.ndarray, own_row: int, top: int) -> list[tuple[int, int]]:
        """(place in the shard, score) of the best rows but ``own_row``; all that can be among the first ``top``."""
        n, query = len(self.ids), query[:len(self.lists)]
        terms = np.flatnonzero(query)
        if self.values.dtype != object and len(terms) * self.largest * int(abs(query).max(initial=0)) >= EXACT:
            return self.wide.search(query.astype(np.int64).astype(object), own_row, top)
        positive, weight = query[terms] > 0, abs(query[terms])
        bound = weight * np.where(positive, self.most[1][terms], self.most[-1][terms])
        order = np.argsort(-bound, kind="stable")
        terms, positive, weight = terms[order], positive[order], weight[order]
        left = np.append(np.cumsum(bound[order][::-1])[::-1], 0)  # bounds from each list on
        scores = np.zeros(n, self.values.dtype)

        def traverse(first: int, last: int) -> None:
            for d, up, w in zip(terms[first:last].tolist(), positive[first:last].tolist(), weight[first:last].tolist(), strict=True):
                at, size = self.lists[d][1 if up else -1]
                scores[at] += w * size

        strong = min(PROBE, len(terms))
        traverse(0, strong)
        alive = np.flatnonzero(self.rows != own_row)
        threshold = None  # the exact k-th best score of some rows: the first k have it at least
        if len(alive) >= top:
            few = alive[np.argsort(-scores[alive], kind="stable")[:4 * top]]
            threshold = np.sort(self.values[few, :len(query)] @ query)[-top]
        essential = len(terms) if threshold is None else max(strong, min(len(terms), int(np.searchsorted(-left, -threshold, side="right"))))
        traverse(strong, essential)
        if threshold is not None:
            alive = alive[scores[alive] + left[essential] >= threshold]
        # what other signs take away in the essential dimensions, then the remaining dimensions in full
        steps = [(k, min(k + PROBE, essential), True) for k in range(0, essential, PROBE)]
        steps += [(k, k + PROBE, False) for k in range(essential, len(terms), PROBE)]
        for first, last, lowering in steps:
            part = self.values[np.ix_(alive, terms[first:last])] * query[terms[first:last]]
            scores[alive] += (np.minimum(part, 0) if lowering else part).sum(axis=1)
            if threshold is not None:
                alive = alive[scores[alive] + left[essential if lowering else min(last, len(terms))] >= threshold]
        best = alive[np.argsort(-scores[alive], kind="stable")[:top]]  # rows are in the order of ids
        return [(int(k), int(scores[k])) for k in best]


def beyond(score: int) -> str | None:
    """What orders scores that are cut to the same 64-bit number (as text); null for the others."""
    if -LARGEST <= score <= LARGEST:
        return None
    size, digits = len(str(abs(score))), str(abs(score))
    return f"{size:05d}{digits}" if score > 0 else f"{99999 - size:05d}" + digits.translate(str.maketrans("0123456789", "9876543210"))


def top_matches(vectors: DataFrame, is_query: Column, top: int = TOP, scale: int = SCALE, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` (a condition on ``id``) chooses, the ``top`` other
    rows of the highest inner product."""
    scratch = Scratch(vectors.sparkSession, "maxscore")
    rows = scratch.write(quantised(vectors, id_col, vector_col, scale), "rows")
    asked = rows.where(is_query)
    n, n_queries = rows.count(), asked.count()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_shards = max(1, math.ceil(n / SHARD_ROWS), min(cores, math.ceil(n / LEAST_SHARD_ROWS)))
    n_blocks = max(1, math.ceil(n_queries / BLOCK_QUERIES), min(math.ceil(cores / n_shards), math.ceil(n_queries / LEAST_BLOCK_QUERIES)))
    shard = F.pmod(F.xxhash64("row"), F.lit(n_shards))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks))
    # every row once for each block, every query once for each shard
    held = rows.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), "row", "id", "q", "small")
    met = asked.select(F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), block.alias("block"), "row", "id", "q", "small")

    def search(key: tuple, part: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(part) and len(queries):
            index = Shard(part["id"].to_numpy(), part["row"].to_numpy(), matrix(part["q"].tolist(), part["small"].tolist()))
            for row, id_, vector in zip(queries["row"].tolist(), queries["id"].tolist(), matrix(queries["q"].tolist(), queries["small"].tolist()), strict=True):
                if vector.dtype != index.values.dtype:
                    vector = np.array([int(x) for x in vector], object)
                    index = index if index.values.dtype == object else index.wide
                out += [(row, id_, index.ids[k], max(-LARGEST - 1, min(LARGEST, s)), beyond(s)) for k, s in index.search(vector, row, top)]
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score", "beyond"])

    id_type = rows.schema["id"].dataType.simpleString()
    found = held.groupBy("shard", "block").cogroup(met.groupBy("shard", "block")).applyInPandas(
        search, f"row long, query_id {id_type}, vec_id {id_type}, score long, beyond string")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
