"""The newest rows in a range of sizes, for a table of ranges, without a row per pair of a row and a range.

Sizes fall into cells. A range begins in one cell, ends in another and holds the cells between them whole. Of a whole
cell it can take only the ``k`` newest rows; of the cell that it begins in only rows that fewer than ``k`` newer ones of
their size or more keep out, and of the one that it ends in likewise downwards. For ``n`` rows whose age does not hang
together with their size these are about ``k * (1 + ln(n / k))``, so the rows that can be asked for at all are few, a task
finds them among its own rows before any are shuffled, and they lie in the memory of the tasks that answer the ranges.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spread import task_count

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sizes of a cell differ by less than this factor.
CELL_RATIO = 1.1
#: Ranges that one task answers from the same rows, and those whose answers make one batch.
TASK_RANGES, BATCH_RANGES = 20_000, 1_000


def cell(size: Column) -> Column:
    """Number of the cell, ascending with the size. The sizes -1, 0 and 1 each begin one, -1 and 0 fill it."""
    size = size.cast("double")
    return (F.when(size >= 1, F.floor(F.log(size) / math.log(CELL_RATIO))).when(size > 0, -1).when(size == 0, -2)
            .when(size == -1, -4).otherwise(-3)).cast("int")


def above(values: np.ndarray, largest: list[float], k: int) -> np.ndarray:
    """Which values have fewer than ``k`` of their size or more before them; ``largest`` is a heap of the ``k`` largest
    so far."""
    out = np.zeros(len(values), bool)
    for at in (np.flatnonzero(values > largest[0]) if len(largest) == k else np.arange(len(values))).tolist():
        if len(largest) < k:
            heapq.heappush(largest, values[at])
        elif values[at] > largest[0]:
            heapq.heapreplace(largest, values[at])
        else:
            continue
        out[at] = True
    return out


def reachable(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows with ``_key`` and ``_size``, the newest first, those that a range can take: ``_begin`` if it begins in their
    cell, ``_end`` if it ends there, ``_whole`` if it holds the cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list[float], list[float]]] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            keys, size = batch.column("_key").dictionary_encode(), batch.column("_size").to_numpy(zero_copy_only=False)
            codes = keys.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            cuts = np.flatnonzero(np.diff(codes[order])) + 1
            begin, end, whole = (np.zeros(len(batch), bool) for _ in range(3))
            for key, at in zip(keys.dictionary.to_pylist(), np.split(order, cuts) if len(order) else [], strict=True):
                largest, least = held.setdefault(key, ([], []))
                begin[at], end[at] = above(size[at], largest, k), above(-size[at], least, k)
                whole[at[:max(0, k - seen.get(key, 0))]] = True
                seen[key] = seen.get(key, 0) + len(at)
            flags = {"_begin": pa.array(begin), "_end": pa.array(end), "_whole": pa.array(whole)}
            arrays = [flags.get(name, column) for name, column in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names).filter(pa.array(begin | end | whole))
    return run


def answers(k: int, payload: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per ``_group`` first the rows, the newest first, then the ranges (``_lo`` is there): id, rank and payload of each
    range's rows."""
    def picked(rows: pa.RecordBatch, size: np.ndarray, known: dict, ranges: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for lo, hi in zip(ranges.column("_lo").to_pylist(), ranges.column("_hi").to_pylist(), strict=True):
            if (lo, hi) not in known:
                known[lo, hi] = np.flatnonzero((size >= lo) & (size <= hi))[:k]
            found.append(known[lo, hi])
        counts = np.array([len(f) for f in found])
        at = np.concatenate(found)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        ids = ranges.column("subject_id").take(pa.array(np.repeat(np.arange(len(found)), counts)))
        return pa.RecordBatch.from_arrays([ids, pa.array(rank, pa.int32()), *(rows.column(c).take(pa.array(at)) for c in payload)],
                                          names=["subject_id", "rank", *payload])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, rows, size, known = None, [], None, np.zeros(0), {}
        for batch in batches:
            names = batch.column("_group").dictionary_encode()
            codes, is_range = names.indices.to_numpy(zero_copy_only=False), batch.column("_lo").is_valid().to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(is_range.astype(np.int8)) != 0)) + 1).tolist(), len(batch)]
            for start, stop in zip(starts, starts[1:], strict=False):
                if start == stop:
                    continue
                if (own := names.dictionary[int(codes[start])].as_py()) != group:
                    group, parts, rows, known = own, [], None, {}
                if not is_range[start]:
                    parts.append(batch.slice(start, stop - start).select([*payload, "_size"]))
                    continue
                if rows is None and parts:
                    rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    size = rows.column("_size").to_numpy(zero_copy_only=False)
                for some in range(start, stop, BATCH_RANGES) if rows is not None else ():
                    yield picked(rows, size, known, batch.slice(some, min(BATCH_RANGES, stop - some)))
    return run


def newest_in_ranges(rows: DataFrame, ranges: DataFrame, by: list[str], size: str, newest: list[Column], k: int,
                     payload: list[str]) -> DataFrame:
    """subject_id, rank and ``payload`` of the ``k`` newest ``rows`` (in the order ``newest``) for each of ``ranges``
    (``subject_id``, ``_lo``, ``_hi``, both bigint) whose size is in it, among those equal in the columns ``by`` (never
    null). A range's end is ``CELL_RATIO`` times its begin at least, or the range begins with -1, 0 or 1: so none lies inside
    a cell without its least size. Ranges of the same subject share its ``k`` places."""
    key, number = F.concat_ws("|", *by, "_cell"), F.col(size).cast("double")
    keyed = (rows.withColumn("_size", number).where("NOT isnan(_size)").withColumn("_cell", cell(F.col("_size")))
             .withColumns({"_key": key, **{c: F.lit(False) for c in ("_begin", "_end", "_whole")}}).drop(*by, "_cell"))
    own = keyed.sortWithinPartitions(*newest).mapInArrow(reachable(k), keyed.schema)  # a crowded cell is not shuffled whole
    keyed = own.repartition("_key").sortWithinPartitions(*newest).mapInArrow(reachable(k), keyed.schema)

    asked = (ranges.where("_lo <= _hi").withColumns({"_first": cell(F.col("_lo")), "_last": cell(F.col("_hi"))})
             .withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy("subject_id"))))
    once = _answered(keyed, asked.where("_times = 1"), by, newest, k, payload)
    shared = _answered(keyed, asked.where("_times > 1"), by, newest, k, [*payload, *(c for c in rows.columns if c not in payload and c not in by)])
    place = F.row_number().over(Window.partitionBy("subject_id").orderBy(*newest))
    return once.unionByName(shared.withColumn("rank", place).where(F.col("rank") <= k).select("subject_id", "rank", *payload))


def _answered(keyed: DataFrame, asked: DataFrame, by: list[str], newest: list[Column], k: int, payload: list[str]) -> DataFrame:
    """Every range on its own: ranges that begin in the same cell meet the rows that they can take in one task, or in
    several where they are many."""
    sets = asked.groupBy(*by, "_first", "_last").agg(F.count(F.lit(1)).alias("_n"))
    pieces = sets.groupBy(*by, "_first").agg(F.ceil(F.sum("_n") / TASK_RANGES).cast("int").alias("_pieces"))
    here, last = F.col("_cell") == F.col("_first"), F.col("_cell") == F.col("_last")
    need = (sets.withColumn("_cell", F.explode(F.sequence("_first", "_last"))).groupBy(*by, "_first", "_cell")
            .agg(F.max(last).alias("_to_end"), F.max(here & ~last).alias("_to_begin"), F.max(~here & ~last).alias("_to_whole"))
            .join(pieces, [*by, "_first"]).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))))
    group = F.concat_ws("|", *by, "_first", "_piece")
    need = need.select(F.concat_ws("|", *by, "_cell").alias("_key"), group.alias("_group"), "_to_end", "_to_begin", "_to_whole")
    wanted = F.col("_to_end") & F.col("_end") | F.col("_to_begin") & F.col("_begin") | F.col("_to_whole") & F.col("_whole")
    own = asked.join(F.broadcast(pieces), [*by, "_first"]).withColumn("_piece", F.pmod(F.xxhash64("subject_id"), F.col("_pieces")))
    own = own.select(group.alias("_group"), "subject_id", "_lo", "_hi")
    both = (keyed.join(need, "_key").where(wanted).drop("_key", "_begin", "_end", "_whole", "_to_end", "_to_begin", "_to_whole")
            .unionByName(own, allowMissingColumns=True))
    kinds = ", ".join(f"`{c}` {both.schema[c].dataType.simpleString()}" for c in payload)
    dealt = both.repartition(task_count(both.sparkSession), "_group").sortWithinPartitions("_group", F.col("_lo").isNotNull(), *newest)
    return dealt.mapInArrow(answers(k, payload), f"subject_id {both.schema['subject_id'].dataType.simpleString()}, rank int, {kinds}")
