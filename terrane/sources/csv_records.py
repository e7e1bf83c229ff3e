"""CSV records over many tasks (S1): files are split anywhere, and cut where records end.

A line break inside quotes belongs to a value, so a split cannot know by itself whether it begins inside one. Every
line acts on the state "inside quotes" in one of four ways: it keeps it, flips it, or ends outside or inside whatever
it was before. The actions of a split's lines combine into one action; a running combination over the splits of each
file (one row per split) tells in which state a split begins. With that known, each split joins its lines to records.
A record that crosses splits is put together from its pieces; they are the only rows that are shuffled.

An unclosed quote makes the rest of its file one record, as any CSV reader sees it.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEEP, FLIP, TO_OUTSIDE, TO_INSIDE = range(4)
WHOLE, OPENED, CONTINUED = range(3)
RECORD = "path string, block long, line long, part int, record string"


def _ends_inside(text: Column) -> Column:
    """Whether text that begins outside quotes ends inside them: a field's opening quote is left without its end.
    Quotes elsewhere than at the beginning of a field are part of the value."""
    closed = F.regexp_replace(text, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return closed.rlike(r'(?:^|,)"')


def line_action(line: Column) -> Column:
    """What a line does to the state; a line without quotes keeps it."""
    outside, inside = _ends_inside(line), _ends_inside(F.concat(F.lit('"'), line))
    return (F.when(~F.contains(line, F.lit('"')), KEEP).when(outside & inside, TO_INSIDE).when(outside, FLIP)
            .when(inside, KEEP).otherwise(TO_OUTSIDE).cast("byte"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """path, block (the split's first byte), text, action; in the order of the files within each split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                        F.col("value").alias("text"), line_action(F.col("value")).alias("action"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of a batch by split: columns 0 and 1 name it."""
    blocks = batch.column(1).to_numpy()
    names = pc.dictionary_encode(batch.column(0))
    codes = names.indices.to_numpy()
    edges = np.flatnonzero((np.diff(blocks, prepend=-1) != 0) | (np.diff(codes, prepend=-1) != 0))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(blocks)], strict=True):
        yield (names.dictionary[int(codes[a])].as_py(), int(blocks[a])), batch.slice(a, b - a)


def states_after(actions: np.ndarray, before: int) -> np.ndarray:
    """The state after each line, 1 inside quotes."""
    fixed = np.maximum.accumulate(np.where(actions >= TO_OUTSIDE, np.arange(len(actions)), -1))
    flips = np.cumsum(actions == FLIP)
    base = np.where(fixed >= 0, actions[fixed] == TO_INSIDE, before)
    return base ^ ((flips - np.where(fixed >= 0, flips[fixed], 0)) & 1)


def _split_actions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: the state it ends in when it begins outside, and inside."""
    key, ends = None, (0, 1)

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), *(pa.array([e], pa.int32()) for e in ends)],
                                          names=["path", "block", "from_outside", "from_inside"])

    for batch in batches:
        for own, part in _runs(batch):
            if own != key:
                if key:
                    yield told()
                key, ends = own, (0, 1)
            actions = part.column(2).to_numpy()
            ends = tuple(int(states_after(actions, e)[-1]) for e in ends)
    if key:
        yield told()


def split_states(lines: DataFrame) -> DataFrame:
    """path, block, inside, ends_inside: the states in which each split begins and ends, one row per split.

    Over the splits of a file, in order: where a split ends the same whatever it began with, that state holds behind it;
    else it keeps or flips the state before it.
    """
    ends = lines.select("path", "block", "action").mapInArrow(
        _split_actions, "path string, block long, from_outside int, from_inside int")
    ensure_checkpoint_dir(lines.sparkSession)
    ends = ends.checkpoint(eager=True)
    so_far = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("from_outside") == F.col("from_inside")
    flips = F.sum(F.when(~fixed & (F.col("from_outside") == 1), 1).otherwise(0)).over(upto)
    counted = ends.withColumn("flips", flips).withColumn("fixed", F.when(fixed, F.struct("from_outside", "flips")))
    before = Window.partitionBy("path").orderBy("block")
    known = counted.select("path", "block", "from_outside", "from_inside", F.lag("flips", 1, 0).over(before).alias("flips"),
                           F.last("fixed", ignorenulls=True).over(so_far).alias("fixed"))
    since = F.col("flips") - F.coalesce("fixed.flips", F.lit(0))
    inside = ((F.coalesce("fixed.from_outside", F.lit(0)) + since) % 2).cast("int")
    return known.select("path", "block", inside.alias("inside"),
                        F.when(inside == 1, F.col("from_inside")).otherwise(F.col("from_outside")).alias("ends_inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of each split. Columns: path, block, text, action, inside."""
    key, state, line = None, 0, 0
    pending: list | None = None  # the record that is not complete: its line, part, texts

    def rows(own: tuple[str, int], lines: list[int], parts: list[int], texts: pa.Array | list[str]) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array([own[0]] * n, pa.string()), pa.array([own[1]] * n, pa.int64()), pa.array(lines, pa.int64()),
                                           pa.array(parts, pa.int32()), pa.array(texts, pa.string()) if isinstance(texts, list) else texts],
                                          names=["path", "block", "line", "part", "record"])

    def left_over() -> pa.RecordBatch:
        return rows(key, [pending[0]], [OPENED if pending[1] == WHOLE else CONTINUED], ["\n".join(pending[2])])

    for batch in batches:
        for own, part in _runs(batch):
            if own != key:
                if pending:
                    yield left_over()
                if part.column(4)[0].as_py() is None:
                    raise ValueError(f"{own[0]} was split otherwise when its quotes were counted")
                key, state, line = own, int(part.column(4)[0].as_py()), 0
                pending = [0, CONTINUED, []] if state else None
            text, after = part.column(2), states_after(part.column(3).to_numpy(), state)
            begins = np.flatnonzero(np.concatenate([[state], after[:-1]]) == 0)
            first = int(begins[0]) if len(begins) else len(text)
            if pending and first:
                pending[2] += text.slice(0, first).to_pylist()
            if pending and not after[first - 1 if first else 0]:
                yield rows(key, [pending[0]], [pending[1]], ["\n".join(pending[2])])
                pending = None
            state = int(after[-1])
            if len(begins):
                whole = begins if not state else begins[:-1]
                if len(whole):
                    stops = np.append(begins[1:], len(text))[:len(whole)]
                    listed = pa.ListArray.from_arrays(pa.array(np.append(whole, stops[-1]), pa.int32()), text)
                    yield rows(key, (whole + line).tolist(), [WHOLE] * len(whole), pc.binary_join(listed, "\n"))
                if state:
                    pending = [line + int(begins[-1]), WHOLE, text.slice(int(begins[-1])).to_pylist()]
            line += len(text)
    if pending:
        yield left_over()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """pos (file, split, line) and record (text, without its line end) of every record of the CSV files at ``path``."""
    lines = _lines(spark, path)
    states = split_states(lines).checkpoint(eager=True)  # one row per split
    # the rows must stay in the order of the scan: the small side is broadcast
    cut = lines.join(F.broadcast(states), ["path", "block"], "left").select("path", "block", "text", "action", "inside").mapInArrow(_cut, RECORD)
    found = cut.where(F.col("part") == WHOLE)
    if not states.where("inside = 1 OR ends_inside = 1").isEmpty():
        pieces = cut.where(F.col("part") != WHOLE)
        order = Window.partitionBy("path").orderBy("block", F.desc("part")).rowsBetween(Window.unboundedPreceding, 0)
        opener = F.max(F.when(F.col("part") == OPENED, F.struct("block", "line"))).over(order)
        joined = (pieces.withColumn("opener", opener).groupBy("path", "opener")
                  .agg(F.sort_array(F.collect_list(F.struct("block", "record"))).alias("pieces")))
        found = found.unionByName(joined.select(
            "path", "opener.block", "opener.line", F.lit(WHOLE).alias("part"),
            F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record")))
    record = F.regexp_replace("record", "\r$", "")
    return found.select(F.struct(F.col("path"), F.col("block"), F.col("line")).alias("pos"), record.alias("record")).where(F.trim("record") != "")


def parse_records(records: DataFrame, columns: list[str] | None, options: dict[str, str]) -> DataFrame:
    """Text columns and ``pos`` of records whose files begin with a header.

    Without ``columns``, names come from the header of the first file.
    """
    header = (F.col("pos.block") == 0) & (F.col("pos.line") == 0)
    if columns is None:
        first = records.where(header).orderBy("pos.path").select("record").first()
        columns = next(csv.reader([first["record"]], strict=False)) if first else []
    if not columns:
        return records.select("pos")
    rows = F.from_csv("record", ", ".join(f"`{c}` string" for c in columns), options)
    return records.where(~header).select("pos", rows.alias("row")).select("pos", *(F.col(f"row.`{c}`").alias(c) for c in columns))
