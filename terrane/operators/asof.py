"""As-of joins and ordered fills.

Spark has no public as-of join, so it is composed from public operators:

* ``asof_join`` (backward, exact matches allowed). The right side is reduced to
  one row per (key, day) and the left side to its distinct (key, day); a running
  ``last`` over those days, of which a calendar has few, finds each day's value.
  The left rows then meet it by an equi join on (key, day): they are never
  windowed, so a hot date or year is no sorted group, and AQE splits its join.
* ``global_fill`` (F3): forward then backward fill in a global order, without a
  single-partition window over the rows: range partitioning (materialised
  once), a per-partition fill, and a carry table with one row per partition.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, values: list[str],
              by: list[str] | None = None, right_order: str | None = None) -> DataFrame:
    """For each left row, the right row with the greatest ``right_on`` <=
    ``left_on`` (per ``by`` keys); its ``values`` are appended (NULL if none).

    Dates compare at day precision. Of several right rows on one day the last
    in ``right_order`` counts (without it, the greatest ``values``); right rows
    without a date never match, left rows without one get NULL.
    """
    by = list(by or [])
    rv = F.struct(*[F.col(v) for v in values])
    order = F.struct(F.col(right_order), rv) if right_order else rv
    daily = (right.where(F.col(right_on).isNotNull())
             .groupBy(*by, F.col(right_on).cast("date").alias("_day")).agg(F.max_by(rv, order).alias("_rv")))
    asked = left.select(*by, F.col(left_on).cast("date").alias("_day")).where(F.col("_day").isNotNull()).distinct()
    w = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    found = (asked.withColumn("_asked", F.lit(True)).join(daily, [*by, "_day"], "full")
             .withColumn("_got", F.last("_rv", ignorenulls=True).over(w)).where("_asked")
             .select(*[F.col(k).alias(f"_k_{k}") for k in by], F.col("_day").alias("_found_day"), "_got"))
    cond = [left[k] == found[f"_k_{k}"] for k in by] + [left[left_on].cast("date") == found["_found_day"]]
    j = left.join(found, cond, "left")
    return j.select(*[left[c] for c in left.columns], *[F.col("_got")[v].alias(v) for v in values])


def _fill_forward(batches: Iterator[pa.RecordBatch], cols: list[str], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Forward fill of ``cols`` in the order of the rows; what is still null then takes the carried value (``_c_``), or
    the first one of all (``_g_``). Columns: the output's, then these two for each of ``cols``."""
    last: dict[str, pa.Scalar] = {}
    for batch in batches:
        if not len(batch):
            continue
        out = {n: batch.column(n) for n in names}
        for c in cols:
            carried = batch.column(f"_c_{c}")[0]
            start = last.get(c, carried if carried.is_valid else batch.column(f"_g_{c}")[0])
            column = pc.fill_null_forward(out[c])
            out[c] = pc.fill_null(column, start) if start.is_valid else column
            last[c] = out[c][-1]
        yield pa.RecordBatch.from_arrays([out[n] for n in names], names=names)


def global_fill(df: DataFrame, order: list[str], cols: list[str]) -> DataFrame:
    """F3 (opt-in): forward fill then backward fill of ``cols`` in the global
    ``order`` (which must end with a unique key).

    A prefix scan in two phases over one range exchange. Range partitioning balances rows (a hot date is split by
    the unique key) and each partition is sorted where it lies and written once. Its edges make the carry table, one
    row per partition: the last non-null value before it (forward fill across partition edges) and the global first
    non-null value (the backward fill of leading rows). The second phase fills inside the written partitions, in their
    order, without moving a row.
    """
    ordered = F.struct(*[F.col(c) for c in order])
    # one materialised partitioning for both phases
    ensure_checkpoint_dir(df.sparkSession)
    p = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    edge = p.groupBy("_p").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordered)).alias(f"_l_{c}") for c in cols],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordered)).alias(f"_f_{c}") for c in cols])
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = edge.select("_p", *[F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in cols],
                        *[F.first(f"_f_{c}", ignorenulls=True).over(whole).alias(f"_g_{c}") for c in cols])
    # the broadcast keeps the rows of a partition in their order
    beside = p.join(F.broadcast(carry), "_p", "left").select(*df.columns, *[f"_{k}_{c}" for c in cols for k in "cg"])
    names = df.columns
    return beside.mapInArrow(lambda batches: _fill_forward(batches, cols, names), df.schema)
