"""Global row positions without a single-partition window (F10, F13 support).

``global_rank`` is a DataFrame ``zipWithIndex``: rows are range partitioned on
the ordering (a unique tie-break key splits a hot value across partitions),
sorted within each partition, numbered locally, and offset by the row counts
of earlier partitions (a table with one row per partition, broadcast back).
The range-partitioned rows are checkpointed once (reliably, in the shared
checkpoint folder): the local numbering and the per-partition counts must see
the same partitioning, and two independently planned range exchanges (column
pruning makes the two branches differ) need not pick the same boundaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def global_rank(df: DataFrame, order: list, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (which must be a total order)."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    p = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("_p", F.spark_partition_id())
         .withColumn("_local", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition index << 33) + row index in partition
    p = p.withColumn("_local", F.col("_local") - F.shiftleft(F.col("_p").cast("bigint"), 33))
    ensure_checkpoint_dir(df.sparkSession)
    p = p.checkpoint(eager=True)
    counts = p.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (p.join(F.broadcast(offsets), "_p")
            .withColumn(name, F.col("_off") + F.col("_local"))
            .drop("_p", "_local", "_off"))
