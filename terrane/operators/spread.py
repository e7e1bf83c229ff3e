"""Rows dealt evenly over all cores, before steps whose work per row is large.

Adaptive execution joins the partitions behind a shuffle by their bytes. Where a row costs much more than its bytes (a
parsed page, a row scored for a whole grid, a tree's training row), that leaves most cores without work.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

#: Tasks per core, so that the last ones to end are short; rows that are worth a task of their own.
TASKS_PER_CORE, LEAST_ROWS = 4, 10_000


def task_count(spark: SparkSession, rows: int | None = None) -> int:
    """Tasks for work that costs more than its bytes; fewer where ``rows`` (their number, if known) is small."""
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return tasks if rows is None else max(1, min(tasks, math.ceil(rows / LEAST_ROWS)))


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The same rows in a number of partitions that adaptive execution keeps; as they are, where ``rows`` (their number,
    if known) is small."""
    tasks = task_count(df.sparkSession, rows)
    return df.repartition(tasks) if tasks > 1 else df
