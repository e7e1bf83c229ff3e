"""Dense grids and fills over aggregated tables.

These run on tables that are already aggregated (years x categories), whose
size is bounded by the calendar and the category set, not by the fact data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def densify_years(df: DataFrame, year: str, keys: list[str]) -> DataFrame:
    """Every year between the global min and max for every key present, left
    joined to ``df`` (missing cells NULL).

    The bounds come from a window over the aggregated table, so each key row
    generates its own ``sequence`` of years: no cross join is planned.
    """
    everything = Window.partitionBy()
    bounds = (df.select(*keys, F.min(year).over(everything).alias("_y0"), F.max(year).over(everything).alias("_y1"))
              .dropDuplicates(keys))
    grid = bounds.select(*keys, F.explode(F.sequence(F.col("_y0").cast("int"), F.col("_y1").cast("int"))).alias(year))
    grid = grid.withColumn(year, F.col(year).cast(df.schema[year].dataType))
    return grid.join(df, [year, *keys], "left")


def forward_fill(df: DataFrame, order: str, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Carry the last non-null value forward along ``order`` (per ``keys``)."""
    w = Window.orderBy(order) if not keys else Window.partitionBy(*keys).orderBy(order)
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(*[F.last(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c) for c in df.columns])
