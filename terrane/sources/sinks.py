"""Sinks (S13, S14) and the gold-table writer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite_or_null(df: DataFrame) -> DataFrame:
    """NaN and +-Infinity become NULL in every floating column."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_json(df: DataFrame, *paths: str, mode: str = "overwrite") -> None:
    """JSON records (NULLs written), to one or more destinations."""
    clean = finite_or_null(df)
    for p in paths:
        clean.write.mode(mode).option("ignoreNullFields", "false").json(p)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header."""
    df.write.mode(mode).option("header", "true").csv(path)


def write_gold(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write a derived table once (e.g. sale metrics) for many readers, cutting
    its lineage; optionally partitioned (e.g. by ``tx_year``) for pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
