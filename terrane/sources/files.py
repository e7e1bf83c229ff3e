"""File sources (S1, S8-S11, S15) and a shared scratch area.

Readers declare schemas where the format allows it; inference (S8) is kept
for ad-hoc files only. Scratch data goes under the cluster's shared
``spark.checkpoint.dir``, never a machine-local folder.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .csv_records import parse_records, read_records

CSV_TEXT_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                    "escape": '"'}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def read_text_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                  position: str | None = None) -> DataFrame:
    """Every column as text (no inference, no coercion); the caller applies
    the missing-value tokens. Without ``columns`` the header names are used.
    Line breaks inside quotes belong to their value, and files split all the same
    (``csv_records``). ``position`` names a column for the record's place in the
    input (file, split, line), in input order."""
    options = {k: v for k, v in CSV_TEXT_OPTIONS.items() if k != "header"}
    rows = parse_records(read_records(spark, path), columns, options)
    return rows.withColumnRenamed("pos", position) if position else rows.drop("pos")


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ad-hoc CSV with inferred types (one extra pass over the file)."""
    return spark.read.options(header="true", inferSchema="true").csv(path)


MACRO_SCHEMA = "date date, value double, year int"


def read_macro_series(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Named macro series ``(date, value, year)``; a missing file is skipped."""
    out = {}
    for name, path in paths.items():
        if _exists(spark, path):
            out[name] = spark.read.options(header="true").schema(MACRO_SCHEMA).csv(path)
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_address_points(spark: SparkSession, root: str, pattern: str = "Address_Points*.csv") -> DataFrame:
    """Every file matching ``pattern`` anywhere under ``root``."""
    return (spark.read.options(header="true", recursiveFileLookup="true", pathGlobFilter=pattern)
            .schema("PropertySchedule string, LATITUDE double, LONGITUDE double, FullAddress string").csv(root)
            .select(F.col("PropertySchedule").alias("property_schedule"), F.col("LATITUDE").alias("latitude"),
                    F.col("LONGITUDE").alias("longitude"), F.col("FullAddress").alias("full_address"),
                    F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                             F.monotonically_increasing_id()).alias("position")))


GEOJSON_SCHEMA = ("type string, features array<struct<type: string, properties: map<string, string>, "
                  "geometry: struct<type: string, coordinates: array<array<double>>>>>")


def read_lift_lines(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON LineStrings -> ``(name, coords array<struct<x, y>>)``."""
    fc = spark.read.option("multiLine", "true").schema(GEOJSON_SCHEMA).json(path)
    f = fc.select(F.explode("features").alias("f")).where(F.col("f.geometry.type") == "LineString")
    return f.select(F.col("f.properties")["name"].alias("name"),
                    F.transform("f.geometry.coordinates", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
                    .alias("coords"))


def lift_segments(lines: DataFrame) -> DataFrame:
    """Consecutive coordinate pairs of each line as segments."""
    n = F.size("coords")
    return lines.select("name", F.explode(F.arrays_zip(F.slice("coords", 1, n - 1), F.slice("coords", 2, n)))
                        .alias("s")).select("name", F.col("s.0.x").alias("x1"), F.col("s.0.y").alias("y1"),
                                            F.col("s.1.x").alias("x2"), F.col("s.1.y").alias("y2"))


def write_geojson_lines(path: str, lines: list[tuple[str, list[tuple[float, float]]]]) -> None:
    """Helper for tests and local runs: a small GeoJSON FeatureCollection."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    feats = [{"type": "Feature", "properties": {"name": n},
              "geometry": {"type": "LineString", "coordinates": [list(p) for p in pts]}} for n, pts in lines]
    with open(path, "w") as fh:
        json.dump({"type": "FeatureCollection", "features": feats}, fh)


def freshness(df: DataFrame) -> DataFrame:
    """Data freshness of a file-based DataFrame: files, latest file
    modification time, rows, and the time of this export."""
    m = df.select("_metadata.file_path", "_metadata.file_modification_time")
    return m.agg(F.countDistinct("file_path").alias("files"),
                 F.max("file_modification_time").alias("latest_file_time"),
                 F.count(F.lit(1)).alias("rows"), F.current_timestamp().alias("exported_at"))
