"""Geospatial enrichment.

Points are cleaned and reduced to one row per parcel with a partial aggregate
(G1), joined to sales on the parcel id (G2), and measured against literal
resort points (G3) by column expressions, or against a table of lift-line
segments (G4) by a grid join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, codes, decode
from ..functions import geo as g

DIST_COLS = list(codes.RESORT_POINTS)


def clean_address_points(points: DataFrame, id_col: str = "property_schedule", lat: str = "latitude",
                         lon: str = "longitude", address: str = "full_address", order: str | None = None) -> DataFrame:
    """G1: drop rows without id or coordinates, normalise the id ('12.0' -> '12'),
    and keep per id the first non-null value of each column (first by ``order``,
    default the whole row; file reads carry file, block and row position). A
    partial aggregate, so repeated ids are reduced before the shuffle."""
    pos = F.col(order) if order else F.struct(id_col, lat, lon, address)
    p = points.where(F.col(id_col).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull())
    p = p.withColumn("schno", clean.clean_id(id_col)).withColumn("_pos", pos)

    def first(c):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_pos")))
    return p.groupBy("schno").agg(first(lat).alias("latitude"), first(lon).alias("longitude"),
                                  first(address).alias("full_address"))


def join_coordinates(sales: DataFrame, points: DataFrame) -> DataFrame:
    """Left join coordinates on the parcel id text."""
    return sales.withColumn("schno", F.col("schno").cast("string")).join(points, "schno", "left")


def resort_point_distances(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Miles to the nearest lift point of each resort (NULL without coordinates)."""
    has = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return df.withColumns({name: F.when(has, g.nearest_point_miles(F.col(lat), F.col(lon), pts))
                           for name, pts in codes.RESORT_POINTS.items()})


#: Side of the smallest grid cells in metres; the cells of level k are 2**k times as wide.
CELL_METRES, LEVELS = 500.0, 21
#: Longer segments are cut into equal pieces, so that few cells cover each.
PIECE_METRES = 4000.0


def resort_segments(segments: DataFrame) -> DataFrame:
    """resort, x1, y1, x2, y2 in UTM metres: pieces of the line segments (name, x1, y1, x2, y2 in degrees) that carry
    one of a resort's name keywords (case-insensitive substring)."""
    own = [F.when(F.lower("name").rlike("|".join(re.escape(w.lower()) for w in words)), F.lit(resort))
           for resort, words in codes.RESORT_LIFT_KEYWORDS.items()]
    named = segments.select(F.explode(F.array_compact(F.array(*own))).alias("resort"), "x1", "y1", "x2", "y2")
    (xa, ya), (xb, yb) = g.utm_forward(F.col("y1"), F.col("x1")), g.utm_forward(F.col("y2"), F.col("x2"))
    whole = named.select("resort", xa.alias("xa"), ya.alias("ya"), (xb - xa).alias("dx"), (yb - ya).alias("dy"))
    n = F.greatest(F.lit(1), F.ceil(F.hypot("dx", "dy") / PIECE_METRES))
    cut = whole.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))

    def at(start: str, step: str, k: Column) -> Column:
        return F.col(start) + F.col(step) * k / F.col("n")

    return cut.select("resort", at("xa", "dx", F.col("k")).alias("x1"), at("ya", "dy", F.col("k")).alias("y1"),
                      at("xa", "dx", F.col("k") + 1).alias("x2"), at("ya", "dy", F.col("k") + 1).alias("y2"))


def segment_cells(segments: DataFrame) -> DataFrame:
    """The segments with every grid cell (level, cx, cy) that comes within one cell's width of them, at all levels."""
    wide = segments.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    side = F.lit(CELL_METRES) * F.pow(F.lit(2.0), F.col("level"))

    def cells(a: str, b: str) -> Column:
        low, high = F.floor(F.least(a, b) / side) - 1, F.floor(F.greatest(a, b) / side) + 1
        return F.explode(F.sequence(low, high))

    return wide.withColumn("cx", cells("x1", "x2")).withColumn("cy", cells("y1", "y2"))


def nearest_segments(points: DataFrame, segments: DataFrame) -> DataFrame:
    """lat, lon and metres to the nearest segment of each resort, one column each (null: it has none).

    Each resort has an anchor (an end of one of its segments), so a point's nearest segment is no farther than that.
    The point looks it up in the grid of the first level whose cells are as wide as this bound: a segment within the
    bound reaches the point's cell or one beside it, and ``segment_cells`` lists it there. One equi join, exact.
    """
    anchors = segments.groupBy("resort").agg(F.min(F.struct("x1", "y1")).alias("anchor"))
    x, y = g.utm_forward(F.col("lat"), F.col("lon"))
    asked = (points.select("lat", "lon", x.alias("x"), y.alias("y"), F.explode(F.array(*map(F.lit, DIST_COLS))).alias("resort"))
             .join(anchors, "resort"))
    bound = F.hypot(F.col("x") - F.col("anchor.x1"), F.col("y") - F.col("anchor.y1")) * (1 + 1e-9)
    level = F.greatest(F.lit(0), F.ceil(F.log2(bound / CELL_METRES))).cast("int")
    side = F.lit(CELL_METRES) * F.pow(F.lit(2.0), F.col("level"))
    asked = (asked.withColumn("level", level).withColumn("cx", F.floor(F.col("x") / side)).withColumn("cy", F.floor(F.col("y") / side))
             .drop("anchor"))
    met = asked.join(segment_cells(segments), ["resort", "level", "cx", "cy"])
    metres = g.segment_metres(F.col("x"), F.col("y"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    return met.groupBy("lat", "lon").agg(*(F.min(F.when(F.col("resort") == r, metres)).alias(r) for r in DIST_COLS))


def lift_line_distances(df: DataFrame, segments: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Miles from each row's point to the union of each resort's lift lines, in UTM 13N metres; a resort without
    matching lines falls back to its points (G3). ``segments``: name, x1, y1, x2, y2 in degrees (S11).

    The distances are looked up once per distinct point.
    """
    points = df.select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).where("lat IS NOT NULL AND lon IS NOT NULL").distinct()
    found = nearest_segments(points, resort_segments(segments)).withColumnsRenamed({r: f"_{r}" for r in DIST_COLS})
    joined = resort_point_distances(df, lat, lon).join(found, (F.col(lat) == F.col("lat")) & (F.col(lon) == F.col("lon")), "left")
    miles = {r: F.coalesce(F.col(f"_{r}") * codes.METRES_TO_MILES, F.col(r)) for r in DIST_COLS}
    return joined.withColumns(miles).drop("lat", "lon", *(f"_{r}" for r in DIST_COLS))


def nearest_lift(df: DataFrame) -> DataFrame:
    """Distance to the nearest of the four ski resorts (Dillon excluded);
    NULLs are skipped and an infinite result becomes NULL."""
    d = F.least(*[F.col(c) for c in codes.LIFT_RESORTS])
    return df.withColumn("dist_to_lift", F.when(~F.abs(d).eqNullSafe(F.lit(float("inf"))), d))


def geo_export(df: DataFrame, price: str = "price") -> DataFrame:
    """Rows of the listed cities with coordinates and a lift distance."""
    return (df.where(F.col("city").isin(codes.GEO_EXPORT_CITIES)
                     & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                     & F.col("dist_to_lift").isNotNull())
            .select(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "dist_to_lift", "address",
                    "city", F.coalesce(F.col(price), F.lit(0)).alias("price")))


def default_distances(df: DataFrame, city: str = "city") -> DataFrame:
    """Resort distances from a literal by-city table (unknown city -> the
    default city's row); each row's explicit ``dist_to_lift`` wins, then its own
    resort distances, then the city default."""
    fallback = codes.CITY_DEFAULT_DISTANCES[codes.DEFAULT_DISTANCE_CITY]
    cols = {}
    for name in DIST_COLS:
        m = {c: float(v[name]) for c, v in codes.CITY_DEFAULT_DISTANCES.items()}
        dflt = decode.decode(city, m, float(fallback[name]))
        cols[name] = F.coalesce(F.col(name), dflt) if name in df.columns else dflt
    out = df.withColumns(cols)
    own = F.least(*[F.col(c) for c in codes.LIFT_RESORTS])
    lift = F.coalesce(F.col("dist_to_lift"), own) if "dist_to_lift" in df.columns else own
    model_city = F.when(F.col(city) == "COPPER MOUNTAIN", F.lit("COPPERMOUNTAIN")).otherwise(F.col(city))
    return out.withColumns({"dist_to_lift": lift, "model_city": model_city})


def distance_stats(df: DataFrame, city_value: str, col: str = "dist_to_lift", outlier: float = 10.0) -> DataFrame:
    """Count, mean, std, min, quartiles, max and outliers (> ``outlier``)
    of one city's distances. Quartiles are exact (linear interpolation) and
    bounded per task (see ``exact_quantiles``); both parts are keyed by city."""
    from .quantile import exact_quantiles

    d = df.where(F.col("city") == city_value).select("city", F.col(col).cast("double").alias("d"))
    basic = d.groupBy("city").agg(
        F.count("d").alias("count"), F.avg("d").alias("mean"), F.stddev_samp("d").alias("std"),
        F.min("d").alias("min"), F.max("d").alias("max"),
        F.sum(F.when(F.col("d") > outlier, 1).otherwise(0)).cast("bigint").alias("outliers"))
    q = exact_quantiles(d, ["city"], "d", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return basic.join(q, "city", "left")


def mean_distance_by_city(df: DataFrame) -> DataFrame:
    """Mean resort distances per city."""
    return df.groupBy("city").agg(*[F.avg(c).alias(c) for c in DIST_COLS])


def distance_colours(df: DataFrame, col: str = "dist_to_lift", max_miles: float = 10.0) -> DataFrame:
    """Q3p: map colour channels from the lift distance clipped at ``max_miles``
    (near = red, far = blue)."""
    norm = F.least(F.col(col), F.lit(max_miles)) / max_miles
    return df.withColumns({"dist_clamped": F.least(F.col(col), F.lit(max_miles)), "norm": norm,
                           "r": (1 - norm) * 255, "g": F.lit(50), "b": norm * 255})


def first_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """T4: the first row per key in ``order`` (plain ascending expressions; negate
    for descending). A partial aggregate, not a window."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(key, "_r.*")
