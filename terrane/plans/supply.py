"""Supply timelines.

Each aggregates the parcel table to one row per year first; running totals and
fills are windows over that small table (years only), so one partition is fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes, decode
from ..operators.densify import forward_fill

def _run():
    return Window.orderBy("year_blt").rowsBetween(Window.unboundedPreceding, 0)


def cumulative_supply(records: DataFrame, min_year: int = 1900) -> DataFrame:
    """A5: residential structures built per year and running totals. The code
    test reads ``abst1`` as an integer the way SQLite does ('12ab' -> 12)."""
    code = decode.sqlite_int("abst1")
    y = (records.where(F.col("year_blt").isNotNull() & (F.col("year_blt") > min_year) & (F.col("sfla") > 0)
                       & (code.between(1000, 1999) | (F.col("abst1").isNull() & (F.col("sfla") > 0))))
         .groupBy("year_blt").agg(F.sum("units").alias("units_built"), F.sum("sfla").alias("sqft_built")))
    return y.select("year_blt", "units_built", F.sum("units_built").over(_run()).alias("cumulative_units"),
                    F.sum("sqft_built").over(_run()).alias("cumulative_sqft"))


def supply_timeline(records: DataFrame) -> DataFrame:
    """Parcels and living area per build year, cumulated (no year filter;
    parcels without a build year are not grouped)."""
    y = (records.where(F.col("year_blt").isNotNull()).groupBy("year_blt")
         .agg(F.count(F.lit(1)).alias("units"), F.coalesce(F.sum("sfla"), F.lit(0.0)).alias("sqft")))
    return y.select("year_blt", F.sum("units").over(_run()).alias("cumulative_units"),
                    F.sum("sqft").over(_run()).alias("cumulative_sqft"))


def hotel_growth(frame: DataFrame, since_year: int = 1970) -> DataFrame:
    """Commercial building growth; units default to 1; totals cumulate over
    all years before the ``since_year`` filter is applied."""
    y = (frame.where((F.col("building_type") == "Commercial") & F.col("year_blt").isNotNull())
         .groupBy("year_blt")
         .agg(F.sum(F.coalesce(F.col("units"), F.lit(1))).alias("new_units"),
              F.coalesce(F.sum("sfla"), F.lit(0.0)).alias("new_sfla")))
    out = y.select("year_blt", "new_units", "new_sfla", F.sum("new_units").over(_run()).alias("cumulative_units"),
                   F.sum("new_sfla").over(_run()).alias("cumulative_sfla"))
    return out.where(F.col("year_blt") >= since_year)


def annual_series(series: DataFrame, name: str, date_col: str = "date", value_col: str = "value") -> DataFrame:
    """One row per year: the mean of a (monthly or quarterly) series."""
    return (series.groupBy(F.year(date_col).alias("year"))
            .agg(F.avg(value_col).alias(name)))


def contextual_growth(timeline: DataFrame, series: dict[str, DataFrame]) -> DataFrame:
    """The supply timeline left-joined by year to annual series, forward
    filled in year order. Each series is reduced to one row per year first, so
    a quarterly series does not multiply timeline rows."""
    out = timeline
    for name, s in series.items():
        ann = annual_series(s, name).withColumnRenamed("year", "year_blt")
        out = out.join(ann, "year_blt", "left")
    return forward_fill(out, "year_blt", [c for c in out.columns if c != "year_blt"])


def interpolate_population(spark: SparkSession, years: DataFrame, known=codes.KNOWN_POPULATION,
                           year_col: str = "year_blt") -> DataFrame:
    """Linear interpolation of population between known years, clamped to
    the first and last known value outside them.

    The known points are a fixed literal list. Their interior is expanded to one
    row per covered year (bounded by the span of known years, not by the data)
    and broadcast; each row finds its value by an equi join on the year.
    """
    pts = sorted((int(y), float(p)) for y, p in known)
    rows = []
    for (y0, p0), (y1, p1) in zip(pts, pts[1:]):
        rows += [(y, p0 + (y - y0) / (y1 - y0) * (p1 - p0)) for y in range(y0, y1)]
    interior = spark.createDataFrame(rows, "_y int, _pop double")
    (ymin, pmin), (ymax, pmax) = pts[0], pts[-1]
    j = years.join(F.broadcast(interior), F.col(year_col) == F.col("_y"), "left")
    pop = (F.when(F.col(year_col) <= ymin, F.lit(pmin))
           .when(F.col(year_col) >= ymax, F.lit(pmax))
           .otherwise(F.col("_pop")))
    return j.select(*years.columns, pop.alias("population"))


def supply_per_resident(spark: SparkSession, supply: DataFrame, since_year: int = 1960) -> DataFrame:
    """Cumulative living area per resident, population interpolated."""
    j = interpolate_population(spark, supply.select("year_blt", "cumulative_sqft"))
    return (j.where(F.col("year_blt") >= since_year)
            .select("year_blt", "cumulative_sqft", "population",
                    (F.col("cumulative_sqft") / F.col("population")).alias("per_capita")))


def known_population(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(codes.KNOWN_POPULATION, "year int, population int")


def supply_population_join(supply: DataFrame, population: DataFrame) -> DataFrame:
    """J3/A35 plain form: inner join of supply and known population on the year."""
    return (supply.join(F.broadcast(population), supply.year_blt == population.year, "inner")
            .select("year_blt", "cumulative_sqft", "population",
                    (F.col("cumulative_sqft") / F.col("population")).alias("sqft_per_resident")))
