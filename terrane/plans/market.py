"""Market analytics over the sale-metrics gold table (A1-A4, A9-A14, Q3m).

Every function takes DataFrames and returns a DataFrame. Ordering is left to the
sink; only top-k queries sort, and they end every ordering with a unique key.
Year filters compare the text year, as the stored contract does.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes, decode
from ..operators import sales
from ..operators.newest import newest_in_ranges
from ..operators.quantile import exact_quantiles


def sales_history(records: DataFrame) -> DataFrame:
    """A1: all sale metrics (ordered by ``tx_date`` desc at the sink)."""
    return sales.sale_metrics(records)


def market_trends(metrics: DataFrame, exclude_multiunit: bool = False, since_year: str = "1980") -> DataFrame:
    """A2: per (year, city) averages and counts with 3-row moving averages.

    The frame is 3 *rows*, so a gap year is skipped over, as in the reference.
    The moving-average window runs on the aggregated table (years x cities).
    """
    m = metrics.where(F.col("tx_year").isNotNull() & (F.col("tx_year") >= since_year))
    if exclude_multiunit:
        m = m.where(F.col("units").isNull() | (F.col("units") <= 1))
    yearly = m.groupBy("tx_year", "city").agg(
        F.avg("estimated_price").alias("avg_price"),
        F.avg(decode.guarded_ppsf("estimated_price")).alias("avg_ppsf"),
        F.count(F.lit(1)).alias("sales_count"))
    w = Window.partitionBy("city").orderBy("tx_year").rowsBetween(-2, 0)
    return yearly.select("tx_year", "city", "avg_price", "avg_ppsf", "sales_count",
                         F.avg("avg_price").over(w).alias("avg_price_3yr_ma"),
                         F.avg("avg_ppsf").over(w).alias("avg_ppsf_3yr_ma"))


def top_flippers(metrics: DataFrame, max_days: int = 730, min_growth: float = 20.0, k: int = 50) -> DataFrame:
    """A3: quick resales with high growth, top ``k`` by growth (map-side top-k)."""
    return (metrics.where(F.col("days_held").isNotNull() & (F.col("days_held") < max_days)
                          & (F.col("growth_pct") > min_growth))
            .orderBy(F.col("growth_pct").desc(), F.col("schno"), F.col("slot"))
            .limit(k))


def price_by_type(records: DataFrame, since_year: str = "1980", min_count: int = 5) -> DataFrame:
    """A4: yearly average price per property type (with Vacant Land)."""
    ev = sales.sale_events(records, ["abst1", "abst2"])
    return (ev.select(F.date_format("tx_date", "yyyy").alias("tx_year"),
                      decode.property_type(vacant_land=True).alias("prop_type"), "estimated_price")
            .where(F.col("tx_year") >= since_year)
            .groupBy("tx_year", "prop_type")
            .agg(F.avg("estimated_price").alias("avg_price"), F.count(F.lit(1)).alias("sales_count"))
            .where(F.col("sales_count") > min_count))


def training_data(records: DataFrame, min_price: int = 50000, min_sfla: float = 100.0,
                  after_year: str = "1995") -> DataFrame:
    """Model rows with the ML decodes."""
    carry = ["beds", "bath_tot", "sfla", "year_blt", "garage_size", "lot_size", "grade", "cond",
             "scenic_view", "town", "abst1", "abst2"]
    ev = sales.sale_events(records, carry)
    return (ev.where((F.col("estimated_price") > min_price) & (F.col("sfla") > min_sfla)
                     & (F.date_format("tx_date", "yyyy") > after_year))
            .select("schno", "tx_date", F.col("estimated_price").alias("price"), "beds",
                    F.col("bath_tot").alias("baths"), "sfla", "year_blt", "garage_size",
                    F.col("lot_size").alias("acres"), "grade", "cond", "scenic_view",
                    decode.town_city_ml("town").alias("city"),
                    decode.property_type().alias("prop_type")))


_TYPE_CODES = {"Single Family": codes.SINGLE_FAMILY_CODES, "Condo": codes.CONDO_CODES,
               "Townhouse": codes.TOWNHOUSE_CODES}
_CITY_TOWN = {v: k for k, v in codes.TOWN_CITY_ML.items()}


def comparable_sales(records: DataFrame, target_city: str, target_type: str, target_sfla: float,
                     as_of: _dt.date | str, months: int = 18, min_price: int = 50000, k: int = 50) -> DataFrame:
    """A10: the newest ``k`` sales of similar size in the last ``months`` months.

    An unknown city or type applies no filter. ``as_of`` replaces the wall clock.
    """
    lo, hi = int(target_sfla * 0.75), int(target_sfla * 1.25)
    carry = ["sfla", "beds", "bath_tot", "year_blt", "address", "town", "abst1", "abst2"]
    ev = sales.sale_events(records, carry)
    cond = ((F.col("estimated_price") > min_price)
            & (F.col("tx_date") >= F.add_months(F.lit(str(as_of)).cast("date"), -months))
            & F.col("sfla").between(lo, hi))
    town = _CITY_TOWN.get(target_city)
    if town:
        cond &= F.col("town") == town
    if target_type in _TYPE_CODES:
        vals = _TYPE_CODES[target_type]
        cond &= F.col("abst1").isin(vals) | F.col("abst2").isin(vals)
    return (ev.where(cond)
            .orderBy(F.col("tx_date").desc(), F.col("schno"), F.col("slot"))
            .limit(k)
            .select("tx_date", F.col("estimated_price").alias("price"), "sfla", "beds",
                    F.col("bath_tot").alias("baths"), "year_blt", "address",
                    F.try_divide(F.col("estimated_price") * F.lit(1.0), F.col("sfla")).alias("ppsf")))


ANY = "*"


def comparable_sales_many(records: DataFrame, subjects: DataFrame, as_of: _dt.date | str, months: int = 18,
                          min_price: int = 50000, k: int = 50) -> DataFrame:
    """A10 for a table of subjects (``subject_id, city, prop_type, sfla``), each with its newest ``k`` sales.

    Subjects and sales meet by (town, type) and size range (see ``operators/newest.py``). A subject of unknown city or
    type (no filter) meets the sales under the key for any. A subject without a size has no sales; a sale of size 0 has
    no price per square foot.
    """
    carry = ["sfla", "beds", "bath_tot", "year_blt", "address", "town", "abst1", "abst2"]
    recent = (sales.sale_events(records, carry)
              .where((F.col("estimated_price") > min_price) & F.col("sfla").isNotNull()
                     & (F.col("tx_date") >= F.add_months(F.lit(str(as_of)).cast("date"), -months))))
    types = F.array_compact(F.array(F.lit(ANY), *(F.when(F.col("abst1").isin(v) | F.col("abst2").isin(v), F.lit(t)) for t, v in _TYPE_CODES.items())))
    towns = F.array_distinct(F.array_compact(F.array(F.lit(ANY), F.when(F.col("town").isin(*_CITY_TOWN.values()), F.col("town")))))
    payload = ["tx_date", "estimated_price", "sfla", "beds", "bath_tot", "year_blt", "address"]
    keyed = recent.withColumn("_type", F.explode(types)).withColumn("_town", F.explode(towns)).select("_town", "_type", "schno", "slot", *payload)

    town = F.coalesce(*(F.when(F.col("city") == c, F.lit(t)) for c, t in _CITY_TOWN.items()), F.lit(ANY))
    kind = F.when(F.col("prop_type").isin(*_TYPE_CODES), F.col("prop_type")).otherwise(F.lit(ANY))
    asked = subjects.where(F.col("sfla").isNotNull()).select(
        "subject_id", town.alias("_town"), kind.alias("_type"), (F.col("sfla") * 0.75).cast("bigint").alias("_lo"), (F.col("sfla") * 1.25).cast("bigint").alias("_hi"))
    order = [F.col("tx_date").desc(), F.col("schno"), F.col("slot")]
    found = newest_in_ranges(keyed, asked, ["_town", "_type"], "sfla", order, k, payload)
    return found.select("subject_id", "rank", "tx_date", F.col("estimated_price").alias("price"),
                        "sfla", "beds", F.col("bath_tot").alias("baths"), "year_blt", "address",
                        F.try_divide(F.col("estimated_price") * F.lit(1.0), F.col("sfla")).alias("ppsf"))


def seasonality(metrics: DataFrame, after_year: str = "2010") -> DataFrame:
    """Sales by calendar month and city."""
    return (metrics.where(F.col("tx_year") > after_year)
            .groupBy(F.date_format("tx_date", "MM").alias("month_num"),
                     decode.month_abbr("tx_date").alias("month_name"), "city")
            .agg(F.count(F.lit(1)).alias("sales_count"),
                 F.avg(decode.guarded_ppsf("estimated_price")).alias("avg_ppsf"),
                 F.avg("estimated_price").alias("avg_price")))


def renovation_impact(metrics: DataFrame, after_year: str = "2000") -> DataFrame:
    """Renovated vs original condition per year."""
    status = F.when(F.col("is_renovated") == 1, "Renovated").otherwise("Original Condition")
    return (metrics.where(F.col("tx_year") > after_year)
            .groupBy("tx_year", status.alias("status"))
            .agg(F.count(F.lit(1)).alias("sales_count"), F.avg("estimated_price").alias("avg_price"),
                 F.avg(decode.guarded_ppsf("estimated_price")).alias("avg_ppsf"),
                 F.avg("growth_pct").alias("avg_appreciation")))


def cumulative_supply_by_type(records: DataFrame, min_year: int = 1900) -> DataFrame:
    """Units by (year, type), densified to every year x type, with the
    running total carried through empty years (leading years are 0)."""
    from ..operators.densify import densify_years

    yearly = (records.where(F.col("year_blt").isNotNull() & (F.col("year_blt") > min_year) & (F.col("sfla") > 0))
              .groupBy("year_blt", decode.property_type().alias("prop_type"))
              .agg(F.sum("units").alias("new_units")))
    dense = densify_years(yearly, "year_blt", ["prop_type"])
    w = Window.partitionBy("prop_type").orderBy("year_blt").rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.col("new_units"), F.lit(0)).cast("bigint")
    return dense.select("year_blt", "prop_type", filled.alias("new_units"),
                        F.sum(filled).over(w).alias("cumulative_units"))


def price_band_evolution(metrics: DataFrame, after_year: str = "1990") -> DataFrame:
    """Counts per band relative to the exact annual median price."""
    m = metrics.where(F.col("tx_year") > after_year).select("tx_year", "estimated_price")
    med = exact_quantiles(m, ["tx_year"], "estimated_price", {"annual_median": 0.5})
    pct = F.col("estimated_price") / F.col("annual_median") * 100
    band = None
    for bound, label, op in codes.PRICE_BANDS:
        cond = pct < bound if op == "lt" else pct <= bound
        band = F.when(cond, label) if band is None else band.when(cond, label)
    band = band.otherwise(codes.PRICE_BAND_TOP)
    return (m.join(med, "tx_year").groupBy("tx_year", band.alias("price_band"))
            .agg(F.count(F.lit(1)).alias("sales_count")))


def dataset_sample(metrics: DataFrame, limit: int = 1000) -> DataFrame:
    """Q3m: newest ``limit`` sales (a sampling feature; ties broken by key)."""
    return metrics.orderBy(F.col("tx_date").desc(), F.col("schno"), F.col("slot")).limit(limit)
