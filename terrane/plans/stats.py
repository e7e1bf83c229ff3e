"""Statistics over the aggregated market tables.

The inputs here are already aggregates (years x categories), so windows over
them run on small tables; every fact-sized step is a grouped aggregate.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.stats import pearson_p_value
from .supply import annual_series

LOC_COLS = {codes.LOCATION_LOCAL: "local_count", codes.LOCATION_IN_STATE: "in_state_count",
            codes.LOCATION_OUT_OF_STATE: "out_of_state_count"}


def annual_mean(series: DataFrame, since_year: int = 1980) -> DataFrame:
    """Yearly mean of a macro series, from ``since_year``."""
    return annual_series(series, "value").where(F.col("year") >= since_year)


def buyer_share_pivot(trends: DataFrame) -> DataFrame:
    """Purchase year x buyer origin counts (explicit pivot values, so no
    extra job to find them), zero-filled, with the total and percent shares."""
    p = (trends.groupBy("purchase_year").pivot("location_type", list(LOC_COLS))
         .agg(F.sum("buyer_count")))
    for label, name in LOC_COLS.items():
        p = p.withColumnRenamed(label, name)
    p = p.fillna(0, subset=list(LOC_COLS.values()))
    total = sum(F.col(c) for c in LOC_COLS.values())
    out = p.select("purchase_year", F.col("purchase_year").cast("int").alias("year"),
                   *[F.col(c).cast("bigint").alias(c) for c in LOC_COLS.values()], total.cast("bigint").alias("total_volume"))
    return out.select("*", *[(F.col(c) / F.col("total_volume") * 100).alias(c.replace("_count", "_share"))
                             for c in LOC_COLS.values()])


def rate_delta(series: DataFrame) -> DataFrame:
    """Annual mean rate and its change from the previous year's row."""
    a = annual_series(series, "rate")
    return a.select("year", "rate", (F.col("rate") - F.lag("rate").over(Window.orderBy("year"))).alias("rate_delta"))


def buyer_rate_frame(pivot: DataFrame, series: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Buyer shares joined by year to the annual rate and its change (and an
    annual index with returns when given), inner joins as in the reference."""
    out = pivot.join(rate_delta(series), "year", "inner")
    if index is not None:
        out = out.join(index, "year", "inner")
    return out


def share_rate_correlations(frame: DataFrame) -> DataFrame:
    """Pearson correlation of each buyer share with the annual rate
    (pairwise complete: ``corr`` skips rows where either side is NULL)."""
    return frame.agg(*[F.corr(c, "rate").alias(f"corr_{c}") for c in
                       ("local_share", "in_state_share", "out_of_state_share")],
                     F.corr("in_state_share", "rate_delta").alias("corr_in_state_share_delta"))


def correlation_matrix(frame: DataFrame, cols: list[str], digits: int = 3) -> DataFrame:
    """Full correlation matrix in long form ``(var_a, var_b, r)``, rounded.

    One aggregate computes the n(n+1)/2 distinct pairs; the mirror half is
    produced by an ``inline`` of both orders, so the data is scanned once.
    """
    pairs = list(combinations_with_replacement(cols, 2))
    agg = frame.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    structs = []
    for i, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"c{i}").alias("r")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("var_a"), F.lit(a).alias("var_b"), F.col(f"c{i}").alias("r")))
    return agg.select(F.inline(F.array(*structs))).select("var_a", "var_b", F.round("r", digits).alias("r"))


def correlation_test(frame: DataFrame, x: str, y: str) -> DataFrame:
    """R, two-sided p-value, strength label and significance; needs n > 2
    complete pairs (else no row)."""
    complete = frame.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    a = complete.agg(F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 2)
    strength = (F.when(F.abs("r") > codes.CORR_STRONG, "Strong")
                .when(F.abs("r") > codes.CORR_MODERATE, "Moderate").otherwise("Weak"))
    p = pearson_p_value(F.col("r"), F.col("n").cast("double"))
    return (a.select("r", "n", p.alias("p_value"), strength.alias("strength"))
            .withColumn("significant", F.col("p_value") < codes.SIGNIFICANCE))


def trend_line(frame: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept with the end points at min/max x."""
    a = frame.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("x_min"), F.max(x).alias("x_max"))
    return a.select("*", (F.col("slope") * F.col("x_min") + F.col("intercept")).alias("y_at_min"),
                    (F.col("slope") * F.col("x_max") + F.col("intercept")).alias("y_at_max"))


def out_of_state_share(trends: DataFrame, year: int) -> DataFrame:
    """Out-of-state buyers as a percent of the year's buyers (0 if none)."""
    t = trends.where(F.col("purchase_year").cast("int") == year)
    a = t.agg(F.sum("buyer_count").alias("total"),
              F.sum(F.when(F.col("location_type") == codes.LOCATION_OUT_OF_STATE, F.col("buyer_count"))
                    .otherwise(0)).alias("oos"))
    return a.select(F.lit(year).alias("year"),
                    F.coalesce(F.try_divide(F.col("oos") * F.lit(100.0), F.col("total")), F.lit(0.0))
                    .alias("out_of_state_share"))


def headline_metrics(trends: DataFrame, min_volume: int = 50, default_year: int = 2023) -> DataFrame:
    """The latest year with more than ``min_volume`` sales, the mean of the
    city averages in that year and its volume."""
    t = trends.withColumn("year", F.col("tx_year").cast("int"))
    vol = t.groupBy("year").agg(F.sum("sales_count").alias("vol"))
    target = vol.agg(F.coalesce(F.max(F.when(F.col("vol") > min_volume, F.col("year"))), F.lit(default_year))
                     .alias("target_year"))
    return (target.join(t, t.year == target.target_year, "left")
            .groupBy("target_year")
            .agg(F.avg("avg_price").alias("avg_price"), F.coalesce(F.sum("sales_count"), F.lit(0)).alias("volume")))


def cross_city_trend(trends: DataFrame, cities: list[str] = codes.TREND_CITIES) -> DataFrame:
    """Per year, the average over the listed cities of the 3-year moving
    average price; years whose average is not positive are dropped."""
    return (trends.where(F.col("city").isin(cities)).groupBy("tx_year")
            .agg(F.avg("avg_price_3yr_ma").alias("avg_price_3yr_ma"))
            .where(F.col("avg_price_3yr_ma") > 0))


def month_city_volume(seasonal: DataFrame) -> DataFrame:
    """Month x city sales volume, every calendar month for every city
    present (missing -> 0), with the month's calendar position."""
    months = F.array(*[F.struct(F.lit(i + 1).alias("month_pos"), F.lit(m).alias("month_name"))
                       for i, m in enumerate(codes.MONTH_ABBR)])
    grid = seasonal.select("city").distinct().select("city", F.inline(months))
    vol = seasonal.groupBy("month_name", "city").agg(F.sum("sales_count").alias("sales_count"))
    return (grid.join(vol, ["month_name", "city"], "left")
            .select("month_pos", "month_name", "city", F.coalesce("sales_count", F.lit(0)).cast("bigint")
                    .alias("sales_count")))


def slot_coverage(records: DataFrame, slots: int = 4) -> DataFrame:
    """Per sale slot, dates present, fees present and market sales (fee > 0),
    plus the parcels with more than one market sale, in one aggregate."""
    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0))
    market = [F.when(F.col(f"docfee{i}") > 0, 1).otherwise(0) for i in range(1, slots + 1)]
    aggs = [F.count(F.lit(1)).alias("total_rows"), cnt(sum(market) > 1).alias("multi_sale_properties")]
    for i in range(1, slots + 1):
        aggs += [cnt(F.col(f"recdate{i}").isNotNull()).alias(f"d{i}"), cnt(F.col(f"docfee{i}").isNotNull()).alias(f"f{i}"),
                 cnt(F.col(f"docfee{i}") > 0).alias(f"m{i}")]
    a = records.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(str(i)).alias("slot"), F.col(f"d{i}").alias("dates_present"),
                              F.col(f"f{i}").alias("fees_present"), F.col(f"m{i}").alias("market_sales"))
                     for i in range(1, slots + 1)])
    return a.select("total_rows", "multi_sale_properties", F.inline(rows))


def reconciliation(owner_trends: DataFrame, records: DataFrame, trends_columns: list[str],
                   tolerance: int = 5000) -> DataFrame:
    """Analysis total vs record count within a tolerance, and the check that
    the price-trend output carries no buyer-origin column."""
    # both totals come from one aggregate over a union: no join of two 1-row tables
    u = (owner_trends.select(F.col("buyer_count").cast("bigint").alias("_bc"), F.lit(0).alias("_rc"))
         .unionByName(records.select(F.lit(None).cast("bigint").alias("_bc"), F.lit(1).alias("_rc"))))
    j = u.agg(F.coalesce(F.sum("_bc"), F.lit(0)).cast("bigint").alias("analysis_total"),
              F.sum("_rc").cast("bigint").alias("record_count"))
    return j.select("analysis_total", "record_count",
                    (F.abs(F.col("analysis_total") - F.col("record_count")) < tolerance).alias("within_tolerance"),
                    F.lit("location_type" not in trends_columns).alias("trends_free_of_buyer_origin"))


def distinct_years(trends: DataFrame) -> DataFrame:
    """The distinct years present."""
    return trends.select("tx_year").distinct()
