"""Checks and curves that the project plans beside its dashboard: drift of features, coverage, price per square foot by
size, holding periods and purchase cohorts.

Distances between samples come from merged counts per value: every row is reduced map-side, a value that many rows
share is one row, and running counts are taken inside bins, so no feature is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantile import exact_quantiles

#: Bins inside which running counts are taken.
RUN_BINS = 64
#: A share below this counts as this in the stability index, so that an empty bin has a finite part.
LEAST_SHARE = 1e-4
STABLE, SHIFTED = 0.1, 0.25


def long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """feature, value: one row per value that is there."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]))).where(
        F.col("value").isNotNull() & ~F.isnan("value"))


def _counts(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """feature, value, a, b: rows of the reference and of the current sample."""
    both = long_values(reference, cols).withColumn("own", F.lit(1)).unionByName(long_values(current, cols).withColumn("own", F.lit(0)))
    return both.groupBy("feature", "value").agg(F.sum("own").alias("a"), F.sum(1 - F.col("own")).alias("b"))


def _bin(value: Column, edges: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e < value))


def ks_distance(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """feature, n_reference, n_current, ks: the largest difference of the two cumulative shares (Kolmogorov-Smirnov),
    exact."""
    counts = _counts(reference, current, cols)
    levels = [k / RUN_BINS for k in range(1, RUN_BINS)]
    edges = counts.groupBy("feature").agg(F.percentile_approx("value", levels, 1000).alias("edges"))
    binned = counts.join(edges, "feature").withColumn("bin", _bin(F.col("value"), F.col("edges"))).drop("edges")
    totals = binned.groupBy("feature", "bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    feature = Window.partitionBy("feature")  # one row per feature and bin
    before = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("feature", "bin", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in "ab"],
                          *[F.sum(c).over(feature).alias(f"{c}_all") for c in "ab"])
    run = Window.partitionBy("feature", "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = binned.select("feature", "bin", *[F.sum(c).over(run).alias(c) for c in "ab"]).join(carry, ["feature", "bin"])
    share = {c: F.try_divide(F.col(f"{c}_before") + F.col(c), F.col(f"{c}_all")) for c in "ab"}
    return upto.groupBy("feature").agg(F.max("a_all").alias("n_reference"), F.max("b_all").alias("n_current"),
                                       F.max(F.abs(share["a"] - share["b"])).alias("ks"))


def stability_index(reference: DataFrame, current: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """feature, psi: the population stability index over the reference's quantile bins."""
    names = {f"q{k}": k / bins for k in range(1, bins)}
    edges = exact_quantiles(long_values(reference, cols), ["feature"], "value", names).select("feature", F.array(*names).alias("edges"))
    binned = _counts(reference, current, cols).join(edges, "feature").groupBy("feature", _bin(F.col("value"), F.col("edges")).alias("bin")).agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    feature = Window.partitionBy("feature")
    share = {c: F.greatest(F.try_divide(F.col(c), F.sum(c).over(feature)), F.lit(LEAST_SHARE)) for c in "ab"}
    part = (share["b"] - share["a"]) * F.log(share["b"] / share["a"])
    return binned.select("feature", part.alias("part")).groupBy("feature").agg(F.sum("part").alias("psi"))


def drift(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """Both distances per feature and a verdict by the usual limits of the stability index."""
    both = ks_distance(reference, current, cols).join(stability_index(reference, current, cols), "feature", "left")
    verdict = F.when(F.col("psi") < STABLE, "stable").when(F.col("psi") < SHIFTED, "moderate").when(F.col("psi").isNotNull(), "shifted")
    return both.withColumn("verdict", verdict)


def coverage(df: DataFrame, cols: list[str], least: float = 0.9) -> DataFrame:
    """column, n, present, share, enough: how many rows have a value, from one aggregate."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{k}") for k, c in enumerate(cols)])
    rows = counted.select("n", F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{k}").alias("present")) for k, c in enumerate(cols)])))
    share = F.try_divide(F.col("present"), F.col("n"))
    return rows.select("column", "n", "present", share.alias("share"), (share >= least).alias("enough"))


def size_curve(metrics: DataFrame, step: float = 100.0, reach: int = 5, min_price: int = 50000, min_size: int = 100) -> DataFrame:
    """size_from, n, avg_ppsf, fitted_ppsf, slope: price per square foot by size, with a local linear regression.

    The regression needs no rows: per bin of ``step`` square feet it takes five moments, and each bin's fit weighs the
    moments of the bins up to ``reach`` away by the tricube of their distance.
    """
    ppsf = F.col("estimated_price") / F.col("sfla")
    rows = metrics.where((F.col("estimated_price") > min_price) & (F.col("sfla") > min_size)).select(
        F.floor(F.col("sfla") / step).alias("bin"), F.col("sfla").alias("x"), ppsf.alias("y"))
    moments = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"),
                                      F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("x") * F.col("y")).alias("xy"))
    spread = moments.withColumn("off", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
    near = F.abs(F.col("off")) / (reach + 1.0)
    weight = F.pow(1 - F.pow(near, 3), 3)
    own = F.col("off") == 0
    sums = spread.groupBy((F.col("bin") + F.col("off")).alias("bin")).agg(
        *[F.sum(weight * F.col(c)).alias(f"s_{c}") for c in ("n", "x", "y", "xx", "xy")],
        F.max(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own, F.col("y") / F.col("n"))).alias("avg_ppsf"))
    spread_x = F.col("s_n") * F.col("s_xx") - F.col("s_x") * F.col("s_x")
    slope = F.try_divide(F.col("s_n") * F.col("s_xy") - F.col("s_x") * F.col("s_y"), spread_x)
    centre = (F.col("bin") + 0.5) * step
    fitted = F.col("s_y") / F.col("s_n") + F.coalesce(slope, F.lit(0.0)) * (centre - F.col("s_x") / F.col("s_n"))
    return sums.where("n IS NOT NULL").select((F.col("bin") * step).alias("size_from"), "n", "avg_ppsf", fitted.alias("fitted_ppsf"), slope.alias("slope"))


def holding_periods(metrics: DataFrame) -> DataFrame:
    """years_held (whole years), sales, avg_growth: the histogram of holding periods."""
    return (metrics.where(F.col("days_held").isNotNull()).groupBy(F.floor(F.col("days_held") / 365.25).alias("years_held"))
            .agg(F.count(F.lit(1)).alias("sales"), F.avg("growth_pct").alias("avg_growth")))


def cohort_appreciation(metrics: DataFrame) -> DataFrame:
    """cohort (year of purchase), resales, avg_growth, avg_growth_per_year: what parcels bought in a year gained by
    their next sale."""
    bought = F.year(F.date_sub(F.col("tx_date").cast("date"), F.col("days_held").cast("int")))
    sold = metrics.where("days_held > 0 AND growth_pct IS NOT NULL").withColumn("cohort", bought)
    return sold.groupBy("cohort").agg(F.count(F.lit(1)).alias("resales"), F.avg("growth_pct").alias("avg_growth"),
                                      F.avg(F.col("growth_pct") / (F.col("days_held") / 365.25)).alias("avg_growth_per_year"))


def luxury_tail(metrics: DataFrame) -> DataFrame:
    """tx_year, p90, tail_sales, tail_avg_price, tail_share: the top decile of prices of each year (exact)."""
    q = exact_quantiles(metrics, ["tx_year"], "estimated_price", {"p90": 0.9})
    tail = F.col("estimated_price") >= F.col("p90")
    value = F.sum(F.when(tail, F.col("estimated_price")))
    return metrics.join(q, "tx_year").groupBy("tx_year").agg(
        F.max("p90").alias("p90"), F.count(F.when(tail, 1)).alias("tail_sales"), F.avg(F.when(tail, F.col("estimated_price"))).alias("tail_avg_price"),
        F.try_divide(value.cast("double"), F.sum("estimated_price")).alias("tail_share"))
