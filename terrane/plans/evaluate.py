"""Model evaluation, run log and champion registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes


def metrics(scored: DataFrame, actual: str = "actual", predicted: str = "predicted", keys: list[str] | None = None) -> DataFrame:
    """M7: MAE, R^2 and MAPE in one aggregate (R^2 from the population variance,
    so no second pass over the rows)."""
    e = F.col(predicted) - F.col(actual)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
            (F.lit(1.0) - F.try_divide(F.sum(e * e), F.count(F.lit(1)) * F.var_pop(actual))).alias("r2"),
            (F.avg(F.abs(e) / F.col(actual)) * 100).alias("mape")]
    return scored.groupBy(*(keys or [])).agg(*aggs)


def residual_slices(scored: DataFrame, slices: tuple[str, ...] = ("city", "prop_type"), actual: str = "actual",
                    predicted: str = "predicted", keys: tuple[str, ...] = ()) -> DataFrame:
    """M8: MAE, MAPE and count per value of each slice column, the overall row
    and the luxury segment (actual > 2,000,000), as ``(slice, value, ...)``;
    of each value of ``keys`` apart."""
    base = scored.select(*keys, *slices, F.col(actual).alias("_a"),
                         F.abs(F.col(predicted) - F.col(actual)).alias("_ae"))
    base = base.withColumn("_pct", F.col("_ae") / F.col("_a") * 100)

    def tag(name: str, value) -> "F.Column":
        return F.struct(F.lit(name).alias("slice"), value.cast("string").alias("value"))
    # one scan: every row counts in each of its slices
    tags = [tag(s, F.col(s)) for s in slices] + [
        tag("overall", F.lit("all")), F.when(F.col("_a") > codes.LUXURY_PRICE, tag("luxury", F.lit("> 2M")))]
    return (base.select(*keys, "_ae", "_pct", F.explode(F.array_compact(F.array(*tags))).alias("_t"))
            .groupBy(*keys, "_t.slice", "_t.value")
            .agg(F.avg("_ae").alias("mae"), F.avg("_pct").alias("mape"), F.count(F.lit(1)).alias("count")))


def runs_from_scores(scored: DataFrame, date_col: str = "tx_date") -> DataFrame:
    """A run log derived from scored rows: one run per scoring year, with
    the next run id, a model name, metrics and parameters (a map)."""
    y = F.year(F.col(date_col))
    m = metrics(scored.where(y.isNotNull()).withColumn("_y", y), keys=["_y"])
    return m.select(
        F.row_number().over(Window.orderBy("_y")).alias("run_id"),
        F.when(F.col("_y") % 2 == 0, F.lit("gbm")).otherwise(F.lit("price_net_macro")).alias("model_name"),
        F.struct("mae", "r2").alias("metrics"),
        F.create_map(F.lit("epochs"), (F.col("_y") % 7 * 100).cast("string"),
                     F.lit("lr"), F.lit("0.0004"),
                     F.lit("monotonicity_constraints"),
                     F.concat_ws(",", F.lit("1"), F.lit("0"), (F.col("_y") % 3 - 1).cast("string"))).alias("parameters"),
        F.col("_y").alias("year"))


def champions(runs: DataFrame) -> DataFrame:
    """Per model name, the run with the lowest MAE (ties: the earliest run)."""
    flat = runs.select("run_id", "model_name", F.col("metrics.mae").alias("mae"), F.col("metrics.r2").alias("r2"))
    best = flat.where(F.col("mae").isNotNull()).groupBy("model_name").agg(
        F.min_by(F.struct("run_id", "mae", "r2"), F.struct("mae", "run_id")).alias("b"))
    return best.select("model_name", "b.run_id", "b.mae", "b.r2")


def promotion_history(runs: DataFrame) -> DataFrame:
    """Replaying runs in id order, a run is promoted when its MAE is strictly
    lower than its model's best so far (the first run of a model is promoted)."""
    flat = runs.select("run_id", "model_name", F.col("metrics.mae").alias("mae"))
    w = Window.partitionBy("model_name").orderBy("run_id").rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.min("mae").over(w)
    return flat.select("run_id", "model_name", "mae",
                       (F.col("mae").isNotNull() & (best_before.isNull() | (F.col("mae") < best_before)))
                       .alias("promoted"))


def leaderboard(runs: DataFrame) -> DataFrame:
    """Flattened runs (metrics, parameters), count of active (non-zero)
    monotonicity constraints, rows without MAE dropped, best-run flag."""
    cons = F.split(F.col("parameters")["monotonicity_constraints"], ",")
    active = F.size(F.filter(cons, lambda v: v.cast("double") != 0))
    flat = runs.select("run_id", "model_name", F.col("metrics.mae").alias("mae"), F.col("metrics.r2").alias("r2"),
                       F.col("parameters")["epochs"].cast("int").alias("epochs"),
                       F.col("parameters")["lr"].cast("double").alias("learning_rate"),
                       F.when(F.col("parameters")["monotonicity_constraints"].isNotNull(), active).alias("active_constraints"))
    flat = flat.where(F.col("mae").isNotNull())
    best = F.min_by("run_id", F.struct("mae", "run_id")).over(Window.partitionBy())
    return flat.withColumn("is_best", F.col("run_id") == best)


def error_band(scored: DataFrame, predicted: str = "predicted", mae: float = codes.ERROR_BAND_DEFAULT_MAE) -> DataFrame:
    """sigma = price * MAE / 1.5M; the +-1 sigma and +-2 sigma bands."""
    sigma = F.col(predicted) * F.lit(mae) / F.lit(codes.ERROR_BAND_PRICE_SCALE)
    return scored.withColumns({"sigma": sigma, "low_1s": F.col(predicted) - sigma, "high_1s": F.col(predicted) + sigma,
                               "low_2s": F.col(predicted) - 2 * sigma, "high_2s": F.col(predicted) + 2 * sigma})


def model_error_band(scored: DataFrame, runs: DataFrame, model_name: str, predicted: str = "predicted") -> DataFrame:
    """M18 with the MAE of the model's champion run (M12); the default where it has none."""
    best = champions(runs).where(F.col("model_name") == model_name).agg(F.max("mae").alias("mae")).first()["mae"]
    return error_band(scored, predicted, codes.ERROR_BAND_DEFAULT_MAE if best is None else best)


def append_run(runs: DataFrame, new_runs: DataFrame) -> DataFrame:
    """M11 ``log_run``: append runs with the next ids (current max + 1, in the
    order of ``new_runs``' ``seq`` column). The run log is small (one row per
    experiment); the new ids come from one window over the union."""
    tagged = (runs.withColumn("_new", F.lit(False)).withColumn("seq", F.lit(None).cast("long"))
              .unionByName(new_runs.withColumn("_new", F.lit(True)), allowMissingColumns=True))
    everything = Window.partitionBy()
    base = F.coalesce(F.max(F.when(~F.col("_new"), F.col("run_id"))).over(everything), F.lit(0))
    ordered = Window.partitionBy("_new").orderBy("seq")
    rid = F.when(F.col("_new"), base + F.row_number().over(ordered)).otherwise(F.col("run_id"))
    return tagged.withColumn("run_id", rid.cast("int")).drop("_new", "seq")
