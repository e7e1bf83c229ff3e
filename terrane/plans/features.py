"""Feature preparation (F1-F14) over the training rows.

Fitted quantities (a median, means and scales, category lists) are computed by
one aggregate each and applied as literals, the way Spark ML's estimators fit
and transform; nothing row-sized reaches the driver.
"""

from __future__ import annotations

import datetime as _dt
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes, decode
from ..operators import asof, geo
from ..operators.ordering import global_rank
from ..operators.quantile import exact_quantiles
from ..operators.spread import spread
from ..session import ensure_checkpoint_dir

NUMERIC = ["sfla", "beds", "baths", "year_blt", "garage_size", "acres", "mortgage_rate", "sp500", "cpi",
           "county_pop", "grade_numeric", "cond_numeric", "scenic_view", "dist_breck", "dist_keystone",
           "dist_copper", "dist_abasin", "dist_dillon", "dist_to_lift"]
CATEGORICAL = ["city", "prop_type"]
TARGET = "price"


def combined_series(series: dict[str, DataFrame | None]) -> DataFrame | None:
    """Several dated series ``(date, value)`` as one table with a column each; missing ones are skipped."""
    own = {n: s for n, s in series.items() if s is not None}
    if not own:
        return None
    # a value that is null on its date counts as one: it travels in a struct
    kind = "struct<value: double>"
    long = None
    for name, s in own.items():
        one = s.select(F.col("date").cast("date").alias("date"),
                       *[(F.struct(F.col("value").cast("double").alias("value")) if n == name else F.lit(None)).cast(kind).alias(n) for n in own])
        long = one if long is None else long.unionByName(one)
    return long.groupBy("date").agg(*[F.max(n).alias(n) for n in own])


def asof_macro(df: DataFrame, macro: DataFrame, on: str = "tx_date") -> DataFrame:
    """J4 for all columns of ``macro`` (date and series; null: no value on that date) by one as-of join: each date
    carries the last value of every series so far. The window runs over the series' dates, which the calendar bounds."""
    names = [c for c in macro.columns if c != "date"]
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    filled = macro.where("date IS NOT NULL").select("date", *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in names])
    joined = asof.asof_join(df, filled, on, "date", names)
    structs = [c for c in names if isinstance(macro.schema[c].dataType, T.StructType)]
    return joined.withColumns({c: F.col(f"{c}.value") for c in structs}) if structs else joined


def build_features(training: DataFrame, points: DataFrame, macro: dict[str, DataFrame] | DataFrame,
                   global_ffill: bool = False, lifts: DataFrame | None = None) -> DataFrame:
    """training rows + coordinates and resort distances (G2, G5; to the lift lines
    ``lifts``, G4, where given, else to points, G3; the lift distance is always
    created) + calendar parts (F2) + as-of macro values (J4; a dict of series, missing
    ones skipped, or one table of them) + fills (F4, F5) + quality ordinals (Q3l).

    ``global_ffill`` reproduces the reference's global forward/backward fill in
    date order (F3); by default each column has its own fill policy instead.
    """
    df = geo.join_coordinates(training, points)
    df = geo.nearest_lift(geo.resort_point_distances(df) if lifts is None else geo.lift_line_distances(df, lifts))
    df = df.withColumns({"year": F.year("tx_date"), "month": F.month("tx_date")})
    macro = combined_series(macro) if isinstance(macro, dict) else macro
    if macro is not None:
        df = asof_macro(df, macro)
    if global_ffill:
        cols = [c for c in df.columns if c not in ("schno", "tx_date", "slot")]
        df = asof.global_fill(df, ["tx_date", "schno", "price"], cols)
    # The fitted fills and every later fit read this table several times:
    # materialise it once in the shared checkpoint folder (lineage cut, and
    # a lost executor re-reads files instead of recomputing the joins), in
    # partitions that give every core its share of the fits and scorings.
    ensure_checkpoint_dir(df.sparkSession)
    df = spread(df, training.count()).checkpoint(eager=True)
    df = fill_median(df, "year_blt")
    df = df.fillna(0, subset=["garage_size", "beds", "baths", "acres"]).fillna(0, subset=["scenic_view"])
    return df.withColumns({"grade_numeric": decode.quality_ordinal("grade"),
                           "cond_numeric": decode.quality_ordinal("cond")})


def fill_median(df: DataFrame, col: str) -> DataFrame:
    """NULLs of ``col`` take its exact median (fitted by one bounded aggregate)."""
    row = exact_quantiles(df, [], col, {"m": 0.5}).first()
    if row is None or row["m"] is None:
        return df
    return df.withColumn(col, F.coalesce(F.col(col).cast("double"), F.lit(float(row["m"]))))


def present_numeric(df: DataFrame, numeric: list[str] = NUMERIC) -> list[str]:
    return [c for c in numeric if c in df.columns]


def model_rows(df: DataFrame, numeric: list[str] | None = None, min_price: float = 100000) -> DataFrame:
    """rows with every feature present and finite (an infinity counts as
    missing, as the reference replaces it by NaN before dropping), and a
    price above the floor. One filter, no re-aliased columns, so Catalyst's
    constraint inference stays linear in the number of features."""
    numeric = numeric or present_numeric(df)
    cond = F.col(TARGET).isNotNull() & (F.col(TARGET) > min_price)
    for c in CATEGORICAL:
        cond = cond & F.col(c).isNotNull()
    for c in numeric:
        v = F.col(c).cast("double")
        cond = cond & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return df.where(cond)


def fit_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """F7 fit: mean and population standard deviation per column, one aggregate."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "_z") -> DataFrame:
    """F7 transform: (x - mean) / std; a zero std scales by 1 (as scikit-learn)."""
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)
                           for c, (m, s) in stats.items()})


def fit_categories(df: DataFrame, cols: list[str] = CATEGORICAL) -> DataFrame:
    """F8 fit: column, value, index: the distinct values of each column, numbered in order from 0. A table, so that a
    column may have any number of values."""
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])))
    ranked = global_rank(values.where("value IS NOT NULL").distinct(), ["column", "value"], "_place")
    return ranked.withColumn("index", (F.col("_place") - F.min("_place").over(Window.partitionBy("column"))).cast("int")).drop("_place")


def encode_categories(df: DataFrame, table: DataFrame, cols: list[str] = CATEGORICAL) -> DataFrame:
    """F8 transform with a fitted table: ``<column>_index``, the place of the row's one in the column's vector; null
    (all zeros) for a value that was not there when the table was made."""
    for c in cols:
        own = table.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("index").alias(f"{c}_index"))
        df = df.join(own, F.col(c) == F.col("_value"), "left").drop("_value")
    return df


def one_hot(df: DataFrame, cats: dict[str, list[str]]) -> DataFrame:
    """F8 transform: one 0/1 column per known category; an unknown value is all zeros."""
    return df.withColumns({f"{c}_{v}": (F.col(c) == F.lit(v)).cast("double") for c, vs in cats.items() for v in vs})


def luxury_weight(price: str = TARGET):
    """weight 2.0 for prices over 2,000,000, else 1.0."""
    return F.when(F.col(price) > codes.LUXURY_PRICE, F.lit(codes.LUXURY_WEIGHT)).otherwise(F.lit(1.0))


def chronological_split(df: DataFrame, order: list[str], train_share: float = 0.8) -> DataFrame:
    """the first ``floor(n * share)`` rows in ``order`` (a total order, its first column the date) are train, the
    rest test (``role`` column).

    Rank selection instead of positions: counts per date find the date that the cut falls on, and only that date's
    rows are sorted, up to the cut, for the last train row. Two values reach the driver; the rows are not moved.
    """
    date, rest = order[0], order[1:]
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    total = Window.partitionBy(F.lit(0))
    upto = F.sum("_n").over(total.orderBy(date).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto).withColumn("_cut", F.floor(F.sum("_n").over(total) * F.lit(train_share)))
    edge = placed.where((F.col("_upto") > F.col("_cut")) & (F.col("_upto") - F.col("_n") <= F.col("_cut"))).first()
    if edge is None:  # no rows, or all of them train
        return df.withColumn("role", F.lit("train"))
    day = F.lit(edge[date])
    before = F.col(date).isNull() & day.isNotNull() | F.coalesce(F.col(date) < day, F.lit(False))
    here, wanted = F.col(date).eqNullSafe(day), int(edge["_cut"] - (edge["_upto"] - edge["_n"]))
    if wanted and rest:
        last = (df.where(here).select(*rest).orderBy(*rest).limit(wanted)
                .agg(F.max(F.struct(*rest)).alias("last")).first()["last"])
        kind = df.select(F.struct(*rest).alias("s")).schema["s"].dataType.simpleString()
        edge_value = F.struct(*(F.lit(v).alias(c) for c, v in zip(rest, last, strict=True))).cast(kind)
        before = before | here & (F.struct(*rest) <= edge_value)
    return df.withColumn("role", F.when(before, "train").otherwise("test"))


def random_split(df: DataFrame, key: str, seed: int = 42, train_pct: int = 80) -> DataFrame:
    """seeded, partitioning-independent split by a hash of the key."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("role", F.when(bucket < train_pct, "train").otherwise("test"))


def fold_bounds(max_date: _dt.date, test_months: int, n_folds: int) -> list[tuple[int, _dt.date, _dt.date]]:
    """Fold windows (i, start, end] with chained month arithmetic (D6): the end
    steps back ``i * test_months`` from the max date, the start one window more."""
    def add_months(d: _dt.date, k: int) -> _dt.date:
        m = d.month - 1 + k
        y, m = d.year + m // 12, m % 12 + 1
        last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28, 31, 30, 31, 30, 31, 31, 30,
                31, 30, 31][m - 1]
        return _dt.date(y, m, min(d.day, last))
    out = []
    for i in range(n_folds):
        end = add_months(max_date, -test_months * i)
        out.append((i, add_months(end, -test_months), end))
    return out


def temporal_folds(df: DataFrame, date_col: str = "tx_date", test_months: int = 6, n_folds: int = 3) -> DataFrame:
    """walk-forward folds as rows ``(fold, role, ...)``: test is (start, end],
    train is <= start; empty folds are skipped; fold 0 is the oldest.

    Each row is tagged with its (fold, role) pairs by an ``explode`` of literal
    bounds (at most ``n_folds`` copies); fold emptiness is one small aggregate.
    """
    max_date = df.agg(F.max(F.col(date_col).cast("date"))).first()[0]
    if max_date is None:
        return df.select("*", F.lit(None).cast("int").alias("fold"), F.lit(None).cast("string").alias("role")).limit(0)
    bounds = fold_bounds(max_date, test_months, n_folds)
    d = F.col(date_col).cast("date")
    tags = F.array(*[F.when((d > F.lit(s)) & (d <= F.lit(e)), F.struct(F.lit(i).alias("i"), F.lit("test").alias("role")))
                     .when(d <= F.lit(s), F.struct(F.lit(i).alias("i"), F.lit("train").alias("role")))
                     for i, s, e in bounds])
    tagged = df.select("*", F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("_t"))
    roles = tagged.groupBy("_t.i").agg(F.countDistinct("_t.role").alias("_roles")).collect()
    live = sorted([r["i"] for r in roles if r["_roles"] == 2], reverse=True)   # oldest (largest i) first
    fold_no = {i: k for k, i in enumerate(live)}
    if not fold_no:
        return tagged.select(*df.columns, F.lit(None).cast("int").alias("fold"), F.col("_t.role").alias("role")).limit(0)
    fold = decode.literal_map(fold_no)[F.col("_t.i")]
    return tagged.where(F.col("_t.i").isin(live)).select(*df.columns, fold.alias("fold"), F.col("_t.role").alias("role"))


def iqr_filter(df: DataFrame, col: str, k: float = 1.5, min_rows: int = 100) -> DataFrame:
    """keep rows within [Q1 - k IQR, Q3 + k IQR]; if fewer than ``min_rows``
    remain, keep the 1st-99th percentile range instead (exact quantiles)."""
    q = exact_quantiles(df, [], col, {"q1": 0.25, "q3": 0.75, "p01": 0.01, "p99": 0.99}).first()
    lo, hi = q["q1"] - k * (q["q3"] - q["q1"]), q["q3"] + k * (q["q3"] - q["q1"])
    kept = df.where(F.col(col).between(lo, hi))
    if kept.count() < min_rows:
        kept = df.where(F.col(col).between(q["p01"], q["p99"]))
    return kept


def scaler_metadata(df: DataFrame, numeric: list[str] | None = None) -> DataFrame:
    """feature order, mean and scale (population std, 1 when zero) per
    numeric feature, from one aggregate, in long form."""
    numeric = numeric or present_numeric(df)
    agg = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(numeric)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(numeric)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), F.col(f"m{i}").alias("mean"),
                              F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("scale"))
                     for i, c in enumerate(numeric)])
    return agg.select(F.inline(rows))


def category_metadata(df: DataFrame, cols: list[str] = CATEGORICAL) -> DataFrame:
    """the known categories of each categorical feature."""
    out = None
    for c in cols:
        part = df.where(F.col(c).isNotNull()).select(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()
