"""Exact grouped quantiles without collecting a group into one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer,
which fails when one group (a year, a city) holds a large share of the rows.
This operator is exact and bounded instead:

1. one aggregate per group: ``count`` and ``percentile_approx`` values that
   bracket every target rank by a margin larger than the sketch's rank error;
2. one aggregate per group: how many rows fall below and up to each bracket;
3. only rows inside a bracket (a ~8/accuracy share of each group per quantile)
   are counted per distinct value (ties collapse map-side) and ranked by a
   running sum per bracket; the two values around the target position are
   interpolated linearly, as pandas, numpy and Spark's ``percentile`` do.

All quantiles share these three passes. Without keys the brackets are literals.

If a bracket ever misses the target rank, that group's bracket widens to its
whole range, so the answer stays exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float],
                    accuracy: int = 100000) -> DataFrame:
    """One row per key group with one column per named quantile ``qs``."""
    margin = 4.0 / accuracy
    probs = list(qs.values())
    v = F.col("_v")
    base = df.select(*keys, F.col(value).cast("double").alias("_v")).where(v.isNotNull())
    edges = [min(max(q + side, 0.0), 1.0) for q in probs for side in (-margin, margin)]
    stats = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                    F.percentile_approx("_v", edges, accuracy).alias("_e"))
    if not keys:
        row = stats.first()
        if not row["_n"]:
            return df.sparkSession.createDataFrame([], ", ".join(f"`{n}` double" for n in qs))
        with_edges = base.withColumns({"_n": F.lit(row["_n"]), "_e": F.array(*map(F.lit, row["_e"]))})
    else:
        with_edges = base.join(stats, keys)
    # the brackets are carried along with the counts made from them, so every
    # later step sees the same evaluation of the sketch
    counts = []
    for i in range(len(probs)):
        counts += [F.sum((v < F.col("_e")[2 * i]).cast("long")).alias(f"_below{i}"),
                   F.sum((v <= F.col("_e")[2 * i + 1]).cast("long")).alias(f"_upto{i}")]
    counted = with_edges.groupBy(*keys, "_n", "_e").agg(*counts)
    brackets = []
    for i, q in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(q)
        ok = (F.col(f"_below{i}") <= F.floor(pos)) & (F.col(f"_upto{i}") > F.ceil(pos))
        brackets.append(F.struct(
            F.lit(i).alias("q"), pos.alias("pos"), F.when(ok, F.col("_e")[2 * i]).alias("lo"),
            F.when(ok, F.col("_e")[2 * i + 1]).alias("hi"),
            F.when(ok, F.col(f"_below{i}")).otherwise(F.lit(0)).alias("below")))
    bracketed = counted.select(*keys, F.array(*brackets).alias("_b"))
    if not keys:
        found = bracketed.first()["_b"]
        bracketed = base.withColumn("_b", F.array(*[F.struct(
            F.lit(b["q"]).alias("q"), F.lit(b["pos"]).alias("pos"), F.lit(b["lo"]).cast("double").alias("lo"),
            F.lit(b["hi"]).cast("double").alias("hi"), F.lit(b["below"]).cast("long").alias("below")) for b in found]))
    else:
        bracketed = base.join(bracketed, keys)
    inside = bracketed.select(*keys, "_v", F.explode(F.filter(
        "_b", lambda b: (b["lo"].isNull() | (v >= b["lo"])) & (b["hi"].isNull() | (v <= b["hi"])))).alias("_b"))
    # ties collapse first (a partial aggregate), so a value shared by a large
    # share of the group is one row; ranks become [start, end] ranges
    tied = inside.groupBy(*keys, F.col("_b.q").alias("_q"), "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.first("_b.pos").alias("_pos"), F.first("_b.below").alias("_below"))
    w = Window.partitionBy(*keys, "_q").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_below") + F.sum("_c").over(w)
    ranged = tied.select(*keys, "_q", "_v", "_pos", (end - F.col("_c")).alias("_r0"), (end - 1).alias("_r1"))
    lo_i, hi_i = F.floor("_pos"), F.ceil("_pos")
    covers_lo = (F.col("_r0") <= lo_i) & (lo_i <= F.col("_r1"))
    covers_hi = (F.col("_r0") <= hi_i) & (hi_i <= F.col("_r1"))
    picked = []
    for i, name in enumerate(qs):
        own = F.col("_q") == i
        low, high = F.max(F.when(own & covers_lo, v)), F.max(F.when(own & covers_hi, v))
        at = F.max(F.when(own, F.col("_pos")))
        picked.append((low + (at - F.floor(at)) * (high - low)).alias(name))
    return ranged.where(covers_lo | covers_hi).groupBy(*keys).agg(*picked)
