"""Scenario scoring and comparables.

Subjects (what-if inputs, benchmark scenarios, or all parcels) and candidates
are tables. The per-subject top-k is ``row_number() <= k``, which Spark cuts
map-side (a partial WindowGroupLimit) before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes, decode
from ..session import ensure_checkpoint_dir

def scenario_rows() -> list[dict]:
    """The benchmark scenarios (two archetypes in four towns) with the
    city-default resort distances and the fixed macro inputs."""
    rows = []
    for arch in codes.SCENARIO_ARCHETYPES:
        for town in codes.SCENARIO_TOWNS:
            r = dict(arch)
            r["desc"] = f"{arch['desc']} ({town.title()})"
            r["city"] = town
            dist = codes.CITY_DEFAULT_DISTANCES.get(town, {})
            for k in codes.RESORT_POINTS:
                r[k] = float(dist.get(k, 10))
            r["dist_to_lift"] = min(r[k] for k in codes.LIFT_RESORTS)
            r.update(codes.SCENARIO_MACRO)
            rows.append(r)
    return rows


def scenarios(spark: SparkSession) -> DataFrame:
    """The scenario rows as a DataFrame (numeric fields as double)."""
    rows = scenario_rows()
    text = {"desc", "city", "prop_type"}
    names = ["subject_id", *sorted(rows[0])]
    schema = ", ".join(f"`{n}` {'string' if n in text else 'int' if n == 'subject_id' else 'double'}" for n in names)
    data = [tuple(i if n == "subject_id" else (r[n] if n in text else float(r[n])) for n in names)
            for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def _record_lift_distance(city_col: str = "city"):
    """The dashboard's lift distance for a record without coordinates: the
    minimum of its city's default resort distances (unknown -> default city)."""
    fallback = codes.CITY_DEFAULT_DISTANCES[codes.DEFAULT_DISTANCE_CITY]
    per = []
    for name in codes.LIFT_RESORTS:
        m = {c: float(v[name]) for c, v in codes.CITY_DEFAULT_DISTANCES.items()}
        per.append(decode.decode(city_col, m, float(fallback[name])))
    return F.least(*per)


def parcel_profiles(records: DataFrame) -> DataFrame:
    """schno, town and the values that M17 compares: size, year, beds, baths (defaults for none), the dashboard's
    type and lift distance."""
    return records.select(
        "schno", "town", F.col("sfla").cast("double").alias("sfla"), F.col("year_blt").cast("double").alias("yb"),
        F.when(F.coalesce(F.col("beds"), F.lit(0)) != 0, F.col("beds")).otherwise(F.lit(codes.SIMILAR_DEFAULT_BEDS))
        .cast("double").alias("bd"),
        F.when(F.coalesce(F.col("bath_tot"), F.lit(0)) != 0, F.col("bath_tot"))
        .otherwise(F.lit(codes.SIMILAR_DEFAULT_BATHS)).cast("double").alias("ba"),
        decode.property_type_dashboard("abst1").alias("rtype"), _record_lift_distance().alias("dl"))


def scenario_profiles(subjects: DataFrame) -> DataFrame:
    """Subjects with a city (its town, or the dashboard's default) in the columns of ``parcel_profiles``."""
    town = F.coalesce(*(F.when(F.col("city") == c, F.lit(t)) for c, t in codes.DASHBOARD_TOWN_CODES.items()), F.lit(codes.DASHBOARD_TOWN_DEFAULT))
    return subjects.select("subject_id", town.alias("town"), F.col("prop_type").alias("rtype"), *(
        F.col(c).cast("double").alias(n) for c, n in (("sfla", "sfla"), ("year_blt", "yb"), ("beds", "bd"), ("baths", "ba"), ("dist_to_lift", "dl"))))


#: Distances up to which each round of the search is complete; from the last one on the similarity is 0.
RADII = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0, 7.0, 10.0)
PROFILE = ("rtype", "sfla", "yb", "bd", "ba", "dl")
#: Finer first rounds, of which the search begins with the widest whose cells hold few candidates on average.
FINE, CELL_ROWS = (0.5, 0.25, 0.125, 0.0625, 0.03125, 0.015625), 50.0
WIDE = "*"


def similar_properties(candidates: DataFrame, subjects: DataFrame, k: int = codes.SIMILAR_TOP,
                       leave_out_self: bool = False) -> DataFrame:
    """Top ``k`` comparable parcels per subject (``subject_id`` and the columns of ``parcel_profiles``).

    Candidates in the subject's town (price > 10,000) are scored by
    ``50 (type mismatch) + |d sqft|/500 + |d year|/10 + |d beds| + |d baths| +
    |d lift miles|``; similarity is ``max(0, 100 - 10 * distance)``. A subject
    whose town has fewer than 5 candidates is scored against all candidates.
    Ties keep candidate order (``schno``). ``leave_out_self`` passes over the
    candidate whose ``schno`` is the subject's id.

    An exact nearest-neighbour join in rounds of growing radius. A round meets subjects and candidates of one town and
    type in grid cells of twice its radius over size, year and beds; whatever it does not meet differs by more than the
    radius, and pairs that do are dropped where they meet. So a subject whose ``k``-th distance is below the radius is
    done, and the others go on. The first radius follows from how dense the candidates are; the radii grow slowly, so
    that a subject meets few more than it needs. Of candidates that are equal in all that is compared the least ids
    count. Behind the last radius all similarities are 0, where the least ids count: a few of each town are enough to
    fill up.
    """
    spark = candidates.sparkSession
    ensure_checkpoint_dir(spark)
    price = F.coalesce(F.when(decode.estimated_value("docfee1") != 0, decode.estimated_value("docfee1")), F.col("docfee1"))
    cand = parcel_profiles(candidates.where(price > codes.SIMILAR_MIN_PRICE)).checkpoint(eager=True)
    small = cand.groupBy("town").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= codes.SIMILAR_MIN_SAME_TOWN).select("town", F.lit(True).alias("own"))
    subj = subjects.join(small, "town", "left").withColumn("area", F.when(F.col("own"), F.col("town")).otherwise(F.lit(WIDE))).drop("own", "town")
    subj = subj.checkpoint(eager=True)
    areas = F.array_compact(F.array(F.lit(WIDE), F.concat(F.lit(""), F.col("town"))))
    held = cand.withColumn("area", F.explode(areas)).drop("town").join(F.broadcast(subj.select("area").distinct()), "area", "left_semi")
    order = [F.col("schno").try_cast("bigint"), F.col("schno")]
    # k of them are left when the subject itself goes (an id may stand in several rows: all of its rows go then)
    equal = Window.partitionBy("area", *PROFILE).orderBy(*order)
    held = held.withColumn("rank", F.dense_rank().over(equal)).where(F.col("rank") <= k + 1).drop("rank").checkpoint(eager=True)
    other = held.select("area", "schno", *(F.col(c).alias(f"c_{c}") for c in PROFILE))
    distance = (F.when(F.col("c_rtype") != F.col("rtype"), F.lit(codes.SIMILAR_TYPE_PENALTY)).otherwise(F.lit(0.0))
                + F.abs(F.col("c_sfla") - F.col("sfla")) / codes.SIMILAR_SQFT_UNIT + F.abs(F.col("c_yb") - F.col("yb")) / codes.SIMILAR_YEAR_UNIT
                + F.abs(F.col("c_bd") - F.col("bd")) + F.abs(F.col("c_ba") - F.col("ba")) + F.abs(F.col("c_dl") - F.col("dl")))
    allowed = ~F.col("schno").eqNullSafe(F.col("subject_id").cast("string")) if leave_out_self else F.lit(True)
    similarity = F.greatest(F.lit(0.0), F.lit(100.0) - F.col("distance") * 10)  # distances that differ may share one
    best = Window.partitionBy("subject_id").orderBy(similarity.desc(), *order)

    axes = {"x": ("sfla", codes.SIMILAR_SQFT_UNIT), "y": ("yb", codes.SIMILAR_YEAR_UNIT), "z": ("bd", 1.0)}

    def cell(value: Column, radius: float) -> Column:
        return F.floor(value / (2 * radius))

    def placed(radius: float) -> DataFrame:
        """The candidates with their cells."""
        return other.withColumnRenamed("c_rtype", "rtype").withColumns(
            {"c_rtype": F.col("rtype"), **{axis: cell(F.col(f"c_{column}") / unit, radius) for axis, (column, unit) in axes.items()}})

    def near(open_: DataFrame, radius: float) -> DataFrame:
        """The ``k`` nearest of the candidates within the radius of each open subject."""
        asked = open_
        for axis, (column, unit) in axes.items():
            value = F.col(column) / unit
            asked = asked.withColumn(axis, F.explode(F.sequence(cell(value - radius, radius), cell(value + radius, radius))))
        met = asked.join(placed(radius), ["area", "rtype", *axes]).where(allowed).withColumn("distance", distance).where(F.col("distance") < radius)
        return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("subject_id", "schno", "distance")

    def crowd(radius: float) -> float:
        """Candidates in a candidate's own cell, on average."""
        cells = placed(radius).groupBy("area", "rtype", *axes).agg(F.count(F.lit(1)).cast("double").alias("n"))
        return cells.agg(F.try_divide(F.sum(F.col("n") * F.col("n")), F.sum("n")).alias("n")).first()["n"] or 0.0

    first = next((r for r in FINE if crowd(r) <= CELL_ROWS), FINE[-1])
    found, open_ = None, subj
    for radius in (*(r for r in reversed(FINE) if first <= r < RADII[0]), *RADII):
        met = near(open_, radius).checkpoint(eager=True)
        if radius < RADII[-1]:  # a distance just below the radius may be rounded
            done = met.where(F.col("distance") < radius * (1 - 1e-9)).groupBy("subject_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
            met = met.join(done, "subject_id", "left_semi")
            open_ = open_.join(done, "subject_id", "left_anti")
        found = met if found is None else found.unionByName(met)
    # of similarity 0: the least ids of the area; k of them are left when the nearer ones and the subject itself go
    least = Window.partitionBy("area").orderBy(*order)
    fill = other.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= 2 * k).drop("rank")
    far = subj.join(fill, "area").where(allowed).withColumn("distance", distance)
    far = far.where(F.col("distance").isNull() | (F.col("distance") >= RADII[-1])).select("subject_id", "schno", "distance")
    scored = found.unionByName(far).withColumn("similarity", similarity)
    w = Window.partitionBy("subject_id").orderBy(F.col("similarity").desc(), *order)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
