"""Rows that larger or odd tables hold: large parcel numbers, parcels without size."""

import datetime as dt
import random

from pyspark.sql import functions as F

from terrane.plans import evaluate, market, whatif
from terrane.sources import fixtures as fx


def test_predictions_of_large_parcel_numbers(spark):
    """A parcel number times 1700 passes 32 bits."""
    parcels = spark.createDataFrame([("2250000", "B", dt.date(1999, 5, 1)), ("12", "F", dt.date(2000, 5, 1))], "schno string, town string, recdate1 date")
    scored = fx.predictions(parcels)
    assert {r["schno"]: r["actual"] for r in scored.collect()} == {"2250000": 100000.0 + 2250000 * 1700, "12": 120400.0}
    assert evaluate.metrics(scored).first()["n"] == 2
    assert evaluate.runs_from_scores(scored).count() == 2


def test_comparable_sales_of_size_zero(spark):
    """A parcel of size 0 is comparable with itself; it has no price per square foot."""
    parcel = ["1", "B", 0.0, 1.0, 1.0, 1990, "a", "1212", None]
    rows = [(*parcel, dt.date(2001, 5, 1), 90000.0), ("2", "B", 1000.0, *parcel[3:], dt.date(2001, 6, 1), 80000.0)]
    none = {f"{p}{i}": F.lit(None).cast(t) for i in (2, 3, 4) for p, t in (("recdate", "date"), ("docfee", "double"))}
    parcels = spark.createDataFrame(rows, "schno string, town string, sfla double, beds double, bath_tot double, year_blt int, address string, "
                                          "abst1 string, abst2 string, recdate1 date, docfee1 double").withColumns(none)
    subjects = parcels.select(F.col("schno").alias("subject_id"), F.lit("BRECKENRIDGE").alias("city"), F.lit("Other").alias("prop_type"), "sfla")
    found = market.comparable_sales_many(parcels, subjects, "2001-08-01").collect()
    assert sorted((r["subject_id"], r["price"], r["ppsf"]) for r in found if r["ppsf"]) == [("2", 80000, 80.0)]
    assert [(r["subject_id"], r["price"], r["ppsf"]) for r in found if not r["ppsf"]] == [("1", 90000, None)]
    assert [r["ppsf"] for r in market.comparable_sales(parcels, "BRECKENRIDGE", "Other", 1, "2001-08-01").collect()] == [None]


def test_similar_properties_begin_with_fine_rounds_where_parcels_are_dense(spark, monkeypatch):
    """Dense parcels and a crowd of equal ones: whatever the first radius, the same nearest."""
    rng = random.Random(8)
    rows = [(str(k), "B", rng.choice([900.0 + rng.randrange(40), 1000.0]), 1990 + rng.randrange(3), 2.0, 1.0, "1230", "FRISCO", 50000.0) for k in range(60)]
    rows += [(str(k), "B", 1000.0, 1990, 2.0, 1.0, "1230", "FRISCO", 50000.0) for k in range(60, 90)]
    df = spark.createDataFrame(rows, "schno string, town string, sfla double, year_blt int, beds double, bath_tot double, abst1 string, city string, docfee1 double")
    subjects = whatif.parcel_profiles(df.where("schno < '4'")).withColumnRenamed("schno", "subject_id")
    distance = lambda a, b: abs(a[2] - b[2]) / 500 + abs(a[3] - b[3]) / 10
    want = sorted((s.subject_id, k, b[0]) for s in subjects.collect() for k, (_, _, b) in enumerate(
        sorted((round(10 * distance(rows[int(s.subject_id)], b), 9), int(b[0]), b) for b in rows if b[0] != s.subject_id)[:3], 1))
    for most in (1.0, 1e9):
        monkeypatch.setattr(whatif, "CELL_ROWS", most)
        got = whatif.similar_properties(df, subjects, leave_out_self=True)
        assert sorted((r.subject_id, r["rank"], r.schno) for r in got.collect()) == want


def test_costly_rows_are_dealt_over_the_cores(spark):
    """Few bytes make one partition of a shuffle; pages and model rows go to all cores, small tables stay."""
    from terrane.operators.spread import LEAST_ROWS, spread

    cores = spark.sparkContext.defaultParallelism
    parcels = spark.range(1, 400).select(F.col("id").cast("string").alias("schno")).groupBy("schno").agg(F.lit("a").alias("address"))
    for pages in (fx.detail_pages(parcels), fx.sale_pages(parcels)):
        assert pages.rdd.getNumPartitions() >= 4 * cores and pages.count() == 399
    one = spark.range(100).coalesce(1)
    assert spread(one, 100).rdd.getNumPartitions() == 1 and spread(one, 3 * LEAST_ROWS).rdd.getNumPartitions() == 3


def test_leaf_summaries_keep_the_quantiles():
    """Summaries of any number of batches, merged, give the quantiles of all labels within a thousandth."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    from terrane.plans import models

    rng = np.random.default_rng(3)
    labels, leaves = rng.normal(size=300_000), rng.integers(0, 2, (300_000, 2))

    def batches(part):
        for at in np.array_split(part, 7):
            yield pa.RecordBatch.from_arrays([pa.array(leaves[at].astype(np.float32).tolist(), pa.list_(pa.float32())), pa.array(labels[at])], names=["leaves", "label"])

    tasks = [b.to_pandas() for part in np.array_split(np.arange(300_000), 3) for b in models.leaf_summaries(batches(part))]
    for key, parts in pd.concat(tasks).groupby(["tree", "leaf"]):
        own = np.sort(labels[leaves[:, key[0]] == key[1]])
        assert parts["labels"].map(len).max() <= models.SUMMARY_POINTS and abs(sum(map(sum, parts["weights"])) - len(own)) < 1
        places = np.searchsorted(own, models.merged_points(key, parts)["points"][0]) / len(own)
        assert np.abs(places - (np.arange(100) + 0.5) / 100).max() < 2e-3
    points = np.full((2, 2, 100), np.nan)
    points[0, 0], points[1, 1] = np.arange(100), np.arange(100, 200)
    low, high = models.interval_bounds(points, np.array([[0, 1], [0, 0], [1, 0]]), 0.1, 0.9)
    assert low[:2].tolist() == [19, 9] and high[:2].tolist() == [179, 89] and np.isnan(low[2])
