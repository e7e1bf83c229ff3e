"""The newest rows in ranges of sizes against trying all rows, and how few rows are left to be shuffled."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrane.operators import newest


@pytest.mark.parametrize("k", [1, 4])
def test_equals_trying_every_row(spark, monkeypatch, k):
    monkeypatch.setattr(newest, "TASK_RANGES", 40)  # several tasks answer from the same rows
    rng = random.Random(7)
    sizes = [lambda: float(rng.randrange(4)), lambda: rng.uniform(0, 3), lambda: 1000.0 + rng.randrange(120), lambda: rng.uniform(900, 1100), lambda: rng.choice([-1.0, -2.5, 0.0, 1000.0])]
    rows = [(i, rng.choice("ab"), rng.choice(sizes)(), rng.randrange(30)) for i in range(700)] + [(i, "c", 500.0 + i, i) for i in range(800, 900)] + [(999, "a", float("nan"), 3)]
    asked = []
    for i in range(300):
        lo, hi = rng.choice([(0, 0), (0, 1), (1, 1), (1, 2), (2, 3), (-1, -1), (-1, -2), (750, 1250), (900, 1000), (910, 1520), (1000, 1101), (600, 1000), (620, 1033)])
        asked.append((rng.choice([i, i, 7, None]), rng.choice("abcz"), lo, hi))
    table = spark.createDataFrame(rows, "id long, kind string, size double, day int").repartition(5)
    ranges = spark.createDataFrame(asked, "subject_id int, kind string, _lo long, _hi long")
    got = newest.newest_in_ranges(table, ranges, ["kind"], "size", [F.col("day").desc(), F.col("id")], k, ["id", "size"]).collect()
    want = []
    for subject in {a[0] for a in asked}:
        own = [r for s, kind, lo, hi in asked if s == subject for r in rows if r[1] == kind and lo <= r[2] <= hi]
        want += [(subject, n, r[0], r[2]) for n, r in enumerate(sorted(own, key=lambda r: (-r[3], r[0]))[:k], 1)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_a_crowded_cell_sends_few_rows():
    rng = np.random.default_rng(3)
    size = rng.uniform(1000, 1090, 200_000)
    batches = [pa.RecordBatch.from_pydict({"_key": ["x"] * len(part), "_size": part, **{c: [False] * len(part) for c in ("_begin", "_end", "_whole")}}) for part in np.split(size, 20)]
    kept = pa.Table.from_batches(list(newest.reachable(50)(iter(batches))))
    assert kept.num_rows < 1500 and kept.filter(kept["_whole"])["_size"].to_pylist() == size[:50].tolist()


def test_subjects_and_sales_of_one_band_make_no_row_per_pair(spark):
    """2,000 subjects and 2,000 sales of about one size: what is shuffled grows with their sum, not their product."""
    from terrane.plans import market

    rows = [(str(i), "B", 1000.0 + i % 100, 1.0, 1.0, 1990, "a", "1230", None, f"2001-{5 + i % 3}-{1 + i % 28}", 90000.0) for i in range(2000)]
    parcels = spark.createDataFrame(rows, "schno string, town string, sfla double, beds double, bath_tot double, year_blt int, address string, abst1 string, abst2 string, "
                                          "recdate1 string, docfee1 double").withColumn("recdate1", F.col("recdate1").cast("date"))
    parcels = parcels.withColumns({f"{p}{i}": F.lit(None).cast(t) for i in (2, 3, 4) for p, t in (("recdate", "date"), ("docfee", "double"))})
    subjects = parcels.select(F.col("schno").alias("subject_id"), F.lit("BRECKENRIDGE").alias("city"), F.lit("Condo").alias("prop_type"), "sfla")
    found = market.comparable_sales_many(parcels, subjects, "2001-08-01")
    assert found.count() == 2000 * 50
    qe = found._jdf.queryExecution()
    qe.toRdd().count()
    written, todo = 0, [qe.executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        todo += [node.plan()] if "QueryStage" in name else [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.children().apply(i) for i in range(node.children().size())]
        if name == "ShuffleExchangeExec":
            written += node.metrics().apply("shuffleRecordsWritten").value()
    assert 0 < written < 100_000
