"""Model operators on small data: invariants that hold whatever the trees are."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from terrane.plans import features, models, trees


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000, 1025])
def test_permutation_is_one_to_one_and_keyed(spark, n):
    rows = spark.range(n).select("id", *[models.permuted(F.col("id"), n, F.lit(k)).alias(f"p{k}") for k in range(3)]).collect()
    for k in range(3):
        assert sorted(r[f"p{k}"] for r in rows) == list(range(n))
    if n >= 50:
        assert [r.p0 for r in rows] != [r.p1 for r in rows] and sum(r.p0 == r.id for r in rows) < n / 5


def _rows(spark, n=400, seed=1):
    rng = random.Random(seed)
    data = [(f"p{k}", rng.uniform(0, 10), rng.uniform(0, 10), rng.choice(["A", "B"]), rng.choice(["X", "Y"])) for k in range(n)]
    df = spark.createDataFrame(data, "schno string, sfla double, noise double, city string, prop_type string")
    return df.withColumn("price", F.lit(200000.0) + 50000 * F.col("sfla")).withColumn("tx_date", F.lit("2020-01-01").cast("date"))


def test_importance_finds_the_feature_and_ignores_partitioning(spark):
    rows = _rows(spark)
    got = {r.feature: r for r in models.permutation_importance(rows, ["sfla", "noise"], ["schno"], trees=5, depth=5).collect()}
    assert got["sfla"].importance > 0.5 and abs(got["noise"].importance) < 0.1 and got["sfla"].correlation > 0.99
    base = models.zero_filled(rows, ["sfla", "noise"], "schno").withColumn("_pos", F.substring("schno", 2, 9).cast("bigint"))
    model = models.raw_price_forest(["sfla", "noise"], 5, 5).fit(base.coalesce(1))
    first, other = (sorted((r.feature, r["repeat"], round(r["drop"], 9)) for r in models.permutation_drops(model, base.repartition(k), ["sfla", "noise"]).collect())
                    for k in (1, 7))
    assert first == other and len(first) == 10


def test_importance_of_a_feature_that_does_not_vary(spark):
    """A distance that is 0 for every row, as on dense tables: no correlation and no importance, but no error."""
    rows = _rows(spark).withColumns({"flat": F.lit(0.0), "some": F.when(F.col("noise") > 5, F.col("noise"))})
    got = {r.feature: r for r in models.permutation_importance(rows, ["sfla", "flat", "some"], ["schno"], trees=3, depth=3).collect()}
    assert (got["flat"].correlation, got["flat"].importance, got["flat"].std) == (None, 0.0, 0.0) and got["sfla"].correlation > 0.99
    both = [(r.some, r.price) for r in rows.collect() if r.some is not None]
    assert math.isclose(got["some"].correlation, np.corrcoef(np.array(both).T)[0, 1], abs_tol=1e-9)
    same = models.permutation_importance(rows.withColumn("price", F.lit(5.0)), ["sfla", "flat"], ["schno"], trees=3, depth=3).collect()
    assert [(r.importance, r.correlation) for r in same] == [(None, None)] * 2


def test_intervals_cover_about_the_asked_share_and_keep_every_row(spark):
    rng = random.Random(5)
    data = [(f"p{k}", x := rng.uniform(0, 4), rng.choice(["A", "B"]), "X", 1e5 * math.exp(x / 2 + rng.gauss(0, 0.3))) for k in range(3000)]
    df = spark.createDataFrame(data, "schno string, sfla double, city string, prop_type string, price double").withColumn("tx_date", F.lit("2020-01-01").cast("date"))
    train, test = df.where("schno < 'p5'"), df.where("schno >= 'p5'")
    twice = test.unionByName(test.limit(1))
    got = models.quantile_intervals(train, twice, ["sfla"], trees=10, depth=4)
    rows = got.collect()
    assert len(rows) == twice.count()
    inside = sum(r.low <= r.actual <= r.high for r in rows) / len(rows)
    assert 0.72 < inside < 0.88 and all(r.low <= r.high for r in rows)


def test_backtest_has_a_row_per_fold_slices_and_a_mean(spark):
    rows = _rows(spark).withColumn("tx_date", F.date_sub(F.lit("2020-12-31").cast("date"), (F.substring("schno", 2, 9).cast("int") * 3)))
    scored = models.backtest_scores(rows, ["sfla"], lambda: models.gbt(max_iter=2, depth=3))
    folds = {r.fold: r for r in models.backtest(scored).collect()}
    assert set(folds) == {None, 0, 1, 2} or set(folds) == {None, 1, 2, 3}
    own = [r for f, r in folds.items() if f is not None]
    assert math.isclose(folds[None].mae, sum(r.mae for r in own) / 3) and folds[None].n == sum(r.n for r in own) == scored.count()
    slices = models.backtest_slices(scored).where("slice = 'overall'").collect()
    assert {(r.fold, r["count"]) for r in slices} == {(r.fold, r.n) for r in own}


def test_explanation_compares_categories_too(spark):
    rows = _rows(spark).withColumn("price", F.col("price") + F.when(F.col("city") == "B", 500000).otherwise(0))
    model = models.fit(rows, ["sfla", "noise"], models.gbt(max_iter=10, step=0.3, depth=3))
    means = {k: v[0] for k, v in features.fit_scaler(rows, ["sfla", "noise"]).items()}
    subjects = spark.createDataFrame([(1, 9.0, 5.0, "B", "X"), (2, 1.0, 5.0, "A", "X")], "subject_id int, sfla double, noise double, city string, prop_type string")
    got = {(r.subject_id, r.feature): r.impact for r in models.baseline_deltas(model, subjects, ["sfla", "noise"], means, {"city": "A", "prop_type": "X"}).collect()}
    assert got[1, "city"] > 100000 and (2, "city") not in got and (1, "prop_type") not in got
    assert got[1, "sfla"] > 0 > got[2, "sfla"]


def test_dependence_follows_the_filtered_rows(spark):
    rows = _rows(spark, 300).withColumn("sfla", F.when(F.col("schno") == "p0", 1e6).otherwise(F.col("sfla")))
    curve = models.filtered_dependence(rows, "sfla", ["sfla", "noise"], resolution=10, trees=5, depth=5).orderBy("value").collect()
    assert len(curve) == 10 and curve[-1].value < 20 and curve[0].average_prediction < curve[-1].average_prediction


def test_variants_equal_rows_scored_one_by_one(spark):
    numeric = ["sfla", "noise"]
    rows = _rows(spark, 300).withColumn("price", F.col("price") + 9000 * F.col("noise") * F.col("sfla") + F.when(F.col("city") == "A", 70000).otherwise(0))
    for estimator in (models.gbt(4, 0.3, 4), models.forest(4, 6)):
        model = models.fit(rows, numeric, estimator)
        assert any(trees.of_model(model.stages[-1]).categories)  # splits by city are there
        own = model.transform(models._prepare(rows)).withColumn("x", vector_to_array("features")).toPandas()
        x, known = np.array(own.x.tolist()), trees.of_model(model.stages[-1])
        assert np.allclose(known.value[trees.own_leaves(known, x)].sum(axis=1), own.prediction, rtol=1e-12)
        donors = x[::-1].copy()
        total, replaced = trees.with_donors(known, x, donors)
        assert np.allclose(total, own.prediction, rtol=1e-12)
        for f in range(x.shape[1]):
            changed = x.copy()
            changed[:, f] = donors[:, f]
            assert np.allclose(known.value[trees.own_leaves(known, changed)].sum(axis=1), replaced[:, f], rtol=1e-9)
        # a row per grid value, scored by Spark
        got = {r.value: r.average_prediction for r in models.partial_dependence(model, rows, "sfla", 7).collect()}
        assert len(got) == 7
        every = rows.drop("sfla").withColumn("sfla", F.explode(F.array(*map(F.lit, got))))
        want = models.score(model, every, ["sfla"]).groupBy("sfla").agg(F.avg("predicted").alias("p")).collect()
        assert {round(r.sfla, 9): round(r.p, 3) for r in want} == {round(k, 9): round(v, 3) for k, v in got.items()}


def test_attributions_add_up_to_the_prediction_and_make_no_row_per_step(spark):
    numeric = ["sfla", "noise"]
    rows = _rows(spark, 200)
    model = models.fit(rows, numeric, models.gbt(4, 0.3, 4))
    got = models.shapley_importance(model, rows, rows, numeric, permutations=2)
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    bg = rows.agg(*[F.avg(c).alias(c) for c in numeric]).first()
    # both orders of two features, by Spark
    rnd = random.Random(42)
    orders = [rnd.sample(numeric, 2) for _ in range(2)]
    kept = [F.lit(bg[c]).alias(c) for c in numeric]
    at = {}
    for on in ((), ("sfla",), ("noise",), ("sfla", "noise")):
        some = rows.select("schno", "city", "prop_type", "price", *[F.col(c) if c in on else k for c, k in zip(numeric, kept, strict=True)])
        at[frozenset(on)] = np.array([r.predicted for r in models.score(model, some, ["schno"]).orderBy("schno").collect()])
    phi = dict.fromkeys(numeric, 0.0)
    for order in orders:
        for s, c in enumerate(order):
            phi[c] = phi[c] + (at[frozenset(order[:s + 1])] - at[frozenset(order[:s])]) / 2
    for r in got.collect():
        assert abs(r.importance - np.abs(phi[r.feature]).mean()) < 1e-3


def test_registered_queries_have_the_whole_settings(spark, monkeypatch):
    """The reference's sweep of five settings, 300 trees a fold of the backtest, and eight orders over the predictions of
    300 trees: no registered parameter leaves out a part."""
    from terrane.plans import registry

    rows = _rows(spark, 100)
    monkeypatch.setattr(registry, "_model_rows", lambda s, d: rows)
    seen = {}
    monkeypatch.setattr(models, "parameter_sweep", lambda rows, numeric, grid, order: seen.update(sweep=[(g["stepSize"], g["maxIter"], g["maxDepth"]) for g in grid]))
    monkeypatch.setattr(models, "backtest", lambda scored: scored)
    monkeypatch.setattr(models, "backtest_scores", lambda rows, numeric, factory: seen.update(fold=factory()))
    monkeypatch.setattr(models, "fit", lambda train, numeric, estimator: estimator)
    monkeypatch.setattr(models, "shapley_importance", lambda model, *a, permutations=8, sample_fraction=1.0, **k: seen.update(explained=model, orders=permutations, share=sample_fraction))
    for key in ("M10", "M9", "M5"):
        registry.REGISTRY[key](spark, "")
    assert seen["sweep"] == [(0.01, 1000, 5), (0.01, 2000, 6), (0.05, 500, 8), (0.02, 1500, 7), (0.1, 300, 5)]
    for model in (seen["fold"], seen["explained"]):
        assert (model.getMaxIter(), model.getStepSize(), model.getMaxDepth()) == (300, 0.05, 5)
    assert (seen["orders"], seen["share"]) == (8, 1.0)


@pytest.mark.parametrize("busy", [1, 100_000])
def test_settings_fitted_at_once_equal_those_fitted_alone(spark, monkeypatch, busy):
    monkeypatch.setattr(models, "BUSY_ROWS", busy)  # one after the other, and all at once
    rows = _rows(spark, 300).withColumn("tx_date", F.date_add(F.lit("2020-01-01").cast("date"), F.substring("schno", 2, 9).cast("int"))).coalesce(1)
    grid = [{"maxIter": 2, "maxDepth": 2, "stepSize": 0.3}, {"maxIter": 5, "maxDepth": 3, "stepSize": 0.1}, {"maxIter": 1, "maxDepth": 1, "stepSize": 0.1}]
    order = ["tx_date", "schno", "price"]
    got = models.parameter_sweep(rows, ["sfla", "noise"], grid, order).collect()
    assert [(r.setting, r.params) for r in got] == [(i, str(sorted(g.items()))) for i, g in enumerate(grid)]
    for g, r in zip(grid, got, strict=True):
        alone = models.train_and_score(rows, ["sfla", "noise"], models.gbt(g["maxIter"], g["stepSize"], g["maxDepth"]), order).collect()
        assert math.isclose(r.mae, sum(abs(a.actual - a.predicted) for a in alone) / len(alone), rel_tol=1e-6)


def test_folds_fitted_at_once_equal_those_fitted_alone(spark, monkeypatch):
    rows = _rows(spark).withColumn("tx_date", F.date_sub(F.lit("2020-12-31").cast("date"), (F.substring("schno", 2, 9).cast("int") * 3))).coalesce(1)
    found = []
    for busy in (1, 100_000):
        monkeypatch.setattr(models, "BUSY_ROWS", busy)
        scored = models.backtest_scores(rows, ["sfla"], lambda: models.gbt(max_iter=2, depth=3))
        found.append(sorted((r.fold, r.actual, round(r.predicted, 4)) for r in scored.collect()))
    assert found[0] == found[1] and found[0]
