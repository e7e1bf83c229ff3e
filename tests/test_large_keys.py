"""Run-log queries over orders whose parcel numbers times 1700 pass 32 bits, as in tables of 60 times sf0.1."""

import datetime as dt

import pytest

import __spark_entry__ as E

# a parcel number's remainder by 41 sets its error: |remainder - 20| percent of its price
YEARS = {1995: 5, 1996: 35, 1997: 18, 1998: 30, 1999: 8, 2000: 40}
FIRST = 2249998  # divisible by 41; times 1700 beyond 2^31
HUGE = 41 * 10**10 + 21  # itself beyond 2^31
PARCELS = {y: [pk for pk in range(FIRST + r, FIRST + 41 * 6, 41) if pk % 23][:3] for y, r in YEARS.items()} | {2001: [HUGE]}


@pytest.fixture(scope="module")
def large_keys(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("large_keys"))
    dated = [(4 * pk, pk % 5, "O", 2e5, dt.datetime(y, 5, 1), "5-LOW") for y, pks in PARCELS.items() for pk in pks]
    undated = [(4 * 23 * 10**6, 1, "O", 2e5, dt.datetime(1999, 5, 1), "5-LOW")]  # the fixture gives this slot no date
    spark.createDataFrame(dated + undated, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(k, f"C{k}", k) for k in range(4)], "c_custkey bigint, c_name string, c_nationkey int").write.parquet(f"{d}/customer.parquet")
    return d


def _run_log():
    """(run_id, model_name, mae, r2, year), worked out row by row."""
    out = []
    for i, (y, pks) in enumerate(sorted(PARCELS.items()), 1):
        actual = [100000 + 1700 * pk for pk in pks]
        errors = [a * abs(pk % 41 - 20) / 100 for a, pk in zip(actual, pks, strict=True)]
        mean = sum(actual) / len(actual)
        spread = sum((a - mean) ** 2 for a in actual)
        r2 = 1 - sum(e * e for e in errors) / spread if spread else None
        out.append((i, "price_net_macro" if y % 2 else "gbm", sum(errors) / len(errors), r2, y))
    return out


def _rows(spark, d, key, *cols):
    return sorted(tuple(r[c] for c in cols) for r in E.queries()[key](spark, d).collect())


def test_promotion_history_of_large_parcel_numbers(spark, large_keys):
    want, best = [], {}
    for run_id, model, mae, _, _ in _run_log():
        want.append((run_id, model, pytest.approx(mae, rel=1e-12), model not in best or mae < best[model]))
        best[model] = min(mae, best.get(model, mae))
    assert [w[3] for w in want] == [True, True, True, True, False, False, False]
    assert _rows(spark, large_keys, "M12_history", "run_id", "model_name", "mae", "promoted") == want


def test_champions_of_large_parcel_numbers(spark, large_keys):
    want = {}
    for run_id, model, mae, r2, _ in _run_log():
        if model not in want or mae < want[model][2]:
            want[model] = (model, run_id, mae, r2)
    assert {m: w[1] for m, w in want.items()} == {"gbm": 4, "price_net_macro": 3}
    # r2 is rounded to four places
    assert _rows(spark, large_keys, "M12", "model_name", "run_id", "mae", "r2") == [
        (m, run_id, pytest.approx(mae, rel=1e-12), pytest.approx(r2, rel=1e-6)) for m, run_id, mae, r2 in sorted(want.values())]


def test_leaderboard_of_large_parcel_numbers(spark, large_keys):
    log = _run_log()
    best = min(log, key=lambda r: (r[2], r[0]))[0]
    # constraints are 1, 0 and year % 3 - 1
    want = [(run_id, model, pytest.approx(mae, rel=1e-12), r2 and pytest.approx(r2, rel=1e-6), y % 7 * 100, 0.0004, 1 + (y % 3 != 1), run_id == best)
            for run_id, model, mae, r2, y in log]
    assert best == 3
    assert _rows(spark, large_keys, "M13", "run_id", "model_name", "mae", "r2", "epochs", "learning_rate", "active_constraints", "is_best") == want
