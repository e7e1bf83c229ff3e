"""Plan-shape guards for the scale design (physical plans before execution)."""

import re

from conftest import SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sale_metrics_use_one_schno_exchange(spark):
    from terrane.plans import registry as R

    p = _plan(R.REGISTRY["A1"](spark, SMOKE))
    assert len(re.findall(r"Exchange hashpartitioning\(schno", p)) == 1


def test_every_order_is_a_sale_slot(spark):
    from terrane.sources import fixtures as fx
    from terrane.sources.tables import read_table

    parcels = fx.parcels(spark, SMOKE)
    filled = parcels.selectExpr(*[f"count(docfee{i}) AS n{i}" for i in range(1, 5)]).first()
    assert sum(filled) == read_table(spark, SMOKE, "orders").count()
    assert "Window" not in _plan(parcels)


def test_quantiles_share_three_passes(spark):
    from terrane.operators.quantile import exact_quantiles

    df = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    keyed = _plan(exact_quantiles(df, ["l_linenumber"], "l_quantity", {"a": 0.1, "b": 0.5, "c": 0.9}))
    assert len(re.findall(r"FileScan parquet", keyed)) <= 3
    alone = _plan(exact_quantiles(df, [], "l_quantity", {"a": 0.1, "b": 0.5}))
    for p in (keyed, alone):
        assert "NestedLoop" not in p and "CartesianProduct" not in p
    assert len(re.findall(r"FileScan parquet", alone)) == 1


def test_trends_do_not_shuffle_on_parcel_key(spark):
    from terrane.plans import registry as R

    p = _plan(R.REGISTRY["A2"](spark, SMOKE))
    assert "hashpartitioning(schno" not in p
    assert "hashpartitioning(tx_year" in p


def test_asof_joins_on_the_day(spark):
    from terrane.plans import registry as R

    p = _plan(R.REGISTRY["J4"](spark, SMOKE))
    assert re.search(r"Join \[cast\(tx_date[^\]]*\], \[_found_day[^\]]*\], LeftOuter|Join \[tx_date[^\]]*\], \[_found_day[^\]]*\], LeftOuter", p)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_table_joins_have_no_nested_loops(spark):
    """Comparable sales and similar properties of all parcels, and lift lines: equi joins only."""
    from terrane.plans import registry as R

    for key in ("A10_bulk", "M17_parcels", "G4"):
        p = _plan(R.REGISTRY[key](spark, SMOKE))
        assert "CartesianProduct" not in p and "NestedLoop" not in p, key


def test_split_and_fill_move_rows_at_most_once(spark):
    from terrane.operators import asof
    from terrane.plans import features

    df = spark.read.parquet(f"{SMOKE}/lineitem.parquet").select("l_shipdate", "l_orderkey", "l_linenumber", "l_tax")
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    assert "Exchange" not in _plan(features.chronological_split(df, order))
    filled = _plan(asof.global_fill(df, order, ["l_tax"]))  # behind the one range exchange, which is written
    assert "Exchange rangepartitioning" not in filled and "Window [last(l_tax" not in filled
    assert not re.search(r"Exchange hashpartitioning\(l_", filled)
