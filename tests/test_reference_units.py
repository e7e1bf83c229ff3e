"""Unit checks of the sale unpivot and of row validation."""

import datetime as dt

from pyspark.sql import functions as F

from terrane.operators import ingest as ing
from terrane.operators import sales


def _parcels(spark, slots_by_id):
    """Parcels with dated sale slots; a missing slot stays NULL."""
    names = [f"{kind}{i}" for i in (1, 2, 3) for kind in ("recdate", "docfee")]
    rows = [(key, *(v for i in range(3) for v in (slots[i] if i < len(slots) else (None, None))))
            for key, slots in slots_by_id.items()]
    types = ", ".join(f"{n} {'date' if n.startswith('rec') else 'double'}" for n in names)
    return ing.conform_records(spark.createDataFrame(rows, f"schno string, {types}"))


def test_every_filled_slot_is_one_event(spark):
    day = dt.date(1999, 3, 7)
    parcels = _parcels(spark, {"a7": [(day, 12.5), (day.replace(year=2003), 61000.0), (day.replace(year=1991), 0.0)],
                               "b9": [], "c2": [(None, 33.0), (day, 9999.0)]})
    got = {(r.schno, r.slot, r.tx_date.year, r.estimated_price) for r in sales.sale_events(parcels).collect()}
    # fees under 10,000 are ten-thousandths of the price; no date or no fee is no sale
    assert got == {("a7", "1", 1999, 125000), ("a7", "2", 2003, 61000), ("c2", "2", 1999, 99990000)}


def test_metrics_follow_the_sales_of_a_parcel(spark):
    first, second = dt.date(1988, 11, 30), dt.date(1994, 2, 14)
    parcels = _parcels(spark, {"k4": [(second, 26.0), (first, 40.0)]})
    by_date = {r.tx_date: r for r in sales.sale_metrics(parcels).collect()}
    assert by_date[first].prev_price is None and by_date[first].days_held is None
    last = by_date[second]
    assert (last.prev_price, last.growth_pct, last.times_sold) == (400000, -35.0, 2)
    assert last.days_held == (second - first).days


def _validate(spark, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return ing.validate_records(ing.null_na_tokens(df), 2025)


def test_validator_accepts_and_standardises(spark):
    v = _validate(spark, [("12345", "8/10/2012", "10.00", "2000")], ["schno", "recdate1", "docfee1", "year_blt"])
    r = v.collect()[0]
    assert r.errors == [] and r.recdate1 == dt.date(2012, 8, 10) and r.docfee1 == 10.0 and r.year_blt == 2000


def test_validator_bad_date_is_null_not_reject(spark):
    r = _validate(spark, [("1", "NOT A DATE")], ["schno", "recdate1"]).collect()[0]
    assert r.errors == [] and r.recdate1 is None


def test_validator_trims_numbers(spark):
    r = _validate(spark, [("1", "  25.50  ")], ["schno", "docfee1"]).collect()[0]
    assert r.docfee1 == 25.5


def test_validator_rejects_missing_id(spark):
    v = _validate(spark, [(None, "8/10/2012")], ["schno", "recdate1"])
    assert ing.rejected(v).count() == 1 and ing.accepted(v).count() == 0


def test_validator_edge_values(spark):
    rows = [("1", "2005.0", "2000"), ("2", "2005.5", "2000"), ("3", "abc", "2000"), ("4", " 12 ", "2000"),
            ("5", "2001", "1995.5"), ("6", "2001", "9999")]
    v = {r.schno: r for r in _validate(spark, rows, ["schno", "adj_year_blt", "year_blt"]).collect()}
    assert v["1"].errors == [] and v["1"].adj_year_blt == 2005
    assert v["2"].errors and v["3"].errors
    assert v["4"].adj_year_blt == 12
    assert v["5"].errors                       # fractional build year rejects
    assert v["6"].errors == [] and v["6"].year_blt is None   # out of range -> NULL


def test_date_layouts(spark):
    from terrane.functions.clean import standardize_date

    cases = {"13/10/2012": dt.date(2012, 10, 13), "2012": dt.date(2012, 1, 1), "20120810": dt.date(2012, 8, 10),
             "Aug 10 2012": dt.date(2012, 8, 10), "8/10/12": dt.date(2012, 8, 10), "2/30/2012": None,
             "1/1/1600": None, "8/10/2012 9:13:25 AM": dt.date(2012, 8, 10)}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.d for r in df.select("v", standardize_date("v").alias("d")).collect()}
    assert got == cases


def test_absent_column_defaults(spark):
    r = _validate(spark, [("1",)], ["schno"]).collect()[0]
    assert (r.units, r.sfla, r.beds, r.bath_tot, r.garage_size, r.lot_size) == (1, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_upsert_last_row_wins(spark):
    df = spark.createDataFrame([("A", 1, "old"), ("A", 2, "new"), ("B", 1, "only")], "schno string, pos int, v string")
    got = {r.schno: r.v for r in ing.upsert_last_wins(df).collect()}
    assert got == {"A": "new", "B": "only"}
