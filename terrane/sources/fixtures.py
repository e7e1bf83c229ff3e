"""Domain tables derived from the driver's TPC-H-like test data.

The property data the analytics read (a wide parcel table, raw CSV text, owner
names, address points, macro series, scraped sale rows, landed pages, scored
predictions) is not shipped, so each is derived deterministically from
``customer``/``orders``/``lineitem``/``part`` with plain projections and one
grouped pivot. The same derivations exist as SQL in ``oracle/fixtures.py``
so that DuckDB checks every query on identical inputs. Both grow linearly with
the source tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ingest import conform_records
from ..operators.spread import spread
from .tables import read_table


def _k(c: str = "schno") -> Column:
    # 64 bits: products of a key pass 32 bits from 1.3 million parcels on
    return F.col(c).cast("bigint")


def _case(value: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(value == k, lit) if expr is None else expr.when(value == k, lit)
    return expr.otherwise(F.lit(default) if default is not None else F.lit(None).cast("string"))


def sale_slots(orders: DataFrame) -> DataFrame:
    """Every order as a sale of a parcel: ``o_orderkey div 4`` names the parcel
    and ``o_orderkey % 4 + 1`` the slot, so each parcel has up to four sales and
    no order is left out. A few slots have no date."""
    fee = (F.when(F.col("o_orderstatus") == "P", F.lit(0.0))
           .when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))
           .otherwise(F.col("o_totalprice") / 10000.0))
    slot = F.col("o_orderkey") % 4
    dated = F.when(F.col("o_orderkey") % 23 != 0, F.col("o_orderdate").cast("date"))
    aggs = [F.min("o_custkey").alias("custkey")]
    for i in range(4):
        aggs.append(F.max(F.when(slot == i, dated)).alias(f"recdate{i + 1}"))
        aggs.append(F.max(F.when(slot == i, fee)).alias(f"docfee{i + 1}"))
    return orders.groupBy(F.expr("o_orderkey div 4").alias("pk")).agg(*aggs)


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stands for ``raw_records``: one row per four orders, conformed to its schema.
    (Projections are SQL expression strings: one plan call per column.)"""
    customer = read_table(spark, sf_dir, "customer")
    slots = sale_slots(read_table(spark, sf_dir, "orders"))
    df = slots.join(customer, customer.c_custkey == slots.custkey, "left").selectExpr(
        "CAST(pk AS STRING) AS schno",
        *[f"{p}{i}" for i in range(1, 5) for p in ("recdate", "docfee")],
        "CAST(pk * 37 % 4001 AS DOUBLE) AS sfla",
        "CAST(1890 + pk * 7 % 135 AS INT) AS year_blt",
        "CAST(1890 + pk * 7 % 135 + CASE WHEN pk % 5 = 0 THEN 20 ELSE 0 END AS INT) AS adj_year_blt",
        "CAST(CASE WHEN pk % 11 = 0 THEN NULL ELSE 1 + pk % 3 END AS INT) AS units",
        "concat(c_name, ' ', CAST(pk AS STRING)) AS address",
        "CASE c_nationkey % 7 WHEN 0 THEN 'BRECKENRIDGE' WHEN 1 THEN 'FRISCO' WHEN 2 THEN 'DENVER' "
        "WHEN 3 THEN 'DALLAS' WHEN 4 THEN 'KEYSTONE' WHEN 5 THEN 'BOULDER' ELSE 'MIAMI' END AS city",
        "CASE c_nationkey % 7 WHEN 3 THEN 'TX' WHEN 6 THEN NULL ELSE 'CO' END AS state",
        "CASE c_nationkey % 12 WHEN 0 THEN 'B' WHEN 1 THEN 'F' WHEN 2 THEN 'D' WHEN 3 THEN 'S' WHEN 4 THEN 'K' "
        "WHEN 5 THEN 'C' WHEN 6 THEN 'M' WHEN 7 THEN 'R' WHEN 8 THEN 'BR' WHEN 9 THEN 'H' WHEN 10 THEN 'None' "
        "ELSE 'ZZ' END AS town",
        "CASE pk % 6 WHEN 0 THEN '1212' WHEN 1 THEN '1230' WHEN 2 THEN '1231' WHEN 3 THEN '1214' "
        "WHEN 4 THEN '100' ELSE NULL END AS abst1",
        "CASE pk % 10 WHEN 0 THEN '1212' WHEN 1 THEN '0' ELSE NULL END AS abst2",
        "CAST(pk % 6 AS DOUBLE) AS beds",
        "CAST(pk % 9 AS DOUBLE) / 2.0 AS bath_tot",
        "CASE WHEN pk % 4 <> 0 THEN CAST(pk % 3 * 240 AS DOUBLE) END AS garage_size",
        "CASE WHEN pk % 5 <> 0 THEN CAST(pk % 16 AS DOUBLE) / 8.0 END AS lot_size",
        "CASE pk % 9 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'E' WHEN 5 THEN 'F' WHEN 6 THEN 'X' "
        "WHEN 7 THEN 'Q' END AS grade",
        "CASE pk % 7 WHEN 0 THEN 'B' WHEN 1 THEN 'C' WHEN 2 THEN 'F' WHEN 3 THEN '?' END AS cond",
        "CASE WHEN pk % 8 < 6 THEN CAST(pk % 2 AS INT) END AS scenic_view")
    return conform_records(df)


def raw_text(parcels_df: DataFrame) -> DataFrame:
    """Stands for ``records.csv``: all-text rows with dirty values by modulo.
    (concat_ws('') skips NULL parts, as the SQL form's concat does.)"""
    k = "CAST(schno AS INT)"
    mdy = ("concat_ws('', CAST(month(recdate1) AS STRING), '/', CAST(day(recdate1) AS STRING), '/', "
           "CAST(year(recdate1) AS STRING))")
    return parcels_df.selectExpr(
        f"CASE WHEN {k} % 211 = 0 THEN NULL ELSE schno END AS schno",
        f"CASE WHEN {k} % 53 = 0 THEN 'NOT A DATE' WHEN {k} % 7 = 0 THEN concat_ws('', {mdy}, ' 9:13:25 AM') "
        f"ELSE {mdy} END AS recdate1",
        f"CASE WHEN {k} % 31 = 0 THEN 'n/a' WHEN {k} % 29 = 0 THEN '  25.50  ' "
        f"WHEN {k} % 37 = 0 THEN '1_000' WHEN {k} % 41 = 0 THEN '12d' WHEN {k} % 43 = 0 THEN '0x1p3' ELSE CAST({k} % 90 AS STRING) END "
        "AS docfee1",
        f"CASE WHEN {k} % 61 = 0 THEN '9999' WHEN {k} % 67 = 0 THEN '1995.5' ELSE CAST(year_blt AS STRING) END "
        "AS year_blt",
        f"CASE WHEN {k} % 97 = 0 THEN 'abc' WHEN {k} % 89 = 0 THEN '2005.0' ELSE CAST(adj_year_blt AS STRING) END "
        "AS adj_year_blt",
        "CAST(units AS STRING) AS units",
        f"CASE WHEN {k} % 101 = 0 THEN 'two' WHEN {k} % 103 = 0 THEN '2f' ELSE CAST(CAST(beds AS INT) AS STRING) END AS beds")


def owners(parcels_df: DataFrame) -> DataFrame:
    """Stands for ``owner_data.csv``; names hit every keyword class and its traps.
    A fifth of the parcels belong to owners of up to twenty, the others to pairs."""
    k = _k()
    stem = F.when(k % 5 == 0, F.floor(k / 100) * 2).otherwise(F.floor(k / 3) * 2 + 1)
    return parcels_df.where(k % 50 != 0).select(
        "schno",
        F.concat(_case(stem % 4, [(0, "PATRICK "), (1, "JONES "), (2, "Vincent ")], "ADAMS "),
                 stem.cast("string"),
                 _case(stem % 8, [(1, " LLC"), (3, " FAMILY TRUST"), (5, " CHURCH"), (7, " LTD")], ""))
        .alias("primary_owner"))


def address_points(parcels_df: DataFrame) -> DataFrame:
    """Stands for ``Address_Points_*.csv``: float-formatted ids, a ninth missing."""
    k = _k()
    return parcels_df.where(k % 9 != 0).select(
        F.concat(F.col("schno"), F.lit(".0")).alias("property_schedule"),
        (F.lit(39.45) + (k * 13 % 200).cast("double") / 1000.0).alias("latitude"),
        (F.lit(-106.20) + (k * 17 % 330).cast("double") / 1000.0).alias("longitude"),
        F.col("address").alias("full_address"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stands for a monthly macro series ``(date, value)``."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("date"))
            .agg(F.round(F.avg("l_discount") * 100, 6).alias("value")))


def scraped(parcels_df: DataFrame) -> DataFrame:
    """Stands for ``scraped_sales.csv``: both layouts, the no-sale marker, a bad date."""
    k = _k()
    return parcels_df.select(
        "schno",
        F.when(k % 5 == 0, F.lit("NO_SALES_FOUND"))
         .when(k % 7 == 0, F.concat(F.lit("Addr: | "), F.col("address"), F.lit(" | | "), F.col("schno"),
                                    F.lit(" | 1/1/2003 | WD | $500,000")))
         .when(k % 11 == 0, F.lit(" | 791376 | 5202005 | WD | $543,500"))
         .when(k % 13 == 0, F.lit(" | 791377 | 5/20/2005 | WD | $500f"))
         .otherwise(F.concat(F.lit(" | "), F.col("schno"), F.lit(" | 5/20/2002 | WD | $"),
                             (100 + k % 800).cast("string"), F.lit(",500")))
         .alias("raw_sales_row"))


def sale_pages(parcels_df: DataFrame) -> DataFrame:
    """Stands for landed detail pages: one sale row and one label row, or the
    empty-page text."""
    k = _k()
    html = F.when(k % 3 != 0, F.concat(
        F.lit("<html><body><table><tr><th>Reception</th><th>Sale Date</th></tr><tr><td>"),
        F.col("schno"), F.lit("</td><td>5/20/2002</td><td>WD</td><td>$"),
        (100 + k % 800).cast("string"),
        F.lit(",500</td></tr><tr><td>Primary:</td><td>OWNER "), F.col("schno"),
        F.lit("</td></tr></table></body></html>"))
    ).otherwise(F.lit("<html><body>No record found for Account</body></html>"))
    return spread(parcels_df.select("schno")).select(F.col("schno").alias("id"), html.alias("html"))


def detail_pages(parcels_df: DataFrame) -> DataFrame:
    """Stands for the county's detail pages: class-marked sections, a sales table nested in a cell, tags left
    unclosed, entities, comments; a seventh of the pages has no record, a ninth no land section."""
    k, text = _k(), F.col("schno")
    price = (100 + k % 800).cast("string")
    sale = F.concat(F.lit('<tr><td class="style2b">R'), text, F.lit('<td class="style2b">5/20/2002<td class=style2b>WD<td class="style2b">$'),
                    price, F.lit(",500"))
    older = F.when(k % 2 == 0, F.concat(F.lit('</tr><tr><td class="style2b">Q'), text, F.lit(
        "</td><td class='style2b'>1/2/1999</td><td class='style2b'>QCD</td><td class='style2b'>$5</td></tr>"))).otherwise(F.lit(""))
    detail = F.concat(
        F.lit("<html><!-- <table><tr><td>Primary:</td><td>nobody</td> --><body><TABLE border=0 CLASS=\"DetailData\"><tr><td>Primary:<td>OWNER &amp; "), text,
        F.lit(" LLC<tr><td>Addr:</td><td><b>PO BOX "), text,
        F.lit('</b>&nbsp;</td></tr><tr><td><table class="Inner"><tr><th>Reception</th><th>Sale Date</th></tr>'), sale, older,
        F.lit('<tr><td>end of sales</td></tr><tr><td class="style2b">a</td><td class="style2b">1/1/1990</td><td class="style2b">b</td><td class="style2b">$1</td></table></td></tr></table>'))
    value = F.concat(F.lit('<table class="ValueData"><tr><td>2025 Actual Value</td></tr><tr><td class="style2c">x</td><td class="style2c">Total<td class="style2c">'),
                     price, F.lit("000</tr><tr><td>2024 Actual Value</td><tr><td class=style2d>x</td><td class=style2d>Only two</td></tr></table>"))
    improved = F.concat(F.lit('<table class="ImpData"><tr><td class="Impstyle1">Beds:</td><td class="Impstyle2">'), (k % 6).cast("string"),
                        F.lit('</td><td class="Impstyle1">Baths:<td>?<td class="Impstyle2">'), (k % 4).cast("string"), F.lit("</table>"))
    land = F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<table class="LandData"><tr><td class="Impstyle1">Acres:</td><td class="Impstyle2">'), (k % 5).cast("string"), F.lit(".5</td></tr></table>")))
    html = F.when(k % 7 == 0, F.lit("<html><body>No Record Found for Account</body></html>")).otherwise(
        F.concat(detail, value, improved, land, F.lit("</body></html>")))
    # a page costs far more to parse than its id weighs: the ids are dealt before the pages are made
    return spread(parcels_df.select("schno")).select(text.alias("id"), html.alias("html"))


def predictions(parcels_df: DataFrame) -> DataFrame:
    """Stands for scored rows: actual and a deterministic prediction."""
    k = _k()
    actual = (F.lit(100000) + k * 1700).cast("double")
    return parcels_df.select(
        "schno", F.col("town").alias("city"),
        _case(k % 3, [(0, "Condo"), (1, "Single Family")], "Other").alias("prop_type"),
        F.col("recdate1").alias("tx_date"),
        actual.alias("actual"),
        (actual * (80 + k % 41).cast("double") / F.lit(100).cast("double")).alias("predicted"))


def code_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stands for the county's code table (code as printed, description): four
    residential codes, then one code per part, each with a class phrase."""
    phrases = ["RESIDENTIAL VACANT LAND", "COMMERCIAL VACANT LAND", "SINGLE FAMILY LAND", "LODGING STRUCTURE",
               "INDUSTRIAL VACANT LOTS", "MERCHANDISING STRUCTURE", "WAREHOUSE/STORAGE STRUCTURE",
               "LEASEHOLD CONDO/HOTEL LAND", "CHURCH LAND", "SCHOOL DISTRICT LAND", "AGRICULTURAL GRAZING LAND"]
    p = F.col("p_partkey").cast("int")
    return read_table(spark, sf_dir, "part").select(
        F.concat(F.when(p < 4, F.element_at(F.array(*map(F.lit, ["1212", "1214", "1230", "1231"])), p + 1))
                 .otherwise((p + 3000).cast("string")), F.lit(" ")).alias("code"),
        F.element_at(F.array(*map(F.lit, phrases)), p % len(phrases) + 1).alias("description"))


def with_building_code(parcels_df: DataFrame) -> DataFrame:
    """Adds a building-class code (padded text, as the code table prints it) and
    a garage size to the parcel rows; both picked deterministically by key. Some
    codes are in no table."""
    k = _k()
    code = (F.when(k % 17 == 0, F.lit("9999 "))
            .when(k % 3 == 0, F.element_at(F.array(*map(F.lit, ["1212 ", "1214 ", "1230 ", "1231 "])), (k % 4 + 1).cast("int")))
            .otherwise(F.concat((k % 190 + 3004).cast("string"), F.lit(" "))))
    return parcels_df.withColumns({
        "bldg_code": code,
        "garage_size": F.when(k % 4 == 0, F.lit(0.0)).otherwise((k % 3 * 200).cast("double")),
    })


def situs(parcels_df: DataFrame) -> DataFrame:
    """Physical-address parts and a mailing address per parcel: a quarter mail
    to the house itself, a quarter to the same number and street, a quarter to a
    PO box, the rest elsewhere."""
    k = _k()
    num = F.when(k % 13 == 0, F.lit(0)).otherwise(k % 997)
    name = _case(k % 3, [(0, "Main"), (1, "Ski Hill")], "Park")
    suff = _case(k % 2, [(0, "St")], "Rd")
    pdir = _case(k % 4, [(0, "N")])
    unit = F.when(k % 5 == 0, (k % 40).cast("string"))
    phys = F.concat_ws(" ", num.cast("string"), pdir, name, suff)
    mailing = (F.when(k % 4 == 0, F.upper(F.concat_ws(" ", phys, F.when(unit.isNotNull(), F.concat(F.lit("#"), unit)))))
               .when(k % 4 == 1, F.upper(F.concat(num.cast("string"), F.lit(" "), name, F.lit(" AVE"))))
               .when(k % 4 == 2, F.concat(F.lit("PO BOX "), (k % 300).cast("string")))
               .otherwise(F.col("address")))
    return parcels_df.select(
        "schno", "town", num.alias("num"), pdir.alias("pdir"), name.alias("name"), suff.alias("suff"),
        F.lit(None).cast("string").alias("sdir"), unit.alias("unit"),
        mailing.alias("address"), F.col("city"), F.col("state"))


def annual_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stands for an annual market index ``(year, avg_value, return_pct)``."""
    li = read_table(spark, sf_dir, "lineitem")
    a = li.groupBy(F.year("l_shipdate").alias("year")).agg(F.avg("l_extendedprice").alias("avg_value"))
    prev = F.lag("avg_value").over(Window.orderBy("year"))
    return a.select("year", "avg_value", ((F.col("avg_value") / prev - 1) * 100).alias("return_pct"))


def lift_lines() -> list[tuple[str, list[tuple[float, float]]]]:
    """A small lift network: three short lines near each resort point, named
    with that resort's first keyword, as ``(name, [(lon, lat), ...])``. Built by
    rule from the resort points (a literal; the real network is a GeoJSON file,
    see ``sources.files.read_lift_lines``)."""
    from ..functions import codes

    lines = []
    for resort, pts in codes.RESORT_POINTS.items():
        word = codes.RESORT_LIFT_KEYWORDS[resort][0]
        lat, lon = pts[0]
        for i in range(3):
            lines.append((f"{word} Lift {i + 1}",
                          [(lon - 0.003 + 0.002 * i, lat - 0.002), (lon + 0.001 + 0.002 * i, lat + 0.004)]))
    return lines


def lift_segments(parcels_df: DataFrame) -> DataFrame:
    """Stands for a lift network as line segments ``(name, x1, y1, x2, y2)`` in degrees: one at every 97th parcel's
    place, in turn for four resorts (none for the fifth), some without a name or of no resort."""
    k = _k()
    lat, lon = F.lit(39.45) + (k * 13 % 200).cast("double") / 1000.0, F.lit(-106.20) + (k * 17 % 330).cast("double") / 1000.0
    name = F.when(k % 97 == 0, F.concat(_case(k % 4, [(0, "Peak 8"), (1, "river run"), (2, "AMERICAN EAGLE")], "Pallavicini"),
                                        F.lit(" Lift "), F.col("schno"))).when(k % 97 == 1, F.lit("Scenic Gondola"))
    return parcels_df.where(k % 97 < 3).select(name.alias("name"), lon.alias("x1"), lat.alias("y1"), (lon + 0.004).alias("x2"), (lat - 0.003).alias("y2"))


def macro_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stands for the four macro series, from one aggregate: three monthly ones, the county's population yearly
    (null where a date has no value)."""
    li = read_table(spark, sf_dir, "lineitem")
    date = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("date")
    return li.groupBy(date).agg(
        F.round(F.avg("l_discount") * 100, 6).alias("mortgage_rate"), F.round(F.avg("l_tax") * 1000, 6).alias("cpi"),
        F.round(F.avg("l_extendedprice") / 100, 6).alias("sp500"), F.count(F.lit(1)).cast("double").alias("n")).select(
        "date", "mortgage_rate", "cpi", "sp500", F.when(F.month("date") == 1, F.col("n")).alias("county_pop"))
