"""Table rows of pages: nested, unclosed and hostile pages."""

import time

from terrane.sources import page_tables as pt
from terrane.sources import pages as pg


def cells(page):
    return [(r["table"], list(r["sections"]), [c["text"] for c in r["cells"]]) for r in pt.rows_of(page, frozenset({"Out", "In"}))]


def test_implied_ends_and_nesting():
    assert cells("<table><tr><td>a<td>b<tr><td>c") == [(0, [], ["a", "b"]), (0, [], ["c"])]
    nested = "<table class='Out er'><tr><td>x<table class=In><tr><td>1</td><td>2</table>y</td><td>z</td></tr></table>"
    assert cells(nested) == [(0, ["Out"], ["xy", "z"]), (1, ["Out", "In"], ["1", "2"])]
    assert cells("<td>no table</td><table><td>no row<td>b</table><table></table>") == [(0, [], ["no row", "b"])]
    assert cells("<table><tr></tr><TR><TH>H</TH><td> a &amp;&nbsp;<b>b</b> </td></table></table>") == [(0, [], []), (0, [], ["H", "a & b"])]
    assert cells("<table><tr><td>a<!-- <td>no --><script>'<td>'</script>b") == [(0, [], ["ab"])]
    assert cells("<table><tr><td>1 < 2<td a='") == [(0, [], ["1 < 2", ""])]
    assert cells("") == []


def test_hostile_pages_are_read_in_linear_time():
    for bad in ("<table><tr><td>" * 60_000, "<td " * 200_000, "<!--" * 200_000, "</table></td>" * 60_000, "<table><td>" + "<" * 500_000, "<script>" * 100_000):
        begin = time.time()
        pt.rows_of(bad)
        assert time.time() - begin < 10


def test_details_of_odd_pages(spark):
    sale = "<td class=style2b>R</td><td class=style2b>1/1/2000</td><td class=style2b>WD</td><td class=style2b>$5</td>"
    page = ("<table class=DetailData><tr><td>Primary:</td></tr><tr><td>Primary:</td><td>late</td></tr><tr><td>Reception</td></tr><tr>" + sale
            + "</tr><tr><td class=style2b>three</td><td>no</td></tr><tr>" + sale + "</tr><tr><td>end</td></tr><tr>" + sale + "</table>"
            "<table class=ImpData><td class=Impstyle1>A:</td><td class=Impstyle2>1</td><td class=Impstyle1>A</td><td class=Impstyle2>2</td><td class=Impstyle1>B:</td></table>")
    rows = spark.createDataFrame([("1", page), ("2", None), ("3", "No record FOUND for Account"), ("4", "")], "id string, html string")
    got = {r["schno"]: r for r in pt.property_details(rows, {"Primary:": "owner"}).collect()}
    assert set(got) == {"1", "2", "4"}
    assert got["1"]["owner"] is None and len(got["1"]["sales"]) == 2 and got["1"]["improvements"] == {"A": "1", "B": None}
    assert got["2"]["sales"] == [] and got["2"]["land"] == {} and got["4"]["value_2025"] is None
    assert {r["schno"]: r["raw_sales_row"] for r in pg.sale_rows(rows.where("id <> '1'")).collect()} == dict.fromkeys("234", pg.NO_SALES)
    assert pt.property_details(rows.where("false"), {}).count() == 0
