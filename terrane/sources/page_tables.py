"""Tables of landed pages (S16, S17): a stack of open tables, rows and cells, whatever the page nests or leaves open.

One pass over a page's tags yields all its table rows in document order, each with the number of its table, the
sections it is in (the tables around it whose class is asked for, outermost first) and its own cells. What HTML lets a page leave out is implied: a new
cell ends the cell before it, a new row the row before it, the end of a table (or of the page) whatever is open inside.
A cell's text is its own; the text of a table inside it belongs to that table's cells. Everything after this pass is
native array functions on one row per page, so there is no shuffle.

Defined results: a null page has no rows; script, style and comments are no text; a row without cells is a row with an
empty list.
"""

from __future__ import annotations

import html as html_lib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL = pa.struct([("text", pa.string()), ("style", pa.string())])
ROW = pa.struct([("table", pa.int32()), ("sections", pa.list_(pa.string())), ("cells", pa.list_(CELL))])
ROWS = "array<struct<table: int, sections: array<string>, cells: array<struct<text: string, style: string>>>>"

# every alternative takes something and none looks further than the next ">" or the end: linear on any page
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b.*?(?:</(?P=raw)\s*>|\Z)"
                   r"|<(?P<close>/?)(?P<tag>table|tr|td|th)\b(?P<attrs>[^>]*)(?:>|\Z)|<[a-z/!?][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.I | re.S)
CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Classes of the county's detail pages.
DETAIL, VALUE, IMPROVEMENTS, LAND = "DetailData", "ValueData", "ImpData", "LandData"
LABEL_STYLE, VALUE_STYLE, SALE_STYLE = "Impstyle1", "Impstyle2", "style2b"
SECTIONS = frozenset({DETAIL, VALUE, IMPROVEMENTS, LAND})
ACTUAL_VALUES = {"2025 Actual Value": "style2c", "2024 Actual Value": "style2d"}


def rows_of(page: str, wanted: frozenset[str] = SECTIONS) -> list[dict]:
    """All table rows of a page in document order; of the classes around them those that are ``wanted``."""
    found: list[dict] = []
    # open tables: their number, wanted classes of them and those around, the open row, the open cell's text pieces
    tables: list[dict] = []
    number = 0

    def end_cell(table: dict) -> None:
        if table["pieces"] is not None:
            text = html_lib.unescape("".join(table["pieces"])).replace("\xa0", " ")
            table["row"]["cells"][-1]["text"] = text.strip()
            table["pieces"] = None

    def end_row(table: dict) -> None:
        end_cell(table)
        table["row"] = None

    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            if tables and tables[-1]["pieces"] is not None:
                tables[-1]["pieces"].append(m["text"])
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "table":
            if m["close"]:
                if tables:
                    end_row(tables.pop())
            else:
                style = CLASS.search(m["attrs"])
                around = tables[-1]["sections"] if tables else ()
                own = wanted.intersection("".join(style.groups("")).split()).difference(around) if style else ()
                tables.append({"number": number, "sections": (*around, *sorted(own)), "row": None, "pieces": None})
                number += 1
        elif tables:
            top = tables[-1]
            if tag == "tr":
                end_row(top)
                if not m["close"]:
                    top["row"] = {"table": top["number"], "sections": top["sections"], "cells": []}
                    found.append(top["row"])
            else:
                end_cell(top)
                if not m["close"]:
                    if top["row"] is None:  # a cell outside a row begins one
                        top["row"] = {"table": top["number"], "sections": top["sections"], "cells": []}
                        found.append(top["row"])
                    style = CLASS.search(m["attrs"])
                    top["row"]["cells"].append({"text": "", "style": "th" if tag == "th" else "".join(style.groups("")) if style else ""})
                    top["pieces"] = []
    for table in tables:
        end_row(table)
    return found


def page_rows(pages: DataFrame, id_col: str = "id", html_col: str = "html", wanted: frozenset[str] = SECTIONS) -> DataFrame:
    """schno, rows (see ``rows_of``), empty (the page says that there is no record): one row per page."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [rows_of(page or "", wanted) for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(ROW)), batch.column(2)], names=["schno", "rows", "empty"])

    empty = F.coalesce(F.lower(F.col(html_col)).contains("no record found"), F.lit(False)).alias("empty")
    return pages.select(F.col(id_col).cast("string").alias("schno"), F.col(html_col).alias("html"), empty).mapInArrow(
        parse, f"schno string, rows {ROWS}, empty boolean")


def _texts(cells: Column) -> Column:
    return F.transform(cells, lambda c: c["text"])


def _inside(rows: Column, section: str | None) -> Column:
    return F.filter(rows, lambda r: F.array_contains(r["sections"], section)) if section else rows


def sale_candidates(rows: Column) -> Column:
    """Cell texts of data rows with one cell that holds '/' and one that holds '$', joined by ' | '."""
    data = F.transform(rows, lambda r: _texts(F.filter(r["cells"], lambda c: c["style"] != "th")))
    sales = F.filter(data, lambda t: F.exists(t, lambda c: c.contains("/")) & F.exists(t, lambda c: c.contains("$")))
    return F.transform(sales, lambda t: F.array_join(t, " | "))


def next_cell(rows: Column, label: str) -> Column:
    """The text of the cell behind the first cell that reads ``label``, in the same row; null if there is none."""
    def behind(r: Column) -> Column:
        texts = _texts(r["cells"])
        return F.get(texts, F.array_position(texts, label).cast("int"))

    with_label = F.filter(rows, lambda r: F.array_contains(_texts(r["cells"]), label))
    return F.when(F.size(with_label) > 0, behind(F.get(with_label, F.lit(0))))


def label_map(rows: Column, section: str) -> Column:
    """Labels (without colons) and values of a section whose cells are marked as one or the other; the first of a label counts."""
    def pairs(r: Column) -> Column:
        cells = r["cells"]
        labelled = F.transform(cells, lambda c, i: F.struct(
            F.replace(c["text"], F.lit(":"), F.lit("")).alias("label"), c["style"].alias("style"),
            F.get(F.filter(F.slice(cells, i + 2, F.size(cells)), lambda v: v["style"] == VALUE_STYLE), F.lit(0))["text"].alias("value")))
        return F.filter(labelled, lambda p: (p["style"] == LABEL_STYLE) & (p["label"] != ""))

    found = F.flatten(F.transform(_inside(rows, section), pairs))
    first = F.filter(found, lambda p, i: F.array_position(F.transform(found, lambda q: q["label"]), p["label"]) == i + 1)
    return F.map_from_entries(F.transform(first, lambda p: F.struct(p["label"], p["value"])))


def actual_value(rows: Column, title: str, style: str) -> Column:
    """struct(type, value) of the row below the one titled ``title`` in the value section."""
    own = _inside(rows, VALUE)
    at = F.array_position(F.transform(own, lambda r: F.exists(_texts(r["cells"]), lambda c: c.contains(title))), True)
    below = F.filter(F.get(own, at.cast("int"))["cells"], lambda c: c["style"] == style)
    return F.when((at > 0) & (F.size(below) == 3), F.struct(F.get(below, F.lit(1))["text"].alias("type"), F.get(below, F.lit(2))["text"].alias("value")))


def sales_history(rows: Column) -> Column:
    """Sales (reception, sale_date, document_type, sale_price) below the header row of the detail section's sales table.

    They end with the table, or with its first row that has no cell of the sales' style; other rows than those of four
    such cells are passed over.
    """
    own = _inside(rows, DETAIL)
    header = F.array_position(F.transform(own, lambda r: F.exists(_texts(r["cells"]), lambda c: c.contains("Reception"))), True).cast("int")
    table = F.get(own, header - 1)["table"]
    below = F.filter(F.slice(own, F.greatest(header, F.lit(0)) + 1, F.size(own)), lambda r: r["table"] == table)
    sales = F.transform(below, lambda r: F.filter(r["cells"], lambda c: c["style"] == SALE_STYLE))
    stop = F.array_position(F.transform(sales, lambda cells: F.size(cells) == 0), True).cast("int")
    until = F.when(stop > 0, F.slice(sales, F.lit(1), stop - 1)).otherwise(sales)
    names = ("reception", "sale_date", "document_type", "sale_price")
    listed = F.transform(F.filter(until, lambda cells: F.size(cells) == 4),
                         lambda cells: F.struct(*(F.get(cells, F.lit(k))["text"].alias(n) for k, n in enumerate(names))))
    return F.when(header > 0, listed).otherwise(F.array().cast("array<struct<reception: string, sale_date: string, document_type: string, sale_price: string>>"))


def property_details(pages: DataFrame, labels: dict[str, str], id_col: str = "id", html_col: str = "html") -> DataFrame:
    """One row per page that has a record: label values and sales history of the detail section, actual values,
    and the maps of the improvement and land sections."""
    found = page_rows(pages, id_col, html_col).where(~F.col("empty"))
    detail = _inside(F.col("rows"), DETAIL)
    values = {f"value_{title[:4]}": actual_value(F.col("rows"), title, style) for title, style in ACTUAL_VALUES.items()}
    return found.select("schno", *(next_cell(detail, label).alias(name) for label, name in labels.items()),
                        *(v.alias(n) for n, v in values.items()), label_map(F.col("rows"), IMPROVEMENTS).alias("improvements"),
                        label_map(F.col("rows"), LAND).alias("land"), sales_history(F.col("rows")).alias("sales"))
