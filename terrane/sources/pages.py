"""Landed detail pages and scraped sale rows.

Pages become table rows in one pass over their tags (``page_tables``); what is
read from the rows, and the scraped text rows, are native array and string
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import page_tables as tables

NO_SALES = "NO_SALES_FOUND"


def sale_rows(pages: DataFrame, id_col: str = "id", html_col: str = "html") -> DataFrame:
    """One row per ``<tr>`` whose cells include one with '/' and one with
    '$' (cells joined by ' | '); a page without any yields one NO_SALES_FOUND row.
    ``row_pos`` keeps the row's order within its page."""
    joined = tables.sale_candidates(F.col("rows"))
    out = tables.page_rows(pages, id_col, html_col).select(
        "schno", F.when(F.size(joined) > 0, joined).otherwise(F.array(F.lit(NO_SALES))).alias("_r"))
    return out.select("schno", F.posexplode("_r").alias("row_pos", "raw_sales_row"))


def label_values(pages: DataFrame, labels: dict[str, str], id_col: str = "id", html_col: str = "html",
                 table_class: str | None = None) -> DataFrame:
    """For each label cell (e.g. 'Primary:'), the text of the next cell of its row.

    Pages mentioning "no record found" are skipped. With ``table_class`` only
    tables of that class (and tables in them) are searched (the reference reads
    ``DetailData``); a missing table gives NULL values.
    """
    rows = F.col("rows")
    if table_class:
        rows = F.filter(rows, lambda r: F.array_contains(r["sections"], table_class))
    wanted = frozenset({table_class} - {None})
    kept = tables.page_rows(pages, id_col, html_col, wanted).where(~F.col("empty"))
    return kept.select("schno", *[tables.next_cell(rows, label).alias(name) for label, name in labels.items()])


def parse_sale_row(raw: str | Column = "raw_sales_row") -> Column:
    """``struct(rec_no, date, doc_type, price)`` or NULL.

    Parts are split on '|' and trimmed; the last part with '$' is the price
    (an unparsable price drops the row); the three parts before it are
    reception number, date and document type; the date must contain '/',
    and an unparsable date becomes NULL with the row kept.
    """
    from ..functions.clean import number, standardize_date

    r = F.col(raw) if isinstance(raw, str) else raw
    parts = F.transform(F.split(r, r"\|"), lambda p: F.trim(p))
    idx = F.array_max(F.transform(parts, lambda p, i: F.when(p.contains("$"), i)))  # 0-based
    price = F.trim(F.regexp_replace(F.element_at(parts, (idx + 1).cast("int")), r"[$,]", ""))
    price = number(price)
    date_txt = F.element_at(parts, (idx - 1).cast("int"))
    ok = (r.isNotNull() & (r != NO_SALES) & idx.isNotNull() & (idx >= 3) & price.isNotNull()
          & date_txt.contains("/"))
    return F.when(ok, F.struct(F.element_at(parts, (idx - 2).cast("int")).alias("rec_no"),
                               standardize_date(date_txt).alias("date"),
                               F.element_at(parts, idx.cast("int")).alias("doc_type"),
                               price.alias("price")))


def parsed_sales(scraped_rows: DataFrame, pos: str | None = None) -> DataFrame:
    """S19 over a table of ``schno, raw_sales_row`` (+ optional input position)."""
    p = scraped_rows.select("schno", *([pos] if pos else []), parse_sale_row().alias("s"))
    return p.where(F.col("s").isNotNull()).select("schno", *([pos] if pos else []), "s.*")


def latest_sale(parsed: DataFrame, pos: str = "pos") -> DataFrame:
    """Per parcel, the sale with the latest date (NULL dates last, then the
    earliest input position). A partial aggregate (``max_by``), so a parcel
    with many rows is reduced map-side."""
    key = F.struct(F.col("date").isNotNull(), F.col("date"), -F.col(pos))
    return (parsed.groupBy("schno").agg(F.max_by(F.struct("rec_no", "date", "doc_type", "price"), key).alias("l"))
            .select("schno", "l.*"))


def merge_latest_sale(records: DataFrame, latest: DataFrame) -> DataFrame:
    """Left merge; where the scraped date is present, slot 1 takes it
    (``M/d/yyyy`` text), with price, document type and reception number.
    ``updated`` flags the rows that changed (their sum is the updated count)."""
    j = records.join(latest.withColumnRenamed("date", "_date"), "schno", "left")
    has = F.col("_date").isNotNull()

    def old(c):
        return F.col(c).cast("string") if c in records.columns else F.lit(None).cast("string")
    keep = [c for c in records.columns if c not in ("recdate1", "docfee1", "rectype1", "recno1")]
    return j.select(*keep,
                    F.when(has, F.date_format("_date", "M/d/yyyy")).otherwise(old("recdate1")).alias("recdate1"),
                    F.when(has, F.col("price").cast("string")).otherwise(old("docfee1")).alias("docfee1"),
                    F.when(has, F.col("doc_type")).otherwise(old("rectype1")).alias("rectype1"),
                    F.when(has, F.col("rec_no")).otherwise(old("recno1")).alias("recno1"),
                    has.alias("updated"))


def pending_ids(all_ids: DataFrame, processed: DataFrame, key: str = "schno") -> DataFrame:
    """Distinct ids not yet processed (``left_anti``)."""
    return all_ids.select(key).where(F.col(key).isNotNull()).dropDuplicates([key]).join(
        processed.select(key), key, "left_anti")
