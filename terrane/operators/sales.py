"""Sale events and sale metrics (Q1, Q2, W1-W4; the A1 gold table).

The parcel table is wide: four ``(recdate_i, docfee_i)`` slots per row. One
``inline`` over an array of four structs unpivots them in a single scan (the
reference's four-branch UNION ALL read the table four times), and the parcel
columns the metrics need ride along, so the join back to the parcel disappears.
Because ``schno`` is the parcel key, each window partition holds at most four
events; LAG, the LAG date and COUNT share one exchange and one sort on ``schno``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import decode

SLOTS = 4

# Parcel columns carried through the unpivot into the metrics.
METRIC_CARRY = ["town", "sfla", "adj_year_blt", "year_blt", "units", "address", "grade", "cond", "scenic_view"]


def sale_events(records: DataFrame, carry: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """Q1+Q2: ``schno, tx_date, doc_fee, estimated_price, slot`` (+ carried columns).

    Only market sales: a date is present and the fee is positive.
    """
    carry = [c for c in (carry or []) if c != "schno"]
    structs = [F.struct(F.col(f"recdate{i}").alias("tx_date"), F.col(f"docfee{i}").alias("doc_fee"),
                        F.lit(str(i)).alias("slot")) for i in range(1, slots + 1)]
    return (records.select("schno", *carry, F.inline(F.array(*structs)))
            .where(F.col("tx_date").isNotNull() & (F.col("doc_fee") > 0))
            .select("schno", "tx_date", "doc_fee", decode.estimated_price("doc_fee").alias("estimated_price"),
                    "slot", *carry))


def with_sale_windows(events: DataFrame) -> DataFrame:
    """W1-W3 over one ``schno`` partitioning. Ties on the date are broken by the
    slot: slot 1 holds the latest sale, so a larger slot is older."""
    ordered = Window.partitionBy("schno").orderBy(F.col("tx_date"), F.col("slot").desc())
    whole = Window.partitionBy("schno")
    return events.select(
        "*",
        F.lag("estimated_price").over(ordered).alias("prev_price"),
        F.datediff(F.col("tx_date"), F.lag("tx_date").over(ordered)).cast("double").alias("days_held"),
        F.count(F.lit(1)).over(whole).alias("times_sold"),
    )


def growth_pct(price="estimated_price", prev="prev_price"):
    """ROUND((p - prev) * 100.0 / prev, 2); a zero previous price gives NULL."""
    return F.round(F.try_divide((F.col(price) - F.col(prev)) * F.lit(100.0), F.col(prev)), 2)


def sale_metrics(records: DataFrame) -> DataFrame:
    """A1: every market sale with its previous price, holding period, sales
    count, decoded city, renovation flag, growth and year (text, as stored).
    ``(schno, slot)`` identifies the event and breaks ties downstream."""
    events = with_sale_windows(sale_events(records, METRIC_CARRY))
    return events.select(
        "schno", "tx_date", "estimated_price", "prev_price", "days_held", "times_sold",
        decode.town_city("town").alias("city"),
        "sfla",
        decode.is_renovated().alias("is_renovated"),
        "units", "address", "grade", "cond", "scenic_view",
        growth_pct().alias("growth_pct"),
        F.date_format("tx_date", "yyyy").alias("tx_year"),
        "slot",
    )
