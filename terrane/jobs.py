"""Batch jobs: ingest (CSV text -> parcel table + dead letters) and export
(parcel table -> sale-metrics gold table -> dashboard JSON files).

These are the reference's ``make ingest`` and export steps as Spark jobs. The
ingest validates once: the validated rows are written to the shared
checkpoint folder, and both outputs are read from that one copy, so a lost
executor re-reads files instead of re-validating. The export writes the gold
table once and every dashboard query reads it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators import ingest as ing
from .operators import sales
from .plans import market, owners, stats, supply
from .session import ensure_checkpoint_dir
from .sources import files, sinks


def ingest_job(spark: SparkSession, csv_path: str, table_path: str, dlq_path: str, as_of_year: int,
               columns: list[str] | None = None) -> dict:
    """Read all-text CSV, validate, write the parcel table (last row per
    key wins; input position = file, split, line) and the dead letters,
    full refresh. Returns the counters processed / inserted / rejected."""
    text = files.read_text_csv(spark, csv_path, columns, position="pos")
    v = ing.validate_records(ing.null_na_tokens(text, keep=("pos",)), as_of_year, keep=("pos",))
    counted = Observation("ingest")
    ok = F.size("errors") == 0
    v = v.observe(counted, F.count(F.lit(1)).alias("processed"),
                  F.sum(F.when(ok, 1).otherwise(0)).alias("inserted"),
                  F.sum(F.when(ok, 0).otherwise(1)).alias("rejected"))
    ensure_checkpoint_dir(spark)
    v = v.checkpoint(eager=True)          # one validation pass for both outputs
    ing.upsert_last_wins(ing.accepted(v, keep=("pos",)), "schno", "pos").write.mode("overwrite").parquet(table_path)
    ing.rejected(v).write.mode("overwrite").option("header", "true").csv(dlq_path)
    return dict(counted.get)


def export_job(spark: SparkSession, records: DataFrame, out_dir: str, macro: DataFrame | None = None,
               gold_dir: str | None = None) -> list[str]:
    """The dashboard exports: sale metrics are written once as a gold table
    (partitioned by year), then market trends (single-unit), owner trends,
    seasonality, supply growth, mortgage history and the buyer/rate
    correlation matrix are computed from it and the parcels, as JSON records."""
    gold_dir = gold_dir or os.path.join(out_dir, "_gold", "sale_metrics")
    sinks.write_gold(sales.sale_metrics(records), gold_dir, partition_by=["tx_year"])
    metrics = spark.read.parquet(gold_dir)
    outputs = {
        "market_trends": market.market_trends(metrics, exclude_multiunit=True),
        "owner_trends": owners.owner_purchase_trends(records),
        "seasonality": market.seasonality(metrics),
        "supply_growth": supply.cumulative_supply(records),
    }
    if macro is not None:
        outputs["mortgage_history"] = stats.annual_mean(macro)
        frame = stats.buyer_rate_frame(stats.buyer_share_pivot(outputs["owner_trends"]), macro)
        outputs["correlation_matrix"] = stats.correlation_matrix(
            frame, ["out_of_state_share", "in_state_share", "local_share", "total_volume", "rate", "rate_delta"])
    written = []
    for name, df in outputs.items():
        path = os.path.join(out_dir, name)
        sinks.write_json(df, path)
        written.append(path)
    return written
