"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator id.

Each reads the driver's tables through the derived fixtures, so its work grows
with them. Keys are the SURVEY operator ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import sales
from ..sources import fixtures as fx
from . import market

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Registered parameter values. The fixture's sale dates span 1995-2001, so the
# seasonality query is registered from 1996 on (the reference default, 2010,
# would select nothing on this data); the comparable-sales clock is pinned.
SEASONALITY_AFTER = "1996"
COMPS_AS_OF = "2001-08-01"
COMPS_SUBJECT = ("BRECKENRIDGE", "Condo", 2000)


def register(key: str):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = fn
        return fn
    return deco


def _metrics(spark, d):
    return sales.sale_metrics(fx.parcels(spark, d))


@register("Q1")
def q1(spark, d):
    return sales.sale_events(fx.parcels(spark, d)).select("schno", "tx_date", "doc_fee", "estimated_price", "slot")


@register("A1")
def a1(spark, d):
    return market.sales_history(fx.parcels(spark, d))


@register("A2")
def a2(spark, d):
    return market.market_trends(_metrics(spark, d))


@register("A2_single_unit")
def a2_single(spark, d):
    return market.market_trends(_metrics(spark, d), exclude_multiunit=True)


@register("A3")
def a3(spark, d):
    return market.top_flippers(_metrics(spark, d))


@register("A4")
def a4(spark, d):
    return market.price_by_type(fx.parcels(spark, d))


@register("A9")
def a9(spark, d):
    return market.training_data(fx.parcels(spark, d))


@register("A10")
def a10(spark, d):
    city, ptype, sfla = COMPS_SUBJECT
    return market.comparable_sales(fx.parcels(spark, d), city, ptype, sfla, as_of=COMPS_AS_OF)


@register("A11")
def a11(spark, d):
    return market.seasonality(_metrics(spark, d), after_year=SEASONALITY_AFTER)


@register("A12")
def a12(spark, d):
    return market.renovation_impact(_metrics(spark, d))


@register("A13")
def a13(spark, d):
    return market.cumulative_supply_by_type(fx.parcels(spark, d))


@register("A14")
def a14(spark, d):
    return market.price_band_evolution(_metrics(spark, d))


@register("Q3m")
def q3m(spark, d):
    return market.dataset_sample(_metrics(spark, d), limit=1000)


# --- owners, inventory, supply, statistics ------------------------------------

from . import owners, stats, supply  # noqa: E402


def _frame(spark, d):
    p = fx.with_building_code(fx.parcels(spark, d))
    return owners.owner_frame(p, fx.owners(p), fx.code_table(spark, d))


def _owner_trends(spark, d):
    return owners.owner_purchase_trends(fx.parcels(spark, d))


def _buyer_rates(spark, d):
    piv = stats.buyer_share_pivot(_owner_trends(spark, d))
    return stats.buyer_rate_frame(piv, fx.macro(spark, d), fx.annual_index(spark, d))


MATRIX_COLS = ["out_of_state_share", "in_state_share", "local_share", "total_volume", "return_pct", "rate",
               "rate_delta"]


for _k, _fn in {
    "A5": lambda s, d: supply.cumulative_supply(fx.parcels(s, d)),
    "A6": lambda s, d: owners.owner_location_stats(fx.parcels(s, d)),
    "A7": lambda s, d: owners.inventory_profile(fx.parcels(s, d)),
    "A8": _owner_trends,
    "Q3g": lambda s, d: owners.classify_codes(fx.with_building_code(fx.parcels(s, d)), fx.code_table(s, d)).select(
        "schno", "bldg_code", "building_type"),
    "Q3h": lambda s, d: _frame(s, d).select("schno", "primary_owner", "owner_type"),
    "A15_owner_type": lambda s, d: owners.share(_frame(s, d), "owner_type"),
    "A15_location": lambda s, d: owners.share(_frame(s, d), "location_type"),
    "A15_building": lambda s, d: owners.share(_frame(s, d), "building_type"),
    "A16": lambda s, d: owners.properties_per_owner(_frame(s, d)),
    "A17_type": lambda s, d: owners.ownership_distribution(owners.properties_per_owner(_frame(s, d))),
    "A17_location": lambda s, d: owners.ownership_distribution(owners.properties_per_owner(_frame(s, d)),
                                                               "location_type"),
    "A17_multi": lambda s, d: owners.multi_owner_breakdown(owners.properties_per_owner(_frame(s, d))),
    "A18": lambda s, d: owners.large_owners(_frame(s, d)),
    "A19": lambda s, d: owners.buyer_characteristics(_frame(s, d)),
    "A20": lambda s, d: owners.owner_portfolio(_frame(s, d)),
    "A21": lambda s, d: owners.out_of_state_states(_frame(s, d)),
    "Q3k": lambda s, d: owners.owner_occupancy(fx.situs(fx.parcels(s, d))),
    "A22": lambda s, d: supply.supply_timeline(fx.parcels(s, d)),
    "A23": lambda s, d: supply.hotel_growth(owners.classify_codes(fx.with_building_code(fx.parcels(s, d)), fx.code_table(s, d))),
    "A24": lambda s, d: supply.contextual_growth(supply.supply_timeline(fx.parcels(s, d)).select(
        "year_blt", "cumulative_units"), {"macro_rate": fx.macro(s, d)}),
    "A25": lambda s, d: stats.annual_mean(fx.macro(s, d)),
    "A26": lambda s, d: stats.buyer_share_pivot(_owner_trends(s, d)),
    "A27": lambda s, d: stats.rate_delta(fx.macro(s, d)),
    "A28": lambda s, d: stats.share_rate_correlations(_buyer_rates(s, d)),
    "A29": lambda s, d: stats.correlation_matrix(_buyer_rates(s, d), MATRIX_COLS),
    "A30": lambda s, d: stats.correlation_test(_buyer_rates(s, d), "rate", "out_of_state_share"),
    "A31": lambda s, d: stats.trend_line(_buyer_rates(s, d), "rate", "out_of_state_share"),
    "A32": lambda s, d: stats.out_of_state_share(_owner_trends(s, d), 2000),
    "A33": lambda s, d: stats.headline_metrics(market.market_trends(_metrics(s, d), exclude_multiunit=True)),
    "A34": lambda s, d: stats.cross_city_trend(market.market_trends(_metrics(s, d), exclude_multiunit=True)),
    "A35": lambda s, d: supply.supply_per_resident(s, supply.cumulative_supply(fx.parcels(s, d))),
    "J3": lambda s, d: supply.supply_population_join(supply.cumulative_supply(fx.parcels(s, d)),
                                                     supply.known_population(s)),
    "A36": lambda s, d: stats.month_city_volume(market.seasonality(_metrics(s, d), after_year=SEASONALITY_AFTER)),
    "A37": lambda s, d: stats.slot_coverage(fx.parcels(s, d)),
    "A38": lambda s, d: stats.reconciliation(_owner_trends(s, d), fx.parcels(s, d),
                                             market.market_trends(_metrics(s, d)).columns),
    "A40": lambda s, d: stats.distinct_years(market.market_trends(_metrics(s, d), exclude_multiunit=True)),
}.items():
    REGISTRY[_k] = _fn


# --- ingest: S1-S7 --------------------------------------------------------------

from ..functions import clean  # noqa: E402
from ..operators import ingest as ing  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

INGEST_AS_OF_YEAR = 2025


def _validated(spark, d):
    return ing.validate_records(ing.null_na_tokens(fx.raw_text(fx.parcels(spark, d))), INGEST_AS_OF_YEAR)


def _two_batches(spark, d):
    """The text rows as a first load (pos 1) plus a later correction of every
    tenth parcel's fee (pos 2): the upsert must keep the correction."""
    raw = fx.raw_text(fx.parcels(spark, d))
    k = F.col("schno").cast("int")
    later = raw.where(k % 10 == 0).withColumn("docfee1", F.lit("99"))
    return raw.withColumn("pos", F.lit(1)).unionByName(later.withColumn("pos", F.lit(2)))


for _k, _fn in {
    "S1": lambda s, d: ing.null_na_tokens(fx.raw_text(fx.parcels(s, d))),
    "S2": lambda s, d: ing.accepted(_validated(s, d)),
    "S3": lambda s, d: fx.raw_text(fx.parcels(s, d)).select(
        "schno", "recdate1", clean.standardize_date("recdate1").alias("tx_date")),
    "S4": lambda s, d: fx.raw_text(fx.parcels(s, d)).select(
        "schno", "docfee1", clean.clean_numeric("docfee1").alias("doc_fee")),
    "S5": lambda s, d: fx.raw_text(fx.parcels(s, d)).select(
        "schno", "year_blt", clean.valid_year(clean.clean_numeric("year_blt"), INGEST_AS_OF_YEAR).alias("valid_year")),
    "S6": lambda s, d: ing.rejected(_validated(s, d)),
    "S7": lambda s, d: ing.ingest(_two_batches(s, d), INGEST_AS_OF_YEAR)[0],
    "S7_counts": lambda s, d: ing.ingest_counters(_validated(s, d)),
}.items():
    REGISTRY[_k] = _fn


# --- geo: G1-G7, A39 -------------------------------------------------------------

from ..operators import geo  # noqa: E402


def _points(spark, d):
    return geo.clean_address_points(fx.address_points(fx.parcels(spark, d)))


def _parcel_geo(spark, d):
    p = fx.parcels(spark, d)
    return geo.nearest_lift(geo.resort_point_distances(geo.join_coordinates(p, _points(spark, d))))


for _k, _fn in {
    "G1": _points,
    "G2": lambda s, d: geo.join_coordinates(market.training_data(fx.parcels(s, d)), _points(s, d)).select(
        "schno", "tx_date", "price", "city", "latitude", "longitude", "full_address"),
    "G3": lambda s, d: _parcel_geo(s, d).select("schno", *geo.DIST_COLS),
    "G4": lambda s, d: geo.nearest_lift(geo.lift_line_distances(
        geo.join_coordinates(fx.parcels(s, d), _points(s, d)), fx.lift_segments(fx.parcels(s, d)))).select(
        "schno", *geo.DIST_COLS, "dist_to_lift"),
    "G5": lambda s, d: _parcel_geo(s, d).select("schno", "dist_to_lift"),
    "G6": lambda s, d: geo.geo_export(_parcel_geo(s, d).withColumn("price", F.lit(0))),
    "G7": lambda s, d: geo.default_distances(fx.parcels(s, d).select("schno", "city")),
    "A39": lambda s, d: geo.distance_stats(_parcel_geo(s, d), "FRISCO"),
    "A39_by_city": lambda s, d: geo.mean_distance_by_city(_parcel_geo(s, d)),
}.items():
    REGISTRY[_k] = _fn


# --- features, evaluation, what-if: J4, F1-F14, M7-M8, M11-M13, M17-M18 ------------

from ..functions import codes  # noqa: E402
from ..operators import asof  # noqa: E402
from . import evaluate, features, whatif  # noqa: E402

CITY_CATEGORIES = sorted(set(codes.TOWN_CITY_ML.values()) | {codes.TOWN_CITY_ML_DEFAULT})
TYPE_CATEGORIES = ["Condo", "Other", "Single Family", "Townhouse"]
SPLIT_ORDER = ["tx_date", "schno", "price"]


def _training(spark, d):
    return market.training_data(fx.parcels(spark, d))


def _features(spark, d, global_ffill=False):
    return features.build_features(_training(spark, d), _points(spark, d), fx.macro_series(spark, d), global_ffill,
                                   fx.lift_segments(fx.parcels(spark, d)))


def _model_rows(spark, d):
    return features.model_rows(_features(spark, d))


def _predictions(spark, d):
    return fx.predictions(fx.parcels(spark, d))


def _runs(spark, d):
    return evaluate.runs_from_scores(_predictions(spark, d))


F1_COLS = ["schno", "tx_date", "price", "beds", "baths", "sfla", "year_blt", "garage_size", "acres", "grade", "cond",
           "scenic_view", "city", "prop_type", "latitude", "longitude", "full_address", *geo.DIST_COLS,
           "dist_to_lift", "year", "month", "mortgage_rate", "cpi", "sp500", "county_pop", "grade_numeric", "cond_numeric"]
Z_COLS = ["sfla", "year_blt", "mortgage_rate", "dist_to_lift"]


def _j4_ties(spark, d):
    """J4 with repeated and missing dates on both sides, one year with most of
    the rows, and a key: the later position of a day wins."""
    left = _training(spark, d).select(
        "schno", F.when(F.col("schno").cast("int") % 19 == 0, None)
        .when(F.col("schno").cast("int") % 3 == 0, F.make_date(F.lit(1997), F.lit(1) + F.col("schno").cast("int") % 12, F.lit(9)))
        .otherwise(F.col("tx_date")).alias("tx_date"), "price", (F.col("schno").cast("int") % 3).alias("k"))
    li = read_table(spark, d, "lineitem")
    right = li.select(
        (F.col("l_orderkey") % 4).cast("int").alias("k"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_shipdate").cast("date")).alias("date"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), F.col("l_quantity").cast("double").alias("value"))
    return asof.asof_join(left, right, "tx_date", "date", ["value"], by=["k"], right_order="pos").drop("k")


for _k, _fn in {
    "J4": lambda s, d: asof.asof_join(_training(s, d), fx.macro(s, d).withColumnRenamed("value", "mortgage_rate"),
                                      "tx_date", "date", ["mortgage_rate"]).select("schno", "tx_date", "price",
                                                                                  "mortgage_rate"),
    "J4_ties": _j4_ties,
    "F1": lambda s, d: _features(s, d).select(*F1_COLS),
    "F3": lambda s, d: _features(s, d, global_ffill=True).select(*F1_COLS),
    "F4": lambda s, d: features.fill_median(ing.accepted(_validated(s, d)), "year_blt").select("schno", "year_blt"),
    "F6": lambda s, d: _model_rows(s, d).select("schno", "tx_date", "price", "city", "prop_type", "mortgage_rate",
                                                "dist_to_lift"),
    "F7": lambda s, d: (lambda r: features.apply_scaler(r, features.fit_scaler(r, Z_COLS)))(_model_rows(s, d))
    .select("schno", "tx_date", "price", *[f"{c}_z" for c in Z_COLS]),
    "F8": lambda s, d: features.one_hot(_model_rows(s, d), {"city": CITY_CATEGORIES, "prop_type": TYPE_CATEGORIES})
    .select("schno", "tx_date", "price", *[f"city_{v}" for v in CITY_CATEGORIES],
            *[f"prop_type_{v}" for v in TYPE_CATEGORIES]),
    "F8_fit": lambda s, d: (lambda r: features.encode_categories(r, features.fit_categories(r.where(F.year("tx_date") < 2000))))(
        _model_rows(s, d)).select("schno", "tx_date", "price", "city_index", "prop_type_index"),
    "F10": lambda s, d: features.chronological_split(_model_rows(s, d), SPLIT_ORDER).select(
        "schno", "tx_date", "price", features.luxury_weight().alias("weight"), "role"),
    "F11": lambda s, d: features.random_split(_model_rows(s, d), "schno").select("schno", "tx_date", "price", "role"),
    "F12": lambda s, d: features.temporal_folds(_model_rows(s, d)).select("schno", "tx_date", "price", "fold", "role"),
    "F13": lambda s, d: features.iqr_filter(_model_rows(s, d), "price").select("schno", "tx_date", "price"),
    "F14_numeric": lambda s, d: features.scaler_metadata(_model_rows(s, d)),
    "F14_categories": lambda s, d: features.category_metadata(_model_rows(s, d)),
    "M7": lambda s, d: evaluate.metrics(_predictions(s, d)),
    "M8": lambda s, d: evaluate.residual_slices(_predictions(s, d)),
    "M11": lambda s, d: _runs(s, d).select("run_id", "model_name", F.col("metrics.mae").alias("mae"),
                                           F.col("metrics.r2").alias("r2"), "year",
                                           F.col("parameters")["epochs"].alias("epochs")),
    "M12": lambda s, d: evaluate.champions(_runs(s, d)),
    "M12_history": lambda s, d: evaluate.promotion_history(_runs(s, d)),
    "M13": lambda s, d: evaluate.leaderboard(_runs(s, d)),
    "M17": lambda s, d: whatif.similar_properties(fx.parcels(s, d), whatif.scenario_profiles(whatif.scenarios(s))),
    "M17_parcels": lambda s, d: whatif.similar_properties(
        fx.parcels(s, d), whatif.parcel_profiles(fx.parcels(s, d)).withColumnRenamed("schno", "subject_id"), leave_out_self=True),
    "M18": lambda s, d: evaluate.error_band(_predictions(s, d)).select(
        "schno", "predicted", "sigma", "low_1s", "high_1s", "low_2s", "high_2s"),
}.items():
    REGISTRY[_k] = _fn


# --- pages and scraped sales: S16-S21, J5 -------------------------------------------

from ..sources import page_tables  # noqa: E402
from ..sources import pages as pg  # noqa: E402
from ..sources.tables import read_table  # noqa: E402

OWNER_LABELS = {"Primary:": "primary_owner", "Secondary:": "secondary_owner", "Addr:": "mailing_address"}


def _details(spark, d, sales=False):
    """The detail sections, one column per value; or their sales, one row each."""
    found = page_tables.property_details(fx.detail_pages(fx.parcels(spark, d)), OWNER_LABELS)
    if sales:
        return found.select("schno", F.posexplode("sales").alias("sale_pos", "s")).select("schno", "sale_pos", "s.*")
    return found.select("schno", *OWNER_LABELS.values(), F.col("value_2025.type").alias("value_type"), F.col("value_2025.value").alias("value_2025"),
                        F.col("value_2024.value").alias("value_2024"), F.col("improvements")["Beds"].alias("beds"),
                        F.col("improvements")["Baths"].alias("baths"), F.col("land")["Acres"].alias("acres"), F.size("sales").alias("n_sales"))


def _all_scraped(spark, d):
    """Scraped rows from both layouts (pos 0) and rows parsed off landed pages (pos 1+)."""
    p = fx.parcels(spark, d)
    a = fx.scraped(p).withColumn("pos", F.lit(0))
    b = pg.sale_rows(fx.sale_pages(p)).select("schno", "raw_sales_row", (F.col("row_pos") + 1).alias("pos"))
    return a.unionByName(b)


for _k, _fn in {
    "S16": lambda s, d: pg.sale_rows(fx.sale_pages(fx.parcels(s, d))),
    "S16_pages": lambda s, d: pg.sale_rows(read_table(s, d, "pages"), id_col="page_id"),
    "S17": lambda s, d: pg.label_values(fx.sale_pages(fx.parcels(s, d)), OWNER_LABELS),
    "S16_nested": lambda s, d: pg.sale_rows(fx.detail_pages(fx.parcels(s, d))),
    "S17_sections": lambda s, d: _details(s, d),
    "S17_sales": lambda s, d: _details(s, d, sales=True),
    "S18": lambda s, d: pg.pending_ids(fx.parcels(s, d), fx.scraped(fx.parcels(s, d)).where(
        F.col("schno").cast("int") % 4 == 0)),
    "S19": lambda s, d: pg.parsed_sales(fx.scraped(fx.parcels(s, d))),
    "S20": lambda s, d: pg.latest_sale(pg.parsed_sales(_all_scraped(s, d), "pos")),
    "S21": lambda s, d: pg.merge_latest_sale(fx.raw_text(fx.parcels(s, d)),
                                             pg.latest_sale(pg.parsed_sales(_all_scraped(s, d), "pos"))),
}.items():
    REGISTRY[_k] = _fn
REGISTRY["J5"] = REGISTRY["S18"]


# --- sources, sinks and streams with a file round trip: S1_csv, S9, S10, S13-S15, R1, R2 ---

import os  # noqa: E402

from ..sources import files as fl  # noqa: E402
from ..sources import sinks  # noqa: E402
from ..streaming import ingest as st  # noqa: E402


def _s1_csv(spark, d):
    """The text rows through CSV files, with a note that holds quotes, commas and line breaks."""
    path = fl.scratch_path(spark, "records-csv")
    raw = fx.raw_text(fx.parcels(spark, d))
    note = F.concat(F.lit('unit "'), F.col("schno"), F.lit('",\n\nsecond line'))
    raw = raw.withColumn("note", F.when(F.col("schno").cast("int") % 3 == 0, note))
    raw.write.options(**fl.CSV_TEXT_OPTIONS).option("emptyValue", "").csv(path)
    return ing.null_na_tokens(fl.read_text_csv(spark, path, raw.columns))


def _s9(spark, d):
    root = fl.scratch_path(spark, "macro")
    fx.macro(spark, d).withColumn("year", F.year("date")).write.option("header", "true").csv(f"{root}/mortgage_rate")
    series = fl.read_macro_series(spark, {"mortgage_rate": f"{root}/mortgage_rate", "cpi": f"{root}/missing"})
    return series["mortgage_rate"]


def _rename_parts(spark, folder: str, name: str) -> None:
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, st_ in enumerate(fs.listStatus(fs_path)):
        p = st_.getPath()
        if p.getName().startswith("part-"):
            fs.rename(p, jvm.org.apache.hadoop.fs.Path(folder, f"{name}_{i}.csv"))


def _s10(spark, d):
    root = fl.scratch_path(spark, "address-points")
    pts = fx.address_points(fx.parcels(spark, d)).select(
        F.col("property_schedule").alias("PropertySchedule"), F.col("latitude").alias("LATITUDE"),
        F.col("longitude").alias("LONGITUDE"), F.col("full_address").alias("FullAddress"))
    k = F.col("PropertySchedule").cast("double").cast("bigint")
    pts.where(k % 2 == 0).write.option("header", "true").csv(f"{root}/east")
    pts.where(k % 2 == 1).write.option("header", "true").csv(f"{root}/west/nested")
    _rename_parts(spark, f"{root}/east", "Address_Points_East")
    _rename_parts(spark, f"{root}/west/nested", "Address_Points_West")
    return geo.clean_address_points(fl.read_address_points(spark, root), order="position")


def _s13(spark, d):
    """The matrix with its diagonal NaN and its negative values infinite, written as JSON records and read back."""
    path = fl.scratch_path(spark, "matrix-json")
    m = stats.correlation_matrix(_buyer_rates(spark, d), MATRIX_COLS)
    odd = F.when(F.col("var_a") == F.col("var_b"), float("nan")).when(F.col("r") < 0, float("-inf")).otherwise(F.col("r"))
    sinks.write_json(m.withColumn("r", odd), path)
    return spark.read.schema(m.schema).json(path)


def _s14(spark, d):
    path = fl.scratch_path(spark, "trends-csv")
    trends = market.market_trends(_metrics(spark, d))
    sinks.write_csv(trends, path)
    return spark.read.option("header", "true").schema(trends.schema).csv(path)


def _r1(spark, d):
    root = fl.scratch_path(spark, "pages-stream")
    p = fx.sale_pages(fx.parcels(spark, d))
    first = p.withColumn("landed_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    again = p.where(F.col("id").cast("int") % 5 == 0).withColumn("landed_at",
                                                                  F.lit("2024-01-01 00:10:00").cast("timestamp"))
    first.write.parquet(f"{root}/landing", mode="append")
    again.write.parquet(f"{root}/landing", mode="append")
    st.stream_page_rows(spark, f"{root}/landing", "id string, html string, landed_at timestamp",
                        f"{root}/_checkpoint", f"{root}/out")
    return st.page_rows(spark, f"{root}/out")


def _r2_root(spark, d):
    root = fl.scratch_path(spark, "ingest-stream")
    b = _two_batches(spark, d).withColumn("pos", F.col("pos").cast("int"))
    for pos in (1, 2):
        b.where(F.col("pos") == pos).write.parquet(f"{root}/landing", mode="append")
    schema = ", ".join(f"{c} string" for c in b.columns if c != "pos") + ", pos int"
    st.stream_validated_ingest(spark, f"{root}/landing", schema, root, INGEST_AS_OF_YEAR)
    return root


for _k, _fn in {
    "S1_csv": _s1_csv,
    "S9": _s9,
    "S10": _s10,
    "S13": _s13,
    "S14": _s14,
    "S15": lambda s, d: fl.freshness(read_table(s, d, "lineitem")).drop("exported_at"),
    "R1": _r1,
    "R2": lambda s, d: st.current_table(s, _r2_root(s, d)),
    "R2_dlq": lambda s, d: st.dead_letters(s, _r2_root(s, d)).drop("batch_id"),
}.items():
    REGISTRY[_k] = _fn


# --- models: M1-M5, M9, M10, M14-M16 (rows-only checks) -------------------------------
# M1 and M14-M16 are registered with small tree counts so the whole registry runs on one
# machine; the functions' defaults carry the reference's settings, as do the other queries.

from . import models  # noqa: E402


def _numeric(rows):
    return features.present_numeric(rows)


def _split_models(spark, d):
    rows = _model_rows(spark, d)
    split = features.chronological_split(rows, SPLIT_ORDER)
    return rows, split.where(F.col("role") == "train").drop("role"), split.where(F.col("role") == "test").drop("role")


def _small_gbt():
    return models.gbt(max_iter=20, step=0.1, depth=4)


def _subjects(spark):
    sc = whatif.scenarios(spark)
    return sc.withColumn("city", F.when(F.col("city") == "COPPER MOUNTAIN", "COPPERMOUNTAIN").otherwise(F.col("city")))


# the numeric features that the importance and dependence analyses look at
ANALYSED = ["sfla", "year_blt", "beds", "baths", "garage_size", "acres", "mortgage_rate", "cpi", "sp500", "county_pop", "dist_to_lift"]


def _m3(s, d):
    return models.permutation_importance(_features(s, d), ANALYSED, SPLIT_ORDER)


def _m4(s, d):
    return models.filtered_dependence(_features(s, d), "sfla", ANALYSED)


def _backtest(s, d):
    rows = _model_rows(s, d)
    return models.backtest_scores(rows, _numeric(rows), models.gbt)


def _m5(s, d):
    rows, train, _ = _split_models(s, d)
    m = models.fit(train, _numeric(rows), models.gbt())
    return models.shapley_importance(m, rows, train, _numeric(rows))


def _m14(s, d):
    rows, train, _ = _split_models(s, d)
    a = models.fit(train, _numeric(rows), _small_gbt())
    b = models.fit(train, _numeric(rows), models.forest(trees=10, depth=5))
    return models.compare_models(a, b, _subjects(s))


def _m15(s, d):
    rows, train, _ = _split_models(s, d)
    m = models.fit(train, _numeric(rows), _small_gbt())
    return models.sensitivity(m, _subjects(s), "sfla", scale=[0.5 + 0.1 * i for i in range(11)]).unionByName(
        models.sensitivity(m, _subjects(s), "mortgage_rate", values=[3.0 + 0.5 * i for i in range(15)]))


def _m16(s, d):
    rows, train, _ = _split_models(s, d)
    num = _numeric(rows)
    m = models.fit(train, num, _small_gbt())
    means = {k: v[0] for k, v in features.fit_scaler(train, num).items()}
    return models.baseline_deltas(m, _subjects(s), num, means)


for _k, _fn in {
    "M1": lambda s, d: (lambda r: models.train_and_score(r, _numeric(r), _small_gbt(), SPLIT_ORDER))(
        _model_rows(s, d)),
    "M2": lambda s, d: (lambda r: models.quantile_intervals(r[1], r[2], _numeric(r[0])))(_split_models(s, d)),
    "M3": _m3,
    "M4": _m4,
    "M5": _m5,
    "M9": lambda s, d: models.backtest(_backtest(s, d)),
    "M9_slices": lambda s, d: models.backtest_slices(_backtest(s, d)),
    "M10": lambda s, d: (lambda r: models.parameter_sweep(r, _numeric(r), models.SWEEP, SPLIT_ORDER))(_model_rows(s, d)),
    "M14": _m14,
    "M15": _m15,
    "M16": _m16,
}.items():
    REGISTRY[_k] = _fn


# --- remaining inventory ids: scalar decoders, windows, joins, sorting ---------------

from ..functions import decode as dec  # noqa: E402

EXPORT_CITIES = ["BRECKENRIDGE", "FRISCO", "SILVERTHORNE", "DILLON", "KEYSTONE", "COPPER MOUNTAIN", "BLUE RIVER"]


def _decoded(spark, d):
    """Q2, Q3a-Q3f, Q3l on the parcel table: one projection."""
    p = fx.parcels(spark, d)
    return p.select(
        "schno", dec.estimated_price("docfee1").alias("estimated_price"),
        dec.estimated_value("docfee1").alias("estimated_value"),
        dec.town_city().alias("city_decoded"), dec.town_city_ml().alias("city_ml"),
        dec.property_type().alias("prop_type"), dec.property_type(vacant_land=True).alias("prop_type_land"),
        dec.property_type_dashboard().alias("prop_type_dashboard"),
        dec.owner_location().alias("location_type"), dec.is_renovated().alias("is_renovated"),
        dec.guarded_ppsf(dec.estimated_value("docfee1")).alias("ppsf"),
        dec.quality_ordinal(F.substring("address", -1, 1)).alias("quality"))


def _s12(spark, d):
    import uuid
    view = f"raw_records_{uuid.uuid4().hex[:10]}"
    fx.parcels(spark, d).createOrReplaceTempView(view)
    return spark.sql(f"SELECT schno, year_blt, sfla FROM {view} WHERE year_blt > :y AND sfla >= :s",
                     args={"y": 1990, "s": 100.0})


def _map_dataset(spark, d):
    m = market.dataset_sample(_metrics(spark, d), limit=5000)
    newest = geo.first_per_key(m.select("schno", "tx_date", "slot", "address"), "schno",
                               [-F.unix_date("tx_date"), F.col("slot")])
    g = geo.nearest_lift(geo.resort_point_distances(geo.join_coordinates(newest, _points(spark, d))))
    g = g.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("dist_to_lift").isNotNull())
    return geo.distance_colours(g).select("schno", "latitude", "longitude", "dist_to_lift", "address", "r", "g", "b")


def _a1(spark, d):
    return sales.sale_metrics(fx.parcels(spark, d))


for _k, _fn in {
    "Q2": lambda s, d: _decoded(s, d).select("schno", "estimated_price", "estimated_value"),
    "Q3a": lambda s, d: _decoded(s, d).select("schno", "city_decoded"),
    "Q3b": lambda s, d: _decoded(s, d).select("schno", "city_ml"),
    "Q3c": lambda s, d: _decoded(s, d).select("schno", "prop_type", "prop_type_land", "prop_type_dashboard"),
    "Q3d": lambda s, d: _decoded(s, d).select("schno", "location_type"),
    "Q3e": lambda s, d: _decoded(s, d).select("schno", "is_renovated"),
    "Q3f": lambda s, d: _decoded(s, d).select("schno", "ppsf"),
    "Q3i": lambda s, d: owners.properties_per_owner(_frame(s, d)).select("primary_owner", "n_properties",
                                                                         "ownership_category"),
    "Q3j": lambda s, d: fx.situs(fx.parcels(s, d)).select("schno", dec.physical_address().alias("physical_address")),
    "Q3l": lambda s, d: _decoded(s, d).select("schno", "quality"),
    "Q3n": lambda s, d: fx.parcels(s, d).orderBy(F.md5(F.concat_ws("|", "schno", F.lit("42")).cast("binary")), "schno").limit(200).select(
        "schno", "city", "year_blt", "sfla", "beds"),
    "Q3o": lambda s, d: fx.parcels(s, d).where(F.col("city").isin(EXPORT_CITIES)).select("schno", "city", "address"),
    "Q3p": _map_dataset,
    "S8": lambda s, d: (lambda path: (_predictions(s, d).write.option("header", "true").csv(path),
                                      fl.read_inferred_csv(s, path))[1])(fl.scratch_path(s, "predictions-csv")),
    "S12": _s12,
    "J1": lambda s, d: sales.sale_events(fx.parcels(s, d)).join(
        fx.parcels(s, d).select("schno", "town", "sfla"), "schno").select(
        "schno", "tx_date", "slot", "estimated_price", dec.town_city("town").alias("city"), "sfla"),
    "J2": REGISTRY["G2"],
    "J6": lambda s, d: (lambda fr: fr.join(owners.properties_per_owner(fr).where(F.col("n_properties") > 1)
                                            .select("primary_owner"), "primary_owner", "left_semi")
                        .select("schno", "primary_owner"))(_frame(s, d)),
    "J7": REGISTRY["A13"],
    "J8": lambda s, d: (lambda m: m.join(exact_quantiles_(m), "tx_year").select(
        "schno", "slot", "tx_year", "estimated_price", "annual_median"))(
        _metrics(s, d).where(F.col("tx_year") > "1990")),
    "W1": lambda s, d: _a1(s, d).select("schno", "slot", "tx_date", "prev_price"),
    "W2": lambda s, d: _a1(s, d).select("schno", "slot", "days_held"),
    "W3": lambda s, d: _a1(s, d).select("schno", "slot", "times_sold"),
    "W4": lambda s, d: _a1(s, d).select("schno", "slot", "growth_pct"),
    "W5": REGISTRY["A5"],
    "W6": REGISTRY["A2"],
    "W7": REGISTRY["A24"],
    "W8": REGISTRY["A6"],
    "T1": lambda s, d: market.market_trends(_metrics(s, d)).orderBy("city", "tx_year"),
    "T2": REGISTRY["A3"],
    "T3": REGISTRY["Q1"],
    "T4": lambda s, d: geo.first_per_key(_a1(s, d).select("schno", "tx_date", "slot", "estimated_price"), "schno",
                                         [-F.unix_date("tx_date"), F.col("slot")]),
    "F2": lambda s, d: _training(s, d).select("schno", "tx_date", "price", F.year("tx_date").alias("year"),
                                              F.month("tx_date").alias("month")),
    "F5": lambda s, d: _features(s, d).select("schno", "tx_date", "price", "garage_size", "beds", "baths", "acres",
                                              "scenic_view"),
    "F9": lambda s, d: _model_rows(s, d).select("schno", "tx_date", "price", features.luxury_weight().alias("weight")),
}.items():
    REGISTRY[_k] = _fn


def exact_quantiles_(m):
    from ..operators.quantile import exact_quantiles
    return exact_quantiles(m, ["tx_year"], "estimated_price", {"annual_median": 0.5})


def _a10_bulk(spark, d):
    """Every parcel as a subject: its town's city (or none), type and size."""
    p = fx.parcels(spark, d)
    city = F.coalesce(*(F.when(F.col("town") == t, F.lit(c)) for t, c in codes.TOWN_CITY_ML.items()), F.lit("NOWHERE"))
    subjects = p.select(F.col("schno").alias("subject_id"), city.alias("city"), dec.property_type().alias("prop_type"), "sfla")
    return market.comparable_sales_many(p, subjects, as_of=COMPS_AS_OF)


REGISTRY["A10_bulk"] = _a10_bulk


# --- S11: GeoJSON line scan over lines derived from the address points ----------------

def _s11(spark, d):
    """One line per town through the address points of its lowest and highest
    parcel id, written as a GeoJSON FeatureCollection (one aggregate row: the
    line set is bounded by the number of towns), then scanned back as segments."""
    p = fx.parcels(spark, d).select("schno", "town")
    pts = geo.join_coordinates(p, _points(spark, d)).where(F.col("latitude").isNotNull() & F.col("town").isNotNull())
    k = F.struct(F.col("schno").try_cast("bigint").isNull(), F.col("schno").try_cast("bigint"), F.col("schno"))
    ends = pts.groupBy("town").agg(F.min_by(F.struct("longitude", "latitude"), k).alias("a"),
                                   F.max_by(F.struct("longitude", "latitude"), k).alias("b"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.create_map(F.lit("name"), F.concat(F.lit("Town "), F.col("town"), F.lit(" Lift"))).alias("properties"),
        F.struct(F.lit("LineString").alias("type"),
                 F.array(F.array("a.longitude", "a.latitude"), F.array("b.longitude", "b.latitude"))
                 .alias("coordinates")).alias("geometry"))
    doc = ends.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                      F.collect_list(feature).alias("features"))).alias("value"))
    path = fl.scratch_path(spark, "lift-lines")
    doc.coalesce(1).write.text(path)
    return fl.lift_segments(fl.read_lift_lines(spark, path))


REGISTRY["S11"] = _s11


# --- planned analyses: drift, coverage, size curve, holding periods, cohorts, luxury tail ----

from . import monitor  # noqa: E402

DRIFT_COLS = ["sfla", "price", "mortgage_rate", "dist_to_lift"]


def _drift(spark, d):
    """The test share of the chronological split against its train share."""
    rows = features.chronological_split(_model_rows(spark, d), SPLIT_ORDER)
    return monitor.drift(rows.where("role = 'train'"), rows.where("role = 'test'"), DRIFT_COLS)


for _k, _fn in {
    "P_drift": _drift,
    "P_coverage": lambda s, d: monitor.coverage(fx.parcels(s, d), ["sfla", "town", "abst1", "abst2", "garage_size", "lot_size", "grade", "units", "zip_code"]),
    "P_size_curve": lambda s, d: monitor.size_curve(_metrics(s, d)),
    "P_holding": lambda s, d: monitor.holding_periods(_metrics(s, d)),
    "P_cohorts": lambda s, d: monitor.cohort_appreciation(_metrics(s, d)),
    "P_tail": lambda s, d: monitor.luxury_tail(_metrics(s, d)),
}.items():
    REGISTRY[_k] = _fn

REGISTRY["M11_append"] = lambda s, d: (lambda r: evaluate.append_run(
    r, r.select(F.col("run_id").cast("long").alias("seq"), "model_name", "metrics", "parameters", "year")))(_runs(s, d)).select(
    "run_id", "model_name", F.col("metrics.mae").alias("mae"), "year")
REGISTRY["M18_champion"] = lambda s, d: evaluate.model_error_band(_predictions(s, d), _runs(s, d), "gbm").select(
    "schno", "predicted", "sigma", "low_1s", "high_1s", "low_2s", "high_2s")
