"""Owner, buyer and building-type analytics (A6-A8, A15-A21, Q3g-Q3k).

The owner frame is the parcel table left-joined to owner names on ``schno``
(a sort-merge join at scale, both sides keyed by the parcel id) with the
building class from the county's code table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes, decode


def building_type(code, description) -> "F.Column":
    """Residential labels by code first, then the keyword class of the description."""
    c = F.trim(F.col(code) if isinstance(code, str) else code)
    expr = None
    for label, vals in codes.RESIDENTIAL_BUILDING_LABELS.items():
        expr = F.when(c.isin(vals), label) if expr is None else expr.when(c.isin(vals), label)
    return expr.otherwise(decode.building_class(description))


def classify_codes(df: DataFrame, code_table: DataFrame, code_col: str = "bldg_code") -> DataFrame:
    """Q3g: attach ``building_type`` by a left join with the code table (code,
    description) on the trimmed code; an unknown code is Other. Of repeated
    codes one description counts, so no row multiplies."""
    ct = code_table.groupBy(F.trim("code").alias("_code")).agg(F.min("description").alias("description"))
    j = df.join(ct, F.trim(F.col(code_col)) == F.col("_code"), "left")
    return j.withColumn("building_type", building_type(code_col, "description")).drop("_code", "description")


def owner_frame(records: DataFrame, owner_names: DataFrame, code_table: DataFrame) -> DataFrame:
    """Parcels with owner name, owner type (Q3h), owner location (Q3d labels)
    and building type (Q3g)."""
    j = records.join(owner_names, "schno", "left")
    j = classify_codes(j, code_table)
    return j.select("schno", "city", "state", "sfla", "garage_size", "building_type", "primary_owner",
                    decode.owner_type("primary_owner").alias("owner_type"),
                    decode.owner_location_label().alias("location_type"))


def share(df: DataFrame, col: str, out: str = "percentage") -> DataFrame:
    """Normalised value counts in percent (NULLs excluded)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(col, (F.col("_n") * F.lit(100.0) / F.sum("_n").over(Window.partitionBy())).alias(out))


def owner_location_stats(records: DataFrame) -> DataFrame:
    """Parcels per mailing location with share of total."""
    g = records.groupBy(decode.owner_location().alias("location_type")).agg(F.count(F.lit(1)).alias("count"))
    return g.select("location_type", "count",
                    F.round(F.col("count") * F.lit(100.0) / F.sum("count").over(Window.partitionBy()), 2)
                    .alias("percentage"))


def inventory_profile(records: DataFrame) -> DataFrame:
    """Holdings per owner location (parcels with size and a sale fee)."""
    value = decode.estimated_value("docfee1")
    return (records.where((F.col("sfla") > 0) & (F.col("docfee1") > 0))
            .groupBy(decode.owner_location().alias("location_type"))
            .agg(F.count(F.lit(1)).alias("properties_owned"), F.avg("sfla").alias("avg_sqft"),
                 F.avg(value).alias("avg_value"), F.avg(decode.guarded_ppsf(value)).alias("avg_ppsf")))


def owner_purchase_trends(records: DataFrame, since_year: str = "1980") -> DataFrame:
    """Latest purchase year x owner location; a NULL fee still counts as a
    buyer, a zero fee enters the average."""
    year = F.date_format("recdate1", "yyyy")
    return (records.where(year.isNotNull() & (year >= since_year))
            .groupBy(year.alias("purchase_year"), decode.owner_location().alias("location_type"))
            .agg(F.count(F.lit(1)).alias("buyer_count"),
                 F.avg(decode.estimated_value("docfee1")).alias("avg_purchase_price")))


def properties_per_owner(frame: DataFrame, order: str = "schno") -> DataFrame:
    """Parcels per owner name, the owner's type and the location of its
    first parcel (first in ``order``), with the ownership category (Q3i).
    Partial aggregation bounds the work for an owner with very many parcels."""
    # ids are text: whole numbers by value, then any other text
    pos = F.struct(F.col(order).try_cast("bigint").isNull(), F.col(order).try_cast("bigint"), F.col(order))
    g = (frame.where(F.col("primary_owner").isNotNull())
         .groupBy("primary_owner")
         .agg(F.count(F.lit(1)).alias("n_properties"),
              F.min_by("owner_type", F.when(F.col("owner_type").isNotNull(), pos)).alias("owner_type"),
              F.min_by("location_type", F.when(F.col("location_type").isNotNull(), pos)).alias("location_type")))
    return g.withColumn("ownership_category", decode.ownership_category("n_properties"))


def ownership_distribution(per_owner: DataFrame, by: str = "owner_type") -> DataFrame:
    """Owners per (ownership category, owner type or location)."""
    return per_owner.groupBy("ownership_category", by).agg(F.count(F.lit(1)).alias("number_of_owners"))


def multi_owner_breakdown(per_owner: DataFrame) -> DataFrame:
    """Owners with more than one parcel, by owner type."""
    return (per_owner.where(F.col("n_properties") > 1).groupBy("owner_type")
            .agg(F.count(F.lit(1)).alias("number_of_owners")))


def large_owners(frame: DataFrame, min_properties: int = 10) -> DataFrame:
    """Owners with more than ``min_properties`` parcels and their parcel
    ids, one row per (owner, parcel). Owners are counted with a partial
    aggregate; only the qualifying owners' rows are kept (left semi join). The
    list stays in long form, so no owner's parcels are gathered into one row."""
    owned = frame.where(F.col("primary_owner").isNotNull()).select("primary_owner", "schno")
    big = (owned.groupBy("primary_owner").agg(F.count(F.lit(1)).alias("n_properties"))
           .where(F.col("n_properties") > min_properties))
    return owned.join(big, "primary_owner")


RESIDENTIAL = list(codes.RESIDENTIAL_BUILDING_LABELS)


def buyer_characteristics(frame: DataFrame) -> DataFrame:
    """Residential parcels by owner location and building type."""
    has_garage = (F.col("garage_size") > 0).cast("int")
    return (frame.where(F.col("building_type").isin(RESIDENTIAL))
            .groupBy("location_type", "building_type")
            .agg(F.avg("sfla").alias("avg_sqft"),
                 (F.avg(F.coalesce(has_garage, F.lit(0))) * 100).alias("pct_with_garage"),
                 F.count(F.lit(1)).alias("unit_count")))


def owner_portfolio(frame: DataFrame) -> DataFrame:
    """Residential parcels per (owner type, building type) and share within
    the owner type (a window over the small aggregate)."""
    g = (frame.where(F.col("building_type").isin(RESIDENTIAL))
         .groupBy("owner_type", "building_type").agg(F.count(F.lit(1)).alias("property_count")))
    total = F.sum("property_count").over(Window.partitionBy("owner_type"))
    return g.select("owner_type", "building_type", "property_count",
                    (F.col("property_count") / total * 100).alias("percentage"))


def out_of_state_states(frame: DataFrame) -> DataFrame:
    """Out-of-state parcels per mailing state (NULL states not counted)."""
    return (frame.where((F.col("location_type") == codes.OWNER_LOCATION_LABELS[2]) & F.col("state").isNotNull())
            .groupBy(F.col("state")).agg(F.count(F.lit(1)).alias("number_of_properties")))


def owner_occupancy(situs_df: DataFrame) -> DataFrame:
    """Q3j/Q3k: owner-occupancy summary (one row).

    The physical address is assembled from its parts (Q3j); a mailing address
    matches when it starts with it, or starts with the house number and
    contains the street name. PO boxes and city matches are counted alongside,
    and mismatches are split into in-state (outside the county) and out-of-state.
    """
    phys = decode.physical_address()
    mail = F.upper(F.trim(F.coalesce(F.col("address").cast("string"), F.lit("nan"))))
    num_txt = F.when(F.col("num").isNotNull(), F.col("num").cast("bigint").cast("string"))
    name_txt = F.coalesce(F.trim(F.col("name")), F.lit("nan"))
    match = (F.when((phys == "") | (mail == ""), False)
             .when(mail.startswith(phys), True)
             .when(num_txt.isNotNull() & name_txt.isNotNull() & mail.startswith(num_txt)
                   & mail.contains(name_txt), True)
             .otherwise(False))
    pcity = decode.decode("town", codes.TOWN_PHYSICAL_CITY, "OTHER")
    mcity = F.upper(F.trim(F.coalesce(F.col("city").cast("string"), F.lit("nan"))))
    is_co = F.upper(F.trim(F.coalesce(F.col("state").cast("string"), F.lit("nan")))) == codes.HOME_STATE
    local = mcity.isin(codes.COUNTY_TOWNS)
    flags = situs_df.select(match.alias("m"), mail.rlike(codes.PO_BOX_PATTERN).alias("po"),
                            (pcity == mcity).alias("cm"), is_co.alias("co"), local.alias("loc"))
    n = F.count(F.lit(1))

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0))
    return flags.agg(
        n.alias("total"),
        cnt(F.col("po")).alias("po_boxes"),
        cnt(F.col("cm")).alias("city_matches"),
        cnt(F.col("m")).alias("address_matches"),
        cnt(F.col("loc")).alias("county_local"),
        cnt(~F.col("m") & F.col("co") & ~F.col("loc")).alias("in_state_non_local"),
        cnt(~F.col("m") & ~F.col("co")).alias("out_of_state"),
    ).select("*", (F.col("address_matches") / F.col("total")).alias("address_match_share"),
             (F.col("po_boxes") / F.col("total")).alias("po_box_share"))
