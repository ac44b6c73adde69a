"""Empty-lane demand from carrier invoices (store -> DC moves that return empty)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deadhead import labels
from deadhead.config import DEFAULT, Params
from deadhead.sources.tables import Sources

# rows without an invoice id match no header; this many keys spread them over the join's tasks
NULL_KEYS = 4096


def _qualifying_lines(src: Sources, p: Params) -> DataFrame:
    ship_day = F.coalesce("shp_dt", F.to_date("arvl_ts"), F.to_date("dprt_ts"))
    type_pair = F.concat("orig_fac_typ_ind", F.lit("-"), "dest_fac_typ_ind")
    since = F.lit(p.since)
    return (
        src.invoice_lines.filter(F.col("ond_shp_typ_cd").isin(*p.ship_types))
        .filter(type_pair.isin(*labels.EMPTY_TYPE_PAIRS))
        # implied by the next filter, but one the Parquet reader can use to skip row groups
        .filter(F.col("shp_dt").isNull() | (F.col("shp_dt") >= since))
        .withColumn("ship_day", ship_day)
        .filter(F.col("ship_day") >= since)
    )


def lane_totals(src: Sources, p: Params = DEFAULT) -> DataFrame:
    """The one pass over the invoices: loads and miles per (header DC, lane).

    Lines meet their header in a single shuffle of narrow, filtered rows; the aggregate is combined before it
    is shuffled. What follows works on lanes, whose number does not grow with the invoices.
    """
    lines = _qualifying_lines(src, p)
    # a date listed n times counts n times
    days = src.calendar.filter(F.col("cal_dt") >= F.lit(p.since)).groupBy("cal_dt").agg(F.count(F.lit(1)).alias("w"))
    lines = lines.join(days, lines.ship_day == days.cal_dt, "inner")
    lines = lines.select(
        "invoice_id",
        F.col("orig_fac_als_id").alias("o_id"),
        F.col("orig_fac_typ_ind").alias("o_type"),
        F.col("orig_pstl_cd").alias("o_zip"),
        F.col("dest_fac_als_id").alias("d_id"),
        F.col("dest_fac_typ_ind").alias("d_type"),
        F.col("dest_pstl_cd").alias("d_zip"),
        "mile_cnt",
        "w",
        F.when(
            F.col("invoice_id").isNull(),
            F.pmod(F.xxhash64("orig_fac_als_id", "dest_fac_als_id", "mile_cnt", "ship_day"), F.lit(NULL_KEYS)),
        )
        .otherwise(F.lit(0))
        .cast("int")
        .alias("null_key"),
    )
    # not a literal: Catalyst would turn the equality into a filter and drop it from the join key
    no_id = F.when(F.col("invoice_id").isNull(), F.lit(1)).otherwise(F.lit(0))
    headers = src.invoices.select("invoice_id", "dc_nbr", no_id.alias("null_key"))
    joined = lines.join(headers, ["invoice_id", "null_key"], "left")
    return joined.groupBy("dc_nbr", "o_id", "o_type", "o_zip", "d_id", "d_type", "d_zip").agg(
        F.sum("w").alias("loads"),
        F.sum(F.col("w") * F.col("mile_cnt")).alias("miles"),
        F.sum(F.when(F.col("mile_cnt").isNotNull(), F.col("w"))).alias("mile_rows"),
    )


def _places(src: Sources, role: str) -> DataFrame:
    """City and state per facility; a facility listed with several zips counts once for each of them."""
    return (
        src.locations.select("loc_nbr", "city_nm", "st_cd", "pstl_cd")
        .distinct()
        .groupBy("loc_nbr", "city_nm", "st_cd")
        .agg(F.count(F.lit(1)).alias(f"{role}_w"))
        .select(
            F.col("loc_nbr").alias(f"{role}_loc"),
            F.col("city_nm").alias(f"{role}_city"),
            F.col("st_cd").alias(f"{role}_state"),
            f"{role}_w",
        )
    )


def empty_demand(src: Sources, p: Params = DEFAULT, totals: DataFrame | None = None) -> DataFrame:
    """Lanes with at least ``min_loads`` empty returns, one row per lane, campus and carrier.

    Every dimension join multiplies a lane's rows by a number that depends on the lane alone, so the joins
    run after the aggregation and the sums are weighted by those numbers.
    """
    lanes = lane_totals(src, p) if totals is None else totals
    moves = src.dc_transitions.select("old_bdc_nbr", "new_bdc_nbr")
    campus = src.campus_map.select("campus", "campus_nbr_nm", "campus_name", "scac")
    joined = (
        lanes.join(moves, F.col("d_id") == F.col("old_bdc_nbr"), "left")
        .join(campus, F.col("dc_nbr") == F.col("campus_name"), "left")
        .join(_places(src, "o"), F.col("o_id") == F.col("o_loc"), "left")
        .join(_places(src, "d"), F.col("d_id") == F.col("d_loc"), "left")
    )
    weight = F.coalesce("o_w", F.lit(1)) * F.coalesce("d_w", F.lit(1))
    grouped = joined.groupBy(
        F.col("campus").alias("region"),
        "campus_nbr_nm",
        "dc_nbr",
        "scac",
        "o_id",
        "o_type",
        "o_zip",
        "o_city",
        "o_state",
        F.coalesce("new_bdc_nbr", "d_id").alias("d_id"),
        "d_type",
        "d_zip",
        "d_city",
        "d_state",
    ).agg(
        (F.sum(F.col("miles") * weight) / F.sum(F.col("mile_rows") * weight)).alias("dist"),
        F.sum(F.col("loads") * weight).alias("loads"),
    )
    return grouped.filter(F.col("loads") >= p.min_loads).select(
        "region",
        "campus_nbr_nm",
        "dc_nbr",
        "scac",
        "o_id",
        "o_type",
        "o_zip",
        "o_city",
        "o_state",
        "d_id",
        "d_type",
        "d_zip",
        "d_city",
        "d_state",
        F.lit(labels.STORE_TO_DC).alias("leg"),
        "dist",
        "loads",
        F.lit(p.default_oneway_cost).cast("long").alias("ow_cost_per_load"),
    )
