"""Filling missing leg distances: table, reversed table, coordinates, hand-kept list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deadhead.config import DEFAULT, Params
from deadhead.functions.geo import road_miles
from deadhead.functions.tables import fill_from

ZIPS = ["o_zip", "d_zip"]


def _known(distance_table: DataFrame, name: str) -> DataFrame:
    return distance_table.groupBy(*ZIPS).agg(F.avg("dist").alias(name))


def fill_forward(legs: DataFrame, distance_table: DataFrame) -> DataFrame:
    return fill_from(legs, _known(distance_table, "known"), ZIPS, "dist", "known")


def fill_reversed(legs: DataFrame, distance_table: DataFrame) -> DataFrame:
    swapped = _known(distance_table, "known").select(
        F.col("d_zip").alias("o_zip"), F.col("o_zip").alias("d_zip"), "known"
    )
    return fill_from(legs, swapped, ZIPS, "dist", "known")


def fill_from_table(legs: DataFrame, distance_table: DataFrame) -> DataFrame:
    """Forward then reversed, by one join: each table row is listed under both directions and averaged once."""
    ahead = distance_table.select(*ZIPS, F.col("dist").alias("ahead"), F.lit(None).cast("double").alias("back"))
    back = distance_table.select(
        F.col("d_zip").alias("o_zip"),
        F.col("o_zip").alias("d_zip"),
        F.lit(None).cast("double").alias("ahead"),
        F.col("dist").alias("back"),
    )
    both = ahead.unionByName(back).groupBy(*ZIPS).agg(F.avg("ahead").alias("ahead"), F.avg("back").alias("back"))
    return fill_from(legs, both, ZIPS, "dist", "ahead", "back")


def fill_geodesic(legs: DataFrame, postal_codes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Detour-adjusted great-circle miles between zips; the distance becomes the last column."""
    spots = postal_codes.groupBy("postal_code").agg(F.max("longitude").alias("lon"), F.max("latitude").alias("lat"))

    def at(role: str) -> DataFrame:
        return spots.select(
            F.col("postal_code").alias(f"{role}_zip"),
            F.col("lon").alias(f"_{role}_lon"),
            F.col("lat").alias(f"_{role}_lat"),
        )

    located = legs.join(at("o"), "o_zip", "left").join(at("d"), "d_zip", "left")
    miles = road_miles(F.col("_o_lon"), F.col("_o_lat"), F.col("_d_lon"), F.col("_d_lat"), p)
    rest = [c for c in legs.columns if c != "dist"]
    return located.select(*rest, F.coalesce("dist", miles).alias("dist"))


def zip_distances(pairs: DataFrame, distance_table: DataFrame, postal_codes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``o_zip, d_zip, dist`` of distinct zip pairs, by the table in both directions, then by coordinates."""
    unknown = pairs.select(*ZIPS, F.lit(None).cast("double").alias("dist"))
    return fill_geodesic(fill_from_table(unknown, distance_table), postal_codes, p)


def fill_by_zips(legs: DataFrame, known: DataFrame) -> DataFrame:
    """Distances of legs that have none, from a table of one row per zip pair; the distance becomes the last column."""
    rest = [c for c in legs.columns if c != "dist"]
    return legs.drop("dist").join(known.select(*ZIPS, "dist"), ZIPS, "left").select(*rest, "dist")


def fill_manual(legs: DataFrame, manual_distances: DataFrame) -> DataFrame:
    keys = ["o_id", "d_id", *ZIPS]
    kept = manual_distances.groupBy(*keys).agg(F.avg("dist").alias("kept"))
    return fill_from(legs, kept, keys, "dist", "kept")


def missing_distances(legs: DataFrame) -> DataFrame:
    """Report of legs whose distance is unknown or negative."""
    return legs.filter(F.col("dist").isNull() | (F.col("dist") < 0)).distinct()
