"""Partner legs and the union of all legs a truck can drive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deadhead import labels
from deadhead.config import DEFAULT, Params
from deadhead.functions.tables import all_pairs
from deadhead.schemas import EMPTY_DEMAND, INPUT_LEGS, conform

OWNER = ["region", "campus_nbr_nm", "dc_nbr", "scac"]
PLACE = ["id", "type", "zip", "city", "state"]
ORIGIN = [f"o_{c}" for c in PLACE]
DEST = [f"d_{c}" for c in PLACE]


def valid_partner_lanes(partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Partner lanes of enough volume between two known facilities with all-digit-style (letter-free) zips."""

    def letter_free(zip_code: str) -> Column:
        return ~F.col(zip_code).rlike("[A-Za-z]")

    return partner_lanes.filter(
        (F.col("truckload_volume") >= p.min_partner_volume)
        & F.col("origin_id").isNotNull()
        & F.col("dest_id").isNotNull()
        & letter_free("origin_zip")
        & letter_free("destination_zip")
    )


def _partner_id(column: str) -> Column:
    return F.concat(F.lit(labels.PARTNER_ID_PREFIX), F.col(column))


def _partner_places(partner_lanes: DataFrame, end: str, p: Params) -> DataFrame:
    """Distinct partner facilities at one end of the valid lanes, as ``d_*`` (origins) or ``o_*`` (destinations)."""
    key, prefix, kind, role = {
        "origin": ("origin_id", "origin", labels.PARTNER_ORIGIN_TYPE, "d"),
        "dest": ("dest_id", "destination", labels.PARTNER_DEST_TYPE, "o"),
    }[end]
    return (
        valid_partner_lanes(partner_lanes, p)
        .select(
            _partner_id(key).alias(f"{role}_id"),
            F.lit(kind).alias(f"{role}_type"),
            F.col(f"{prefix}_zip").alias(f"{role}_zip"),
            F.col(f"{prefix}_city").alias(f"{role}_city"),
            F.col(f"{prefix}_state").alias(f"{role}_state"),
        )
        .distinct()
    )


def _every_pair(own: DataFrame, partner: DataFrame, leg: str, p: Params) -> DataFrame:
    """Each own facility with each partner facility: the product of two facility lists is the result itself.

    Both sides are distinct before they meet, so the product has no duplicates and no row of invoices or of
    lanes takes part in it.
    """
    pairs = all_pairs(own, partner)
    for name in ("region", "campus_nbr_nm", "dc_nbr", "dist"):
        if name not in pairs.columns:
            pairs = pairs.withColumn(name, F.lit(None))
    pairs = pairs.withColumns(
        {"leg": F.lit(leg), "loads": F.lit(0), "ow_cost_per_load": F.lit(p.default_oneway_cost)}
    )
    return conform(pairs, EMPTY_DEMAND)


def store_partner_legs(demand: DataFrame, partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Empty legs from each store with empty returns to each partner origin."""
    stores = demand.select("scac", *ORIGIN).distinct()
    return _every_pair(stores, _partner_places(partner_lanes, "origin", p), labels.STORE_TO_PARTNER, p)


def _demand_dcs(demand: DataFrame, role: str) -> DataFrame:
    return demand.select(*OWNER, *[F.col(f"d_{c}").alias(f"{role}_{c}") for c in PLACE]).distinct()


def dc_partner_legs(demand: DataFrame, partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Empty legs from each DC to each partner origin."""
    return _every_pair(
        _demand_dcs(demand, "o"), _partner_places(partner_lanes, "origin", p), labels.DC_TO_PARTNER, p
    )


def partner_dc_legs(demand: DataFrame, partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Empty legs from each partner destination to each DC."""
    return _every_pair(_demand_dcs(demand, "d"), _partner_places(partner_lanes, "dest", p), labels.PARTNER_TO_DC, p)


def loaded_partner_legs(partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Partner lanes as loaded legs; weekly loads are rounded up from the largest yearly volume."""
    keys = [
        _partner_id("origin_id").alias("o_id"),
        F.col("origin_zip").alias("o_zip"),
        F.col("origin_city").alias("o_city"),
        F.col("origin_state").alias("o_state"),
        _partner_id("dest_id").alias("d_id"),
        F.col("destination_zip").alias("d_zip"),
        F.col("destination_city").alias("d_city"),
        F.col("destination_state").alias("d_state"),
    ]
    legs = (
        valid_partner_lanes(partner_lanes, p)
        .groupBy(*keys)
        .agg(
            F.avg("distance").alias("dist"),
            F.ceil(F.max("truckload_volume") / p.weeks_partner).alias("loads"),
            F.avg("low_allin_cost").alias("ow_cost_per_load"),
        )
        .withColumns(
            {
                "region": F.lit(None),
                "campus_nbr_nm": F.lit(None),
                "dc_nbr": F.lit(None),
                "scac": F.lit(labels.PARTNER_CARRIER),
                "o_type": F.lit(labels.PARTNER_ORIGIN_TYPE),
                "d_type": F.lit(labels.PARTNER_DEST_TYPE),
                "leg": F.lit(labels.PARTNER_LANE),
                "loaded_ind": F.lit(1),
            }
        )
    )
    return conform(legs, INPUT_LEGS)


def outbound_legs(demand: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The loaded direction of each demand lane: DC -> store, weekly loads rounded up."""
    swapped = [F.col(d).alias(o) for o, d in zip(ORIGIN, DEST)] + [F.col(o).alias(d) for o, d in zip(ORIGIN, DEST)]
    legs = demand.select(
        *OWNER,
        *swapped,
        F.lit(labels.DC_TO_STORE).alias("leg"),
        "dist",
        F.ceil(F.col("loads") / p.weeks_network).alias("loads"),
        "ow_cost_per_load",
        F.lit(1).alias("loaded_ind"),
    )
    return conform(legs, INPUT_LEGS)


def known_legs(demand: DataFrame, partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Legs that come from invoices or partner lanes, most with a distance: both directions of the demand, partner lanes."""
    empty = conform(demand.withColumns({"loads": F.lit(0), "loaded_ind": F.lit(0)}), INPUT_LEGS)
    return empty.unionByName(outbound_legs(demand, p)).unionByName(loaded_partner_legs(partner_lanes, p))


def product_legs(demand: DataFrame, partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Legs between every own and every partner facility, none with a distance."""
    made = [f(demand, partner_lanes, p) for f in (store_partner_legs, dc_partner_legs, partner_dc_legs)]
    return reduce(DataFrame.unionByName, [conform(df.withColumn("loaded_ind", F.lit(0)), INPUT_LEGS) for df in made])


def product_zips(demand: DataFrame, partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The distinct zip pairs of ``product_legs``: a product of zips, which owners and facilities do not multiply."""

    def zips(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()

    lanes = valid_partner_lanes(partner_lanes, p)
    own = demand.select(F.explode(F.array("o_zip", "d_zip")).alias("zip"))
    there = all_pairs(zips(own, "zip", "o_zip"), zips(lanes, "origin_zip", "d_zip"))
    back = all_pairs(zips(lanes, "destination_zip", "o_zip"), zips(demand, "d_zip", "d_zip"))
    return there.unionByName(back.select(*there.columns)).distinct()


def input_legs(demand: DataFrame, partner_lanes: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """All six kinds of legs, each free of duplicates.

    No branch needs a ``distinct`` of its own: a demand row is identified by columns that all survive, a
    product of distinct lists is distinct, and partner lanes are grouped. Nothing is deduplicated across
    branches, and no shuffle is added by the union.
    """
    return known_legs(demand, partner_lanes, p).unionByName(product_legs(demand, partner_lanes, p))


def label_legs(legs: DataFrame) -> DataFrame:
    """Facility-type pair, and the side by the leg label (empty returns from a partner count as partner)."""
    partner = F.col("leg").startswith(labels.PARTNER_MARK)
    return legs.withColumns(
        {
            "leg_dtl": F.concat("o_type", F.lit("-"), "d_type"),
            "side": F.when(partner, labels.SIDE_PARTNER).otherwise(labels.SIDE_NETWORK),
        }
    )
