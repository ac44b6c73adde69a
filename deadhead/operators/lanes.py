"""Edge table, lane numbers and loaded-lane demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deadhead import labels
from deadhead.functions.tables import dense_id
from deadhead.schemas import DEMAND, EDGES, conform

LANE = ["o_id", "d_id", "o_zip", "d_zip"]


def edges(legs: DataFrame) -> DataFrame:
    """Distinct drivable legs, without the owner and demand columns."""
    return conform(legs, EDGES).distinct()


def lane_numbers(edge_table: DataFrame) -> DataFrame:
    """Numbers 1..n of the distinct lanes in the order of ids, then zips."""
    return dense_id(edge_table.select(*LANE).distinct(), LANE, "pair_number")


def lane_demand(legs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Weekly loads, one-way cost and distance per loaded lane, averaged over carriers."""
    loaded = legs.filter(F.col("loaded_ind") == 1)
    keys = [
        "side",
        "o_id",
        "o_type",
        "o_zip",
        F.upper("o_city").alias("o_city"),
        "o_state",
        "d_id",
        "d_type",
        "d_zip",
        F.upper("d_city").alias("d_city"),
        "d_state",
        "leg",
    ]
    # grouped before the numbers are joined: the number depends on grouping keys only, one row per lane
    lanes = loaded.groupBy(*keys).agg(
        F.avg("ow_cost_per_load").alias("ow_cost_per_load"),
        F.avg("dist").alias("dist"),
        F.floor(F.avg("loads")).alias("loads"),
    )
    mode = F.when(F.col("leg").startswith(labels.PARTNER_MARK), labels.ONE_WAY).otherwise(labels.DEDICATED)
    return conform(lanes.join(numbers, LANE, "left").withColumn("majority_mode", mode), DEMAND)
