"""Tour cost, lane numbers of tours, and the final tour table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deadhead.config import DEFAULT, TUNING, Params, Tuning
from deadhead.functions.cost import leg_cost
from deadhead.functions.tables import dense_id, look_up_slots
from deadhead.operators.tours import SLOTS, build_tours
from deadhead.storage import materialize

RATES = ["variable_cpm", "stop_charge", "fixed_cost_per_hour"]

# the order of tour numbers: place by place, then whatever else tells two tours apart
TOUR_ORDER = [
    "a_origin",
    *[f"{s}_{c}" for c in ("dest", "leg", "ozip", "dzip", "leg_dtl", "dist") for s in SLOTS],
    *[f"pair_nbr{i}" for i in range(1, 5)],
]
FINAL_COLUMNS = [
    *[f"{s}_{c}" for c in ("origin", "dest", "leg", "leg_dtl", "dist", "ozip", "dzip", "loaded_ind") for s in SLOTS],
    *[f"pair_nbr{i}" for i in range(1, 5)],
    "dc_count",
    "total_dist",
    "rf_cost",
    "mode",
    "home_dc",
    "route_nbr",
]


def home_rates(dedicated_costs: DataFrame) -> DataFrame:
    """Average rates per DC."""
    return dedicated_costs.groupBy("dc_nbr").agg(*[F.avg(c).alias(c) for c in RATES])


def _with_cost(tours: DataFrame, p: Params) -> DataFrame:
    legs = [leg_cost(F.col(f"{s}_dist"), *[F.col(c) for c in RATES], p) for s in SLOTS]
    return tours.withColumn("rf_cost", reduce(lambda x, y: x + y, legs)).drop(*RATES)


def tour_cost(tours: DataFrame, dedicated_costs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Add ``rf_cost`` by the home's rates; a home without rates costs 0."""
    rates = home_rates(dedicated_costs)
    return _with_cost(tours.join(rates, tours.a_origin == rates.dc_nbr, "left").drop("dc_nbr"), p)


def tour_lanes(tours: DataFrame, lanes: DataFrame) -> DataFrame:
    """Add lane numbers by origin and destination; facilities with several zip pairs multiply the tour."""
    slots = [[f"{s}_origin", f"{s}_dest"] for s in SLOTS]
    names = [{"pair_number": f"pair_nbr{i}"} for i in range(1, len(SLOTS) + 1)]
    return look_up_slots(tours, slots, lanes, ["o_id", "d_id"], names)


def priced_tours(
    edges: DataFrame,
    campus_set: DataFrame,
    lanes: DataFrame,
    dedicated_costs: DataFrame,
    p: Params = DEFAULT,
    tuning: Tuning = TUNING,
) -> DataFrame:
    """DC-homed tours with cost and lane numbers; rates and numbers travel with the legs."""
    tours = build_tours(
        edges, campus_set, p, tuning, only_dc_homed=True, lanes=lanes, rates=home_rates(dedicated_costs)
    )
    named = {f"{s}_pair_number": f"pair_nbr{i}" for i, s in enumerate(SLOTS, start=1)}
    return _with_cost(tours.withColumnsRenamed(named), p)


def final_tours(priced: DataFrame) -> DataFrame:
    """Number the tours, in a fixed order, and lay out the final columns."""
    numbered = dense_id(materialize(priced, "priced-tours"), TOUR_ORDER, "route_nbr")
    return numbered.withColumn("home_dc", F.col("a_origin")).select(*FINAL_COLUMNS)
