"""Savings per chosen tour and per lane."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deadhead import labels
from deadhead.functions.tables import look_up_slots

SLOTS = "abcd"
LANE_METRICS = [
    "route_nbr",
    "ded_loads",
    "savings_per_load",
    "effective_rt_cost",
    "loaded_pct",
    "savings_pct",
    "oor_dist",
]


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, columns)


def route_lanes(plan: DataFrame, tours: DataFrame, demand: DataFrame) -> DataFrame:
    """Chosen tours with their legs, loaded share, and the places and one-way cost of each lane."""
    loaded = [F.coalesce(F.col(f"{s}_loaded_ind") * F.col(f"{s}_dist"), F.lit(0.0)) for s in SLOTS]
    details = tours.withColumn("loaded_pct", F.try_divide(_sum(loaded), F.col("total_dist"))).drop("mode", "home_dc")
    slots = [[f"pair_nbr{i}"] for i in range(1, len(SLOTS) + 1)]
    names = [
        {"o_city": f"{s}_ocity", "d_city": f"{s}_dcity", "o_state": f"{s}_ostate", "d_state": f"{s}_dstate", "ow_cost_per_load": f"leg{i}_ow_cost"}
        for i, s in enumerate(SLOTS, start=1)
    ]
    return look_up_slots(plan.join(details, "route_nbr", "left"), slots, demand, ["pair_number"], names)


def baseline_and_credit(lanes_of_routes: DataFrame) -> DataFrame:
    """Cost of the plain out-and-back on the first leg, and the one-way cost of the partner lanes covered."""
    there_and_back = 2 * F.try_divide(F.col("a_dist") * F.col("cost"), F.col("total_dist"))
    credits = [
        F.when(F.col(f"{s}_leg") == labels.PARTNER_LANE, F.col(f"leg{i}_ow_cost")).otherwise(0.0)
        for i, s in enumerate(SLOTS, start=1)
    ]
    return lanes_of_routes.withColumns(
        {
            "baseline_cost": F.when(F.col("a_loaded_ind") == 1, there_and_back).otherwise(0.0),
            "partner_credit": _sum(credits),
        }
    )


def route_savings(credited: DataFrame, campus_map: DataFrame) -> DataFrame:
    """Savings per load and week; a campus with several carriers lists the tour once for each."""
    campus = campus_map.select("campus_name", "campus_nbr_nm", "scac")
    effective = F.col("rf_cost") - F.col("partner_credit")
    saving = F.col("baseline_cost") - effective
    legs = [
        c
        for i, s in enumerate(SLOTS, start=1)
        for c in (
            *(f"{s}_{x}" for x in ("origin", "dest", "leg", "leg_dtl", "dist")),
            f"leg{i}_ow_cost",
            *(f"{s}_{x}" for x in ("ozip", "dzip", "ocity", "dcity", "ostate", "dstate", "loaded_ind")),
        )
    ]
    return credited.join(campus, F.col("home_dc") == F.col("campus_name"), "left").select(
        "home_dc",
        "campus_nbr_nm",
        "scac",
        "route_nbr",
        F.col("loads").alias("ded_loads"),
        "mode",
        "total_dist",
        *legs,
        *[f"pair_nbr{i}" for i in range(1, 5)],
        "loaded_pct",
        "baseline_cost",
        "partner_credit",
        "rf_cost",
        saving.alias("savings_per_load"),
        (saving * F.col("loads")).alias("total_savings_per_week"),
        effective.alias("effective_rt_cost"),
        (F.col("total_dist") - 2 * F.col("a_dist")).alias("oor_dist"),
    )


def route_text(savings: DataFrame) -> DataFrame:
    """Tour as text, ``->`` for a loaded and ``-`` for an empty leg, and the share saved."""

    def step(slot: str) -> list[Column]:
        loaded = F.col(f"{slot}_loaded_ind")
        arrow = F.when(loaded == 1, "->").when(loaded == 0, "-").otherwise("")
        return [arrow, F.coalesce(f"{slot}_dest", F.lit(""))]

    parts = [F.coalesce("a_origin", F.lit("")), *[c for s in SLOTS for c in step(s)]]
    return savings.withColumns(
        {
            "route_dtl": F.concat(*parts),
            "savings_pct": F.try_divide(F.col("savings_per_load"), F.col("baseline_cost")),
        }
    )


def lane_to_route(savings: DataFrame) -> DataFrame:
    """One row per loaded leg with a lane number, from a single scan of the tours."""
    legs = F.array(
        *[
            F.struct(F.col(f"pair_nbr{i}").alias("lane"), F.col(f"{s}_loaded_ind").alias("loaded"))
            for i, s in enumerate(SLOTS, start=1)
        ]
    )
    return (
        savings.select(F.explode(legs).alias("on"), *LANE_METRICS)
        .filter((F.col("on.loaded") == 1) & F.col("on.lane").isNotNull())
        .select(F.col("on.lane").alias("pair_nbr1"), *LANE_METRICS)
    )


def lane_rollup(lookup: DataFrame) -> DataFrame:
    """Per lane: its tours, loads, and plain or load-weighted averages.

    Route numbers are listed in ascending order. The list is a text for the report, as long as the lane has tours:
    its weekly loads at most for a plan, all tours of the lane (times the carriers of its campus) otherwise.
    ``lane_to_route`` is the same as a table. The numbers are summed apart from the list, combined before they move.
    """
    loads = F.sum("ded_loads")

    def weighted(column: str) -> Column:
        return F.try_divide(F.sum(F.col(column) * F.col("ded_loads")), loads)

    numbers = F.transform(F.sort_array(F.collect_list("route_nbr")), lambda n: n.cast("string"))
    listed = lookup.groupBy("pair_nbr1").agg(F.array_join(numbers, ", ").alias("route_nbrs"))
    measured = lookup.groupBy("pair_nbr1").agg(
        loads.alias("model_ded_loads"),
        weighted("oor_dist").alias("avg_oor_miles"),
        F.avg("effective_rt_cost").alias("avg_effective_rt_cost"),
        F.avg("savings_per_load").alias("avg_savings_per_load"),
        F.avg("loaded_pct").alias("avg_loaded_pct"),
        weighted("savings_pct").alias("avg_savings_pct"),
    )
    return listed.join(measured, "pair_nbr1")


def lanes_on_routes(demand: DataFrame, rollup: DataFrame) -> DataFrame:
    """All loaded lanes with the loads on tours and the remainder."""
    on_tours = F.coalesce("model_ded_loads", F.lit(0))
    return demand.join(rollup, F.col("pair_number") == F.col("pair_nbr1"), "left").select(
        "side",
        "pair_number",
        *[f"{e}_{c}" for e in "od" for c in ("id", "type", "zip", "city", "state")],
        "leg",
        "dist",
        F.col("loads").alias("model_loads"),
        on_tours.alias("model_ded_loads"),
        (F.col("loads") - on_tours).alias("model_ow_loads"),
        "ow_cost_per_load",
        "route_nbrs",
        "avg_effective_rt_cost",
        "avg_savings_per_load",
        "avg_loaded_pct",
        "avg_savings_pct",
    )
