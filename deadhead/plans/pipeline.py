"""The stages in order. Each stage ends in written tables, so the invoices are read once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deadhead.config import DEFAULT, TUNING, Params, Tuning
from deadhead.operators import auction, costing, demand, distance, lanes, legs, matching, quality, report, tours
from deadhead.sources.tables import Snapshot, Sources
from deadhead.storage import materialize


@dataclass
class Pipeline:
    """All tables of one run, each built on first use."""

    src: Sources
    p: Params = DEFAULT
    tuning: Tuning = TUNING

    # legs

    @cached_property
    def empty_demand(self) -> DataFrame:
        return materialize(demand.empty_demand(self.src, self.p), "empty-demand")

    @cached_property
    def partner_lanes(self) -> DataFrame:
        return materialize(legs.valid_partner_lanes(self.src.partner_lanes, self.p), "partner-lanes")

    @cached_property
    def input_legs(self) -> DataFrame:
        return legs.input_legs(self.empty_demand, self.partner_lanes, self.p)

    @cached_property
    def labelled_legs(self) -> DataFrame:
        return legs.label_legs(self.input_legs)

    @cached_property
    def zip_distances(self) -> DataFrame:
        """Distances of all zip pairs of own and partner facilities: each computed once, however many owners share it."""
        pairs = legs.product_zips(self.empty_demand, self.partner_lanes, self.p)
        return materialize(distance.zip_distances(pairs, self.src.distance_table, self.src.postal_codes, self.p), "zip-distances")

    @cached_property
    def located_legs(self) -> DataFrame:
        """Legs after the distance table and the coordinates."""
        known = legs.label_legs(legs.known_legs(self.empty_demand, self.partner_lanes, self.p))
        known = distance.fill_geodesic(distance.fill_from_table(known, self.src.distance_table), self.src.postal_codes, self.p)
        made = legs.label_legs(legs.product_legs(self.empty_demand, self.partner_lanes, self.p))
        return known.unionByName(distance.fill_by_zips(made, self.zip_distances))

    @cached_property
    def corrected_legs(self) -> DataFrame:
        """Legs with all corrections and, beside them, what was known before; the one copy of the legs that is written."""
        before = self.located_legs.withColumns({"dist_located": F.col("dist"), "cost_listed": F.col("ow_cost_per_load")})
        rated = quality.overwrite_rates(distance.fill_manual(before, self.src.manual_distances), self.src.partner_rates)
        rated, self.gate = quality.observed(rated)
        return materialize(rated, "rated-legs")

    @cached_property
    def missing_distances(self) -> DataFrame:
        before = {"dist": F.col("dist_located"), "ow_cost_per_load": F.col("cost_listed")}
        return distance.missing_distances(self.corrected_legs.withColumns(before).drop("dist_located", "cost_listed"))

    @cached_property
    def measured_legs(self) -> DataFrame:
        return distance.fill_manual(self.located_legs, self.src.manual_distances)

    @cached_property
    def rated_legs(self) -> DataFrame:
        return self.corrected_legs.drop("dist_located", "cost_listed")

    @cached_property
    def legs(self) -> DataFrame:
        """Legs that passed the gate, without the bad ones."""
        rated = self.rated_legs
        quality.require_observed(self.gate)
        return quality.purge_legs(rated)

    @cached_property
    def edges(self) -> DataFrame:
        return materialize(lanes.edges(self.legs), "edges")

    @cached_property
    def lane_numbers(self) -> DataFrame:
        return materialize(lanes.lane_numbers(self.edges), "lane-numbers")

    @cached_property
    def lane_demand(self) -> DataFrame:
        return materialize(lanes.lane_demand(self.legs, self.lane_numbers), "lane-demand")

    # tours

    @cached_property
    def campuses(self) -> DataFrame:
        return tours.campuses(self.src.campus_map)

    @cached_property
    def priced_tours(self) -> DataFrame:
        return costing.priced_tours(
            self.edges, self.campuses, self.lane_numbers, self.src.dedicated_costs, self.p, self.tuning
        )

    @cached_property
    def final_tours(self) -> DataFrame:
        return materialize(costing.final_tours(self.priced_tours), "final-tours")

    # matching

    @cached_property
    def routes(self) -> DataFrame:
        return matching.model_routes(self.final_tours)

    @cached_property
    def lane_model(self) -> DataFrame:
        return materialize(matching.lane_model(self.lane_demand), "lane-model")

    @cached_property
    def runs(self) -> DataFrame:
        return materialize(matching.assign_loads(self.routes, self.lane_model), "runs")

    @cached_property
    def priced(self) -> auction.Outcome:
        """Loads by price rounds, with the prices that bound their distance to the best plan."""
        found = auction.assign_by_prices(self.routes, self.lane_model, self.p)
        return auction.Outcome(materialize(found.runs, "runs"), found.prices, found.step)

    def plan(self, stamp: datetime) -> DataFrame:
        return matching.dedicated_plan(self.routes, self.runs, stamp, self.p)

    # reports

    def savings(self, plan: DataFrame) -> DataFrame:
        wide = report.route_lanes(plan, self.final_tours, self.lane_demand)
        credited = report.baseline_and_credit(wide)
        return report.route_text(report.route_savings(credited, self.src.campus_map))


def run(src: Sources, out: str, stamp: datetime, p: Params = DEFAULT, tuning: Tuning = TUNING, by_prices: bool = False) -> dict[str, DataFrame]:
    """Run everything and publish the result tables under ``out``; readers see all tables of a run or those before it.

    Loads are assigned by greedy rounds or, with ``by_prices``, by price rounds, which take longer where lanes are scarce.
    """
    job = Pipeline(src, p, tuning)
    snapshot = Snapshot(src.invoices.sparkSession, out)
    save = snapshot.write

    save("str_dc_empty_demand", job.empty_demand)
    save("missing_distances", job.missing_distances)
    save("input_legs", job.legs)
    save("rf_locations", job.edges)
    save("rf_pair_number_lanes", job.lane_numbers)
    save("demand_data", job.lane_demand)
    save("rf_routes_final", job.final_tours)
    save("uncovered_lanes", matching.uncovered(job.routes, job.lane_model))
    save("lane_issues", matching.lane_issues(job.routes, job.lane_demand))
    runs, prices = (job.priced.runs, job.priced.prices) if by_prices else (job.runs, None)
    save("run_audit", matching.run_audit(job.routes, job.lane_model, runs))
    save("matching_gap", matching.optimality_gap(job.routes, job.lane_model, runs, p, prices))
    plan = save("matching_ded", matching.dedicated_plan(job.routes, runs, stamp, p))
    save("matching_ow", matching.one_way_loads(job.routes, job.lane_model, runs, p))
    save("cost_summary", matching.cost_summary(job.routes, job.lane_model, runs, p))
    save("run_counts", matching.run_counts(job.routes, job.lane_model, runs))
    wide = save("routes_lanes", report.route_lanes(plan, job.final_tours, job.lane_demand))
    credited = report.baseline_and_credit(wide)
    savings = save("routes_savings", report.route_text(report.route_savings(credited, src.campus_map)))
    lookup = save("pair_to_route_lookup", report.lane_to_route(savings))
    rollup = save("route_to_pair_lookup_base", report.lane_rollup(lookup))
    save("lanes_on_routes", report.lanes_on_routes(job.lane_demand, rollup))
    snapshot.publish()
    return snapshot.tables
