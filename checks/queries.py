"""The registered queries: every operator over the tables of one scale factor, whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.config import Params
from deadhead.operators import costing, demand, distance, legs, matching, quality, report, tours
from deadhead.plans.pipeline import Pipeline
from deadhead.sources.testdata import sources_from_testdata

SINCE = date(1998, 1, 1)
STAMP = datetime(2024, 5, 1, 10, 0)
PARAMS = Params(min_loads=10, since=SINCE)

Build = Callable[[Pipeline], DataFrame]
_BUILDS: dict[str, Build] = {}


def _query(name: str) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        _BUILDS[name] = build
        return build

    return register


# legs

_query("empty_demand")(lambda j: demand.empty_demand(j.src, j.p))
_query("partner_legs_store")(lambda j: legs.store_partner_legs(j.empty_demand, j.partner_lanes, j.p))
_query("partner_legs_dc")(lambda j: legs.dc_partner_legs(j.empty_demand, j.partner_lanes, j.p))
_query("partner_legs_return")(lambda j: legs.partner_dc_legs(j.empty_demand, j.partner_lanes, j.p))
_query("input_legs")(lambda j: j.input_legs)
_query("leg_labels")(lambda j: j.labelled_legs)
_query("distance_lookup")(lambda j: distance.fill_forward(j.labelled_legs, j.src.distance_table))


@_query("distance_reverse")
def _reverse(j: Pipeline) -> DataFrame:
    table = j.src.distance_table
    return distance.fill_reversed(distance.fill_forward(j.labelled_legs, table), table)


_query("distance_geo")(lambda j: j.located_legs)
_query("missing_distance")(lambda j: j.missing_distances)
_query("distance_manual")(lambda j: j.measured_legs)
_query("quality_gate")(lambda j: quality.missing_count(j.measured_legs))
_query("rate_overwrite")(lambda j: j.rated_legs)
_query("purge_legs")(lambda j: j.legs)
_query("edges")(lambda j: j.edges)
_query("lane_numbers")(lambda j: j.lane_numbers)
_query("lane_demand")(lambda j: j.lane_demand)

# tours

_query("campuses")(lambda j: j.campuses)
_query("chains2")(lambda j: tours.two_leg_chains(j.edges, j.p, j.tuning))
_query("chains3")(
    lambda j: tours.three_leg_chains(tours.two_leg_chains(j.edges, j.p, j.tuning), j.edges, j.p, j.tuning)
)


def _all_tours(j: Pipeline) -> DataFrame:
    return tours.build_tours(j.edges, j.campuses, j.p, j.tuning)


def _builder(j: Pipeline) -> tours.TourBuilder:
    return tours.TourBuilder(j.edges, j.campuses, j.p, j.tuning)


_query("tours2")(lambda j: _builder(j).two())
_query("tours3")(lambda j: _builder(j).three())
_query("tours4")(lambda j: _builder(j).four())
_query("tours_all")(_all_tours)
_query("tours_dc_homed")(lambda j: tours.dc_homed(_all_tours(j)))


@_query("tour_cost")
def _tour_cost(j: Pipeline) -> DataFrame:
    return costing.tour_cost(tours.dc_homed(_all_tours(j)), j.src.dedicated_costs, j.p)


_query("tour_lanes")(lambda j: costing.tour_lanes(_tour_cost(j), j.lane_numbers))
_query("tours_final")(lambda j: j.final_tours)

# matching

_query("model_lanes")(lambda j: matching.model_lanes(j.lane_demand))
_query("model_routes")(lambda j: j.routes)
_query("must_cover")(lambda j: matching.must_cover(j.lane_demand))
_query("partner_lanes")(lambda j: matching.partner_lanes(j.lane_demand))
_query("lane_model")(lambda j: j.lane_model)
_query("incidence")(lambda j: matching.incidence(j.routes))
_query("net_cost")(lambda j: matching.net_cost(j.routes, j.lane_model))
_query("uncovered")(lambda j: matching.uncovered(j.routes, j.lane_model))
_query("lane_issues")(lambda j: matching.lane_issues(j.routes, j.lane_demand))
_query("assignment")(lambda j: j.runs)
_query("assignment_audit")(lambda j: matching.lane_audit(j.routes, j.lane_model, j.runs))
_query("audit_totals")(lambda j: matching.run_audit(j.routes, j.lane_model, j.runs))
_query("matching_gap")(lambda j: matching.optimality_gap(j.routes, j.lane_model, j.runs, j.p))
# by price rounds, which SQL cannot follow: tested against brute force
WITHOUT_SQL = {"priced_assignment", "priced_audit", "priced_gap"}
_query("priced_assignment")(lambda j: j.priced.runs)
_query("priced_audit")(lambda j: matching.run_audit(j.routes, j.lane_model, j.priced.runs))
_query("priced_gap")(lambda j: matching.optimality_gap(j.routes, j.lane_model, j.priced.runs, j.p, j.priced.prices))
_query("oneway_remainder")(lambda j: matching.one_way_loads(j.routes, j.lane_model, j.runs, j.p))
_query("cost_summary")(lambda j: matching.cost_summary(j.routes, j.lane_model, j.runs, j.p))
_query("run_counts")(lambda j: matching.run_counts(j.routes, j.lane_model, j.runs))
_query("chosen_tours")(lambda j: j.plan(STAMP))

# reports, of the plan and of every tour with the most loads it could carry alone


def _whatif(j: Pipeline) -> DataFrame:
    alone = (
        matching.incidence(j.routes).join(j.lane_model, "lane").groupBy("route_nbr").agg(F.min("demand").alias("loads"))
    )
    return matching.dedicated_plan(j.routes, alone, STAMP, j.p)


def _reports(suffix: str, plan: Build) -> None:
    def wide(j: Pipeline) -> DataFrame:
        return report.route_lanes(plan(j), j.final_tours, j.lane_demand)

    def savings(j: Pipeline) -> DataFrame:
        return report.route_savings(report.baseline_and_credit(wide(j)), j.src.campus_map)

    def lookup(j: Pipeline) -> DataFrame:
        return report.lane_to_route(report.route_text(savings(j)))

    _query(f"routes_lanes{suffix}")(wide)
    _query(f"tour_baseline{suffix}")(lambda j: report.baseline_and_credit(wide(j)))
    _query(f"tour_savings{suffix}")(savings)
    _query(f"tour_text{suffix}")(lambda j: report.route_text(savings(j)))
    _query(f"lane_tour_unpivot{suffix}")(lookup)
    _query(f"lane_rollup{suffix}")(lambda j: report.lane_rollup(lookup(j)))
    _query(f"lane_report{suffix}")(lambda j: report.lanes_on_routes(j.lane_demand, report.lane_rollup(lookup(j))))


_reports("", lambda j: j.plan(STAMP))
_reports("_whatif", _whatif)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six digits, as sums may differ in the last bits."""
    return df.select(
        *[
            F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def pipeline(spark: SparkSession, sf_dir: str, p: Params = PARAMS) -> Pipeline:
    return Pipeline(sources_from_testdata(spark, sf_dir), p)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def callable_for(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: rounded(build(pipeline(spark, sf_dir)))

    return {name: callable_for(build) for name, build in _BUILDS.items()}
