from types import SimpleNamespace

import pytest

from deadhead.operators import costing, report
from deadhead.schemas import DEMAND, SOURCES, struct

PLAN = struct("route_nbr:l loads:l description:s home_dc:s cost:d dist:d mode:s run_date:s run_time:s")
KINDS = {"origin": "s", "dest": "s", "leg": "s", "leg_dtl": "s", "dist": "d", "ozip": "s", "dzip": "s", "loaded_ind": "l"}
TOURS = struct(
    " ".join(f"{s}_{c}:{k}" for c, k in KINDS.items() for s in "abcd")
    + " pair_nbr1:l pair_nbr2:l pair_nbr3:l pair_nbr4:l dc_count:l total_dist:d rf_cost:d mode:s home_dc:s route_nbr:l"
)


def tour(nbr, legs, cost):
    """legs: (origin, dest, leg, miles, loaded, lane)."""
    row = {"route_nbr": nbr, "dc_count": 1, "mode": "D", "home_dc": legs[0][0], "rf_cost": float(cost)}
    row["total_dist"] = float(sum(leg[3] for leg in legs))
    for i, (s, leg) in enumerate(zip("abcd", legs), start=1):
        row |= {f"{s}_origin": leg[0], f"{s}_dest": leg[1], f"{s}_leg": leg[2], f"{s}_dist": float(leg[3]), f"{s}_loaded_ind": leg[4], f"pair_nbr{i}": leg[5]}
    return tuple(row.get(f.name) for f in TOURS)


def demand(lane, leg, cost, loads=5.0):
    return ("THD", "O", "FDC", "z", "CITY", "TX", "D", "STR", "z", "TOWN", "GA", lane, cost, leg, 1.0, loads, "DED")


OUT_BACK = [("DC", "STR", "OS", 100, 1, 1), ("STR", "DC", "SO", 100, 0, 2)]
THREE = [("DC", "SRS_1", "OSRS1", 50, 0, 3), ("SRS_1", "SRS_2", "SRS1-SRS2", 200, 1, 4), ("SRS_2", "DC", "SRS2O", 50, 0, 5)]
FOUR = [("DC", "STR", "OS", 100, 1, 1), ("STR", "SRS_1", "SSRS1", 50, 0, 6), ("SRS_1", "SRS_2", "SRS1-SRS2", 200, 1, 4), ("SRS_2", "DC", "SRS2O", 50, 0, 5)]


@pytest.fixture(scope="module")
def made(spark):
    def build(tours, loads, demands, campus=(("DC", "A"),)):
        tour_df = spark.createDataFrame(tours, TOURS)
        costs = {t[-1]: t[-4] for t in tours}
        plan = spark.createDataFrame(
            [(n, x, "t", "DC", costs[n], 0.0, "D", "2024-05-01", "10:00") for n, x in loads.items()], PLAN
        )
        demand_df = spark.createDataFrame(demands, DEMAND)
        campus_df = spark.createDataFrame([(1, "one", dc, scac) for dc, scac in campus], SOURCES["campus_map"])
        wide = report.route_lanes(plan, tour_df, demand_df)
        savings = report.route_text(report.route_savings(report.baseline_and_credit(wide), campus_df))
        rollup = report.lane_rollup(report.lane_to_route(savings))
        return SimpleNamespace(
            wide=wide, savings={r.route_nbr: r for r in savings.collect()}, rows=savings.count(),
            lanes={r.pair_number: r for r in report.lanes_on_routes(demand_df, rollup).collect()},
        )

    return build


def test_out_and_back_saves_nothing(made):
    got = made([tour(1, OUT_BACK, 300)], {1: 2}, [demand(1, "OS", 10000.0)])
    row = got.savings[1]
    assert (row.baseline_cost, row.partner_credit, row.savings_per_load, row.savings_pct) == (300.0, 0.0, 0.0, 0.0)
    assert (row.loaded_pct, row.oor_dist, row.route_dtl) == (0.5, 0.0, "DC->STR-DC")
    assert (row.a_ocity, row.b_ocity) == ("CITY", None)
    lane = got.lanes[1]
    assert (lane.model_ded_loads, lane.model_ow_loads, lane.route_nbrs) == (2, 3.0, "1")


def test_three_and_four_legs(made):
    demands = [demand(1, "OS", 10000.0), demand(4, "SRS1-SRS2", 450.0)]
    got = made([tour(1, THREE, 500), tour(2, FOUR, 800)], {1: 1, 2: 3}, demands)
    three, four = got.savings[1], got.savings[2]
    assert (three.baseline_cost, three.partner_credit, three.savings_per_load, three.savings_pct) == (0.0, 450.0, -50.0, None)
    assert three.route_dtl == "DC-SRS_1->SRS_2-DC"
    assert four.route_dtl == "DC->STR-SRS_1->SRS_2-DC"
    assert four.baseline_cost == pytest.approx(2 * 100 * 800 / 400)
    assert four.savings_per_load == pytest.approx(400 - (800 - 450))
    assert (four.total_savings_per_week, four.effective_rt_cost, four.oor_dist) == (pytest.approx(150.0), 350.0, 200.0)
    lane = got.lanes[4]
    assert (lane.route_nbrs, lane.model_ded_loads, lane.model_ow_loads) == ("1, 2", 4, 1.0)
    assert lane.avg_savings_per_load == pytest.approx(0.0)


def test_unknown_one_way_cost_makes_savings_unknown(made):
    row = made([tour(1, FOUR, 800)], {1: 1}, [demand(1, "OS", 1.0), demand(4, "SRS1-SRS2", None)]).savings[1]
    assert (row.partner_credit, row.savings_per_load, row.effective_rt_cost) == (None, None, None)


def test_carriers_of_a_campus_repeat_the_tour(made):
    got = made([tour(1, OUT_BACK, 300)], {1: 4}, [demand(1, "OS", 1.0), demand(9, "OS", 1.0)], (("DC", "A"), ("DC", "B")))
    assert got.rows == 2
    assert (got.lanes[1].model_ded_loads, got.lanes[1].model_ow_loads, got.lanes[1].route_nbrs) == (8, -3.0, "1, 1")
    assert (got.lanes[9].model_ded_loads, got.lanes[9].route_nbrs) == (0, None)


def test_final_columns():
    assert sorted(f.name for f in TOURS) == sorted(costing.FINAL_COLUMNS)
