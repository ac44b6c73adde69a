import itertools
import random
from datetime import datetime

import pytest

from deadhead.config import Params
from deadhead.operators import matching
from deadhead.schemas import DEMAND

P = Params()
ROUTES = "route_nbr long, home_dc string, lane_1 long, lane_2 long, lane_3 long, lane_4 long, total_dist double, cost double, mode string"
LANES = "lane long, demand long, ow_cpl double, must_cover boolean, partner boolean"


def make(spark, tours, lanes):
    """tours: {route: (cost, lanes)}; lanes: {lane: (demand, one-way cost, 'store' | 'partner' | 'other')}."""
    rows = [(r, "D", *(list(on) + [None] * 4)[:4], 1.0, float(cost), "D") for r, (cost, on) in tours.items()]
    lane_rows = [(n, d, float(c), kind == "store", kind == "partner") for n, (d, c, kind) in lanes.items()]
    return spark.createDataFrame(rows, ROUTES), spark.createDataFrame(lane_rows, LANES)


def net(tours, lanes, r):
    cost, on = tours[r]
    return cost - sum(lanes[n][1] for n in set(on) if n in lanes and lanes[n][2] == "partner")


def one_by_one(tours, lanes):
    """The outcome the rounds must reach, taken tour by tour."""
    on = {r: {n for n in t[1] if n in lanes} for r, t in tours.items()}
    store = {n for n, v in lanes.items() if v[2] == "store"}
    base = {}
    for r in sorted(tours, key=lambda r: (net(tours, lanes, r), r)):
        if len(on[r]) == 1 and on[r] <= store:
            base.setdefault(next(iter(on[r])), r)
    value = {}
    for n in store:
        nets = [net(tours, lanes, r) for r in tours if n in on[r]]
        if nets:
            value[n] = net(tours, lanes, base[n]) if n in base else max(nets)
    scored = []
    for r in tours:
        if on[r]:
            gain = sum(value[n] for n in on[r] & store) - net(tours, lanes, r)
            urgent = any(n not in base for n in on[r] & store)
            if gain > 0 or urgent:
                scored.append((not urgent, -gain, r))
    left = {n: v[0] for n, v in lanes.items()}
    runs = {}
    for _, _, r in sorted(scored):
        loads = min(left[n] for n in on[r])
        if loads > 0:
            runs[r] = loads
            for n in on[r]:
                left[n] -= loads
    for n, r in base.items():
        if left[n] > 0:
            runs[r] = left[n]
    return runs


def random_case(rng, stores=3, partners=2, tours=8, load=2):
    lanes = {i: (rng.randrange(load + 1), rng.randrange(50, 150), "store") for i in range(1, stores + 1)}
    lanes |= {10 + i: (rng.randrange(load + 1), rng.randrange(50, 150), "partner") for i in range(1, partners + 1)}
    routes = {i: (rng.randrange(50, 200), (i,)) for i in range(1, stores + 1) if rng.random() < 0.85}
    for r in range(20, 20 + tours):
        store, partner = rng.randrange(1, stores + 1), 10 + rng.randrange(1, partners + 1)
        on = rng.choice([(store, None, partner), (store, None, partner), (None, partner)])
        routes[r] = (rng.randrange(50, 300), tuple(n for n in on if n))
    return routes, lanes


def test_an_exchange_covers_a_short_store_lane(spark):
    tours = {20: (100, (1, 11)), 21: (150, (1, 12)), 22: (100, (2, 11))}
    lanes = {1: (1, 0, "store"), 2: (1, 0, "store"), 11: (1, 10, "partner"), 12: (1, 10, "partner")}
    routes, lane_df = make(spark, tours, lanes)
    runs = matching.assign_loads(routes, lane_df)
    assert sorted(tuple(r) for r in runs.collect()) == [(21, 1), (22, 1)]
    gap = matching.optimality_gap(routes, lane_df, runs, P).first()
    assert gap.coverable_short == 0 and gap.bound <= gap.objective == 230


def test_no_verdict_for_a_plan_that_leaves_a_coverable_lane_short(spark):
    routes, lane_df = make(spark, {20: (100, (1, 11))}, {1: (2, 0, "store"), 11: (1, 10, "partner")})
    runs = matching.assign_loads(routes, lane_df)
    assert [tuple(r) for r in runs.collect()] == [(20, 1)]
    gap = matching.optimality_gap(routes, lane_df, runs, P).first()
    assert (gap.coverable_short, gap.within_target) == (1, False)


def test_verdict_of_an_empty_plan(spark):
    routes, lane_df = make(spark, {1: (5, (1,))}, {1: (0, 1, "store")})
    gap = matching.optimality_gap(routes, lane_df, matching.assign_loads(routes, lane_df), P).first()
    assert (gap.objective, gap.coverable_short, gap.within_target) == (0.0, 0, True)


@pytest.mark.parametrize("seed", range(3))
def test_feasible_without_fallbacks_whenever_any_plan_is(spark, seed):
    rng = random.Random(50 + seed)
    stores, partners = 3, 3
    tours = {r: (rng.randrange(50, 300), (rng.randrange(1, stores + 1), 11 + rng.randrange(partners))) for r in range(20, 26)}
    lanes = {i: (rng.randrange(3), 0, "store") for i in range(1, stores + 1)} | {10 + i: (rng.randrange(1, 3), 90, "partner") for i in range(1, partners + 1)}
    routes, lane_df = make(spark, tours, lanes)
    runs = matching.assign_loads(routes, lane_df)
    audit = matching.run_audit(routes, lane_df, runs).first()
    assert (audit.lanes_over, audit.bad_loads) == (0, 0)
    assert (audit.lanes_short == 0) == (best_objective(tours, lanes) is not None)


@pytest.mark.parametrize("seed", range(4))
def test_rounds_equal_taking_tours_one_by_one(spark, seed):
    tours, lanes = random_case(random.Random(seed), stores=8, partners=4, tours=40, load=6)
    routes, lane_df = make(spark, tours, lanes)
    cands = matching.candidates(routes, lane_df)
    values = matching.lane_values(cands)
    greedy = matching.greedy_rounds(matching.gains(cands, values), lane_df).select("route_nbr", "loads")
    got = {r.route_nbr: r.loads for r in greedy.unionByName(matching.fallback_runs(cands, values, greedy, lane_df)).collect()}
    assert got == one_by_one(tours, lanes)
    audit = matching.lane_audit(routes, lane_df, matching.assign_loads(routes, lane_df)).collect()
    assert not any(r.over for r in audit)
    assert all(r.dedicated + r.one_way == r.demand for r in audit)


def best_objective(tours, lanes):
    """Least net cost by trying all loads; None if some store lane cannot be covered."""
    rooms = [range(min([lanes[n][0] for n in set(on)]) + 1) for _, on in tours.values()]
    best = None
    for loads in itertools.product(*rooms):
        used = dict.fromkeys(lanes, 0)
        for (cost, on), x in zip(tours.values(), loads):
            for n in set(on):
                used[n] += x
        if all(used[n] == v[0] if v[2] == "store" else used[n] <= v[0] for n, v in lanes.items()):
            total = sum(x * net(tours, lanes, r) for r, x in zip(tours, loads))
            best = total if best is None else min(best, total)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_half_of_the_best_gain_at_least(spark, seed):
    rng = random.Random(100 + seed)
    tours, lanes = random_case(rng, tours=5)
    for i in range(1, 4):  # every store lane has a fallback
        tours.setdefault(i, (120, (i,)))
    routes, lane_df = make(spark, tours, lanes)
    runs = matching.assign_loads(routes, lane_df)
    row = matching.run_audit(routes, lane_df, runs).first()
    best = best_objective(tours, lanes)
    plain = sum(lanes[i][0] * min(net(tours, lanes, r) for r in tours if tours[r][1] == (i,)) for i in range(1, 4))
    assert (row.lanes_over, row.lanes_short, row.bad_loads) == (0, 0, 0)
    assert best <= row.objective + 1e-9
    assert plain - row.objective >= (plain - best) / 2 - 1e-9
    gap = matching.optimality_gap(routes, lane_df, runs, P).first()
    assert gap.objective == pytest.approx(row.objective)
    assert gap.bound <= best + 1e-6


def test_shared_store_lane_uncovered_lane_and_empty_lane_number(spark):
    tours = {1: (100, (1,)), 2: (120, (1, 11)), 3: (130, (1, 12)), 4: (10, ())}
    lanes = {1: (1, 0, "store"), 2: (3, 0, "store"), 11: (5, 60, "partner"), 12: (5, 90, "partner")}
    routes, lane_df = make(spark, tours, lanes)
    runs = matching.assign_loads(routes, lane_df)
    assert [(r.route_nbr, r.loads) for r in runs.collect()] == [(3, 1)]
    assert [tuple(r) for r in matching.uncovered(routes, lane_df).collect()] == [(2, 3)]
    assert matching.run_audit(routes, lane_df, runs).first().asDict() == {
        "lanes_over": 0, "lanes_short": 1, "coverable_short": 0, "loads_short": 3, "objective": 40.0, "bad_loads": 0,
    }
    left = {r.pair_number: r.loads for r in matching.one_way_loads(routes, lane_df, runs, P).collect()}
    assert left == {"2": 3, "11": 5, "12": 4}
    assert matching.run_counts(routes, lane_df, runs).first()[:] == (4, 4, 1, 3)
    summary = matching.cost_summary(routes, lane_df, runs, P).first()
    assert (summary.dedicated_cost, summary.ow_cost, summary.total_cost) == (130.0, 5 * 60 + 4 * 90.0, 40.0)
    plan = matching.dedicated_plan(routes, runs, datetime(2024, 5, 1, 9, 5), P).first()
    assert (plan.route_nbr, plan.cost, plan.run_date, plan.run_time) == (3, 130.0, "2024-05-01", "09:05")


def test_lane_driven_twice_counts_once(spark):
    routes, _ = make(spark, {1: (1, (5, 5, 6))}, {5: (1, 1, "store")})
    assert sorted(r.lane for r in matching.incidence(routes).collect()) == [5, 6]


def test_lane_model_takes_the_cheapest_row(spark):
    def row(pair, cost, loads, leg="OS", o="FDC", d="STR"):
        return ("THD", "O", o, "z", "C", "S", "D", d, "z", "C", "S", pair, cost, leg, 1.0, loads, "DED")

    rows = [row(1, 9.0, 1.0), row(1, 5.0, 2.0), row(1, 5.0, 3.0), row(None, 1.0, 1.0), row(2, 1.0, 0.0, "SRS1-SRS2", "SRS1", "SRS2")]
    demand = spark.createDataFrame(rows, DEMAND)
    got = {r.lane: tuple(r)[1:] for r in matching.lane_model(demand).collect()}
    assert got == {1: (3, 5.0, True, False), 2: (0, 1.0, False, True)}
    routes, _ = make(spark, {1: (1, (1, 77))}, {1: (1, 1, "store")})
    assert matching.lane_issues(routes, demand).first()[:] == (1, 1, 1)


def test_nothing_to_run(spark):
    routes, lanes = make(spark, {1: (5, (1,))}, {1: (0, 1, "store")})
    assert matching.assign_loads(routes, lanes).count() == 0
