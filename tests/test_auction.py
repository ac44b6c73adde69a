import random

import pytest
from test_matching import LANES, ROUTES, P, best_objective, make, net

from deadhead.operators import auction, matching


def scarce(rng, stores=3, partners=2, tours=8):
    """Every store lane has a fallback; fewer partner loads than store loads."""
    lanes = {i: (rng.randrange(1, 3), 0, "store") for i in range(1, stores + 1)}
    lanes |= {10 + i: (1, rng.randrange(50, 150), "partner") for i in range(1, partners + 1)}
    routes = {i: (rng.randrange(100, 250), (i,)) for i in lanes if i < 10}
    for r in range(20, 20 + tours):
        store, partner = rng.randrange(1, stores + 1), 10 + rng.randrange(1, partners + 1)
        on = (partner,) if rng.random() < 0.2 else (store, None, partner)
        routes[r] = (rng.randrange(100, 300), tuple(n for n in on if n))
    return routes, lanes


@pytest.mark.parametrize("seed", range(8))
def test_within_one_per_cent_of_the_best_plan(spark, seed):
    tours, lanes = scarce(random.Random(300 + seed), tours=7)
    routes, lane_df = make(spark, tours, lanes)
    found = auction.assign_by_prices(routes, lane_df, P)
    row = matching.run_audit(routes, lane_df, found.runs).first()
    best = best_objective(tours, lanes)
    assert (row.lanes_over, row.lanes_short, row.bad_loads) == (0, 0, 0)
    assert best - 1e-9 <= row.objective <= best + 0.01 * abs(best) + 1e-9
    gap = matching.optimality_gap(routes, lane_df, found.runs, P, found.prices).first()
    assert gap.bound <= best + 1e-6
    assert gap.bound >= best - 0.01 * abs(best) - 1e-6
    assert gap.within_target


def test_a_bid_is_withdrawn_when_another_lane_needs_it_more(spark):
    # greedy takes 20 (gain 60) and leaves lane 2 its fallback; moving lane 1 to partner 12 gains 50 + 55
    tours = {1: (200, (1,)), 2: (200, (2,)), 20: (150, (1, 11)), 21: (160, (1, 12)), 22: (155, (2, 11))}
    lanes = {1: (1, 0, "store"), 2: (1, 0, "store"), 11: (1, 10, "partner"), 12: (1, 10, "partner")}
    routes, lane_df = make(spark, tours, lanes)
    greedy = matching.run_audit(routes, lane_df, matching.assign_loads(routes, lane_df)).first().objective
    found = auction.assign_by_prices(routes, lane_df, P)
    assert sorted(r.route_nbr for r in found.runs.collect()) == [21, 22]
    assert matching.run_audit(routes, lane_df, found.runs).first().objective == 295 < greedy
    assert matching.optimality_gap(routes, lane_df, found.runs, P, found.prices).first().bound == pytest.approx(295, abs=3)


@pytest.mark.parametrize("seed", range(3))
def test_feasible_without_fallbacks_whenever_any_plan_is(spark, seed):
    rng = random.Random(70 + seed)
    tours = {r: (rng.randrange(50, 300), (rng.randrange(1, 4), 11 + rng.randrange(3))) for r in range(20, 26)}
    lanes = {i: (rng.randrange(3), 0, "store") for i in range(1, 4)} | {10 + i: (rng.randrange(1, 3), 90, "partner") for i in range(1, 4)}
    routes, lane_df = make(spark, tours, lanes)
    found = auction.assign_by_prices(routes, lane_df, P)
    audit = matching.run_audit(routes, lane_df, found.runs).first()
    best = best_objective(tours, lanes)
    assert (audit.lanes_over, audit.bad_loads) == (0, 0)
    assert (audit.lanes_short == 0) == (best is not None)
    if best is not None:
        assert matching.optimality_gap(routes, lane_df, found.runs, P, found.prices).first().bound <= best + 1e-6


def test_unsold_loads_run_on_the_lanes_own_tours(spark):
    tours = {1: (100, (1,)), 20: (120, (1, 11)), 21: (40, (11,)), 22: (90, (12,))}
    lanes = {1: (2, 0, "store"), 11: (5, 70, "partner"), 12: (3, 60, "partner")}
    routes, lane_df = make(spark, tours, lanes)
    runs = {r.route_nbr: r.loads for r in auction.assign_by_prices(routes, lane_df, P).runs.collect()}
    # a load of lane 1 gains 50 with lane 11, which alone gains 30; lane 12 alone loses 30
    assert runs == {20: 2, 21: 3}
    assert sum(n * net(tours, lanes, r) for r, n in runs.items()) == best_objective(tours, lanes)


def test_tours_of_more_lanes_take_what_is_left(spark):
    tours = {1: (100, (1,)), 2: (100, (2,)), 20: (130, (1, 2, 11)), 21: (500, (1, 11))}
    lanes = {1: (1, 0, "store"), 2: (1, 0, "store"), 11: (1, 50, "partner")}
    routes, lane_df = make(spark, tours, lanes)
    found = auction.assign_by_prices(routes, lane_df, P)
    assert [tuple(r) for r in found.runs.collect()] == [(20, 1)]
    gap = matching.optimality_gap(routes, lane_df, found.runs, P, found.prices).first()
    assert gap.bound <= gap.objective == 80


def test_nothing_to_assign(spark):
    routes, lanes = make(spark, {1: (5, (1,))}, {1: (0, 1, "store")})
    found = auction.assign_by_prices(routes, lanes, P)
    assert found.runs.count() == 0 and found.prices.count() == 0
    empty = auction.assign_by_prices(spark.createDataFrame([], ROUTES), spark.createDataFrame([], LANES), P)
    assert empty.runs.count() == 0


def rounds_of(monkeypatch, routes, lane_df):
    """The outcome of the price rounds and how many there were."""
    names, write = [], auction.materialize
    monkeypatch.setattr(auction, "materialize", lambda df, name: names.append(name) or write(df, name))
    return auction.assign_by_prices(routes, lane_df, P), names.count("market-bids")


def test_loads_of_one_lane_do_not_outbid_each_other(spark, monkeypatch):
    # each store lane has far more loads than the scarce partner lanes it could share; prices used to climb by the step
    tours = {1: (900, (1,)), 2: (900, (2,)), 20: (300, (1, 11)), 21: (320, (1, 12)), 22: (330, (2, 12)), 23: (340, (2, 13))}
    lanes = {1: (40, 0, "store"), 2: (300, 0, "store"), 11: (1, 100, "partner"), 12: (2, 110, "partner"), 13: (50, 120, "partner")}
    routes, lane_df = make(spark, tours, lanes)
    found, rounds = rounds_of(monkeypatch, routes, lane_df)
    assert {r.route_nbr: r.loads for r in found.runs.collect()} == {1: 37, 2: 250, 20: 1, 21: 2, 23: 50}
    gap = matching.optimality_gap(routes, lane_df, found.runs, P, found.prices).first()
    assert gap.bound == pytest.approx(gap.objective) and gap.within_target
    assert rounds <= 4


@pytest.mark.parametrize("seed", range(3))
def test_prices_certify_plans_of_many_loads(spark, monkeypatch, seed):
    rng = random.Random(seed)
    lanes = {i: (rng.randrange(1, 60), 0, "store") for i in range(1, 7)}
    lanes |= {10 + i: (rng.choice([1, 3, 20, 200]), rng.randrange(50, 400), "partner") for i in range(1, 5)}
    tours = {i: (rng.randrange(500, 900), (i,)) for i in range(1, 7)}
    pairs = rng.sample([(s, 10 + o) for s in range(1, 7) for o in range(1, 5)], 14)
    tours |= {20 + i: (rng.randrange(300, 900), pair) for i, pair in enumerate(pairs)}
    routes, lane_df = make(spark, tours, lanes)
    found, rounds = rounds_of(monkeypatch, routes, lane_df)
    audit = matching.run_audit(routes, lane_df, found.runs).first()
    assert (audit.lanes_over, audit.lanes_short, audit.bad_loads) == (0, 0, 0)
    gap = matching.optimality_gap(routes, lane_df, found.runs, P, found.prices).first()
    assert gap.within_target and gap.objective - gap.bound <= found.step * sum(n for n, _, kind in lanes.values() if kind == "store")
    assert rounds <= 60
