import math

import pytest

from deadhead.config import Params
from deadhead.operators import distance, lanes, legs, quality
from deadhead.schemas import EMPTY_DEMAND, LABELLED_LEGS, SOURCES

P = Params()


def lane(o=1, d=2, oz="12345", dz="54321", volume=20, miles=100.0, cost=250.0):
    return (o and str(o), d and str(d), oz, dz, "c", "S", "k", "T", volume, miles, cost)


def partner(spark, *rows):
    return spark.createDataFrame(list(rows), SOURCES["partner_lanes"])


@pytest.mark.parametrize("zip_code,kept", [(None, 0), ("A1234", 0), ("a-1", 0), ("12345", 1), ("12345-6", 1)])
def test_partner_zip(spark, zip_code, kept):
    assert legs.valid_partner_lanes(partner(spark, lane(oz=zip_code)), P).count() == kept
    assert legs.valid_partner_lanes(partner(spark, lane(dz=zip_code)), P).count() == kept


def test_partner_ids_and_volume(spark):
    rows = partner(spark, lane(o=None), lane(d=None), lane(volume=19), lane(volume=None), lane(o=7))
    assert [r.origin_id for r in legs.valid_partner_lanes(rows, P).collect()] == ["7"]


def test_weekly_partner_loads_are_rounded_up(spark):
    rows = partner(spark, *[lane(o=v, volume=v) for v in (20, 40, 41)], lane(o=41, volume=30, miles=300.0, cost=350.0))
    got = {r.o_id: (r.loads, r.dist, r.ow_cost_per_load) for r in legs.loaded_partner_legs(rows, P).collect()}
    assert got == {"SRS_20": (1.0, 100.0, 250.0), "SRS_40": (1.0, 100.0, 250.0), "SRS_41": (2.0, 200.0, 300.0)}


def demand_row(o="S1", d="D1", loads=20, scac="A", region=1, dist=10.0):
    return (region, "one", d, scac, o, "STR", "z" + o, "x", "TX", d, "FDC", "z" + d, "y", "GA", "SO", dist, loads, 10000)


def test_six_kinds_of_legs(spark):
    demand = spark.createDataFrame(
        [demand_row(), demand_row("S2", loads=49), demand_row(scac="B", region=2)], EMPTY_DEMAND
    )
    rows = partner(spark, lane(), lane(d=3))
    got = legs.input_legs(demand, rows, P)
    count = {r.leg: r["count"] for r in got.groupBy("leg").count().collect()}
    # stores by carrier x origins, DCs by owner x origins, destinations x DCs by owner
    assert count == {"SO": 3, "OS": 3, "SSRS1": 3, "OSRS1": 2, "SRS2O": 4, "SRS1-SRS2": 2}
    assert got.distinct().count() == got.count()
    back = {r.d_id: r for r in got.filter("leg = 'OS' and scac = 'A'").collect()}
    assert (back["S2"].loads, back["S1"].loads, back["S1"].o_id, back["S1"].loaded_ind) == (2.0, 1.0, "D1", 1)
    sides = {r.leg: r.side for r in legs.label_legs(got).collect()}
    assert {k for k, v in sides.items() if v == "SRS"} == {"SRS2O", "SRS1-SRS2"}


def leg(oz="a", dz="b", dist=None, o="O", d="D", cost=1.0, loaded=1, loads=1.0, scac="A", kind="OS"):
    return (1, "one", "D1", scac, o, "FDC", oz, "x", "TX", d, "STR", dz, "y", "GA", kind, loads, cost, loaded, "FDC-STR", "THD", dist)


def leg_frame(spark, *rows):
    return spark.createDataFrame(list(rows), LABELLED_LEGS)


def test_distance_sources_in_order(spark):
    df = leg_frame(
        spark,
        leg("own", "b", 5.0),
        leg("fwd", "b"),
        leg("rev", "b"),
        leg("both", "b"),
        leg("geo", "b"),
        leg("none", "b"),
        leg(None, "b"),
        leg("neg", "b", -1.0),
    )
    pairs = [("own", "b", 1.0), ("fwd", "b", 2.0), ("fwd", "b", 4.0), ("b", "rev", 7.0), ("both", "b", 8.0), ("b", "both", 9.0), (None, "b", 1.0)]
    table = spark.createDataFrame(pairs, SOURCES["distance_table"])
    postal = spark.createDataFrame(
        [("geo", 0.0, 0.0), ("b", 1.0, 0.0), ("b", None, 0.0), ("fwd", 3.0, 3.0)], SOURCES["postal_codes"]
    )
    filled = distance.fill_from_table(df, table)
    twice = distance.fill_reversed(distance.fill_forward(df, table), table)
    assert sorted(map(str, filled.collect())) == sorted(map(str, twice.collect()))
    located = distance.fill_geodesic(filled, postal, P)
    assert located.columns[-1] == "dist"
    got = {r.o_zip: r.dist for r in located.collect()}
    assert got["geo"] == pytest.approx(6371010 * math.pi / 180 * 1.2 / 1.6 / 1000)
    del got["geo"]
    assert got == {"own": 5.0, "fwd": 3.0, "rev": 7.0, "both": 8.0, "none": None, None: None, "neg": -1.0}
    assert {r.o_zip for r in distance.missing_distances(located).collect()} == {"none", None, "neg"}
    kept = spark.createDataFrame(
        [("O", "D", "none", "b", 40.0), ("O", "D", "none", "b", 60.0), ("O", "D", "neg", "b", 3.0)],
        SOURCES["manual_distances"],
    )
    manual = distance.fill_manual(located, kept)
    assert {r.o_zip: r.dist for r in manual.filter("o_zip in ('none', 'neg')").collect()} == {"none": 50.0, "neg": -1.0}


def test_gate(spark):
    with pytest.raises(quality.MissingDistances):
        quality.require_distances(leg_frame(spark, leg()))
    with pytest.raises(Exception, match="MISSING DISTANCES"):
        quality.missing_count(leg_frame(spark, leg())).collect()
    # negative distances pass the gate and are purged
    negative = leg_frame(spark, leg(dist=-1.0), leg(dist=1.0), leg(dist=1.0, cost=None))
    quality.require_distances(negative)
    assert quality.missing_count(negative).first()[0] == 0
    assert quality.purge_legs(negative).count() == 1


def test_rates(spark):
    df = leg_frame(spark, leg("a", "b", 1.0, cost=5.0), leg("c", "b", 1.0, cost=5.0), leg("d", "b", 1.0, cost=5.0))
    rates = spark.createDataFrame([("a", "b", 9.0), ("c", "b", None), ("x", "x", 1.0), ("x", "x", 2.0)], SOURCES["partner_rates"])
    got = {r.o_zip: r.ow_cost_per_load for r in quality.overwrite_rates(df, rates).collect()}
    assert got == {"a": 9.0, "c": None, "d": 5.0}
    twice = rates.union(rates)
    with pytest.raises(Exception, match="several rates"):
        quality.overwrite_rates(df, twice).collect()


def test_lane_demand_averages_over_carriers(spark):
    df = leg_frame(
        spark,
        leg("a", "b", 10.0, scac="A", loads=2.0),
        leg("a", "b", 20.0, scac="B", loads=5.0),
        leg("a", "c", 1.0, loads=1.0),
        leg("a", "b", 9.0, loaded=0, kind="SO"),
    )
    edges = lanes.edges(df)
    assert edges.count() == 4
    numbers = lanes.lane_numbers(edges)
    assert sorted((r.d_zip, r.pair_number) for r in numbers.collect()) == [("b", 1), ("c", 2)]
    got = {r.pair_number: (r.loads, r.dist, r.o_city, r.majority_mode) for r in lanes.lane_demand(df, numbers).collect()}
    assert got == {1: (3.0, 15.0, "X", "DED"), 2: (1.0, 1.0, "X", "DED")}
