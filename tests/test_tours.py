import random

import duckdb
import pytest

from checks import oracle
from checks.compare import rows_of
from deadhead.config import Params, Tuning
from deadhead.operators import costing, tours
from deadhead.schemas import EDGES, LANES, SOURCES

P = Params()
PAIRS = {"OS": ("D", "S"), "SO": ("S", "D"), "SSRS1": ("S", "P"), "OSRS1": ("D", "P"), "SRS1-SRS2": ("P", "Q"), "SRS2O": ("Q", "D")}
KIND = {"D": "FDC", "S": "STR", "P": "SRS1", "Q": "SRS2"}
LOADED = {"OS", "SRS1-SRS2"}


def edge(leg, o, d, dist, ozip=None, dzip=None, types=None):
    a, b = types or (KIND[PAIRS[leg][0]], KIND[PAIRS[leg][1]])
    dtl = None if a is None or b is None else f"{a}-{b}"
    return (o, a, ozip or "z" + o, d, b, dzip or "z" + d, leg, dtl, int(leg in LOADED), float(dist))


def frames(spark, edges, homes):
    return (
        spark.createDataFrame(sorted(set(edges), key=str), EDGES),
        spark.createDataFrame([(h,) for h in homes], "dc string"),
    )


def plain(edges, homes, name):
    con = duckdb.connect()
    con.execute("CREATE TABLE edges (o_id VARCHAR, o_type VARCHAR, o_zip VARCHAR, d_id VARCHAR, d_type VARCHAR, d_zip VARCHAR,"
                " leg VARCHAR, leg_dtl VARCHAR, loaded_ind BIGINT, dist DOUBLE)")
    con.executemany("INSERT INTO edges VALUES (?,?,?,?,?,?,?,?,?,?)", sorted(set(edges), key=str))
    con.execute("CREATE TABLE campuses (dc VARCHAR)")
    for home in homes:
        con.execute("INSERT INTO campuses VALUES (?)", [home])
    result = con.execute(oracle.statement(name, ("edges", "campuses")))
    columns = [d[0] for d in result.description]
    return rows_of(columns, result.fetchall())


def spark_rows(df):
    from checks.queries import rounded

    return rows_of(df.columns, [tuple(r) for r in rounded(df).collect()])


def random_edges(seed, clean):
    rng = random.Random(seed)
    names = {k: [f"{k}{i}" for i in range(n)] for k, n in {"D": 3, "S": 4, "P": 3, "Q": 3}.items()}
    if not clean:  # ids shared between facility kinds
        names["S"][0], names["P"][0], names["Q"][0], names["Q"][1] = "D0", "D1", "P1", "S1"
    edges = []
    for leg, (a, b) in PAIRS.items():
        for o in names[a]:
            for d in names[b]:
                if rng.random() < 0.7:
                    far = 700 if leg in LOADED else 250
                    edges.append(edge(leg, o, d, rng.randrange(0, far)))
                    if rng.random() < 0.15:  # several distances, zips or types of one lane
                        edges.append(edge(leg, o, d, rng.randrange(0, far)))
                        edges.append(edge(leg, o, d, 50, ozip="other"))
                        edges.append(edge(leg, o, d, 60, types=(None, "X")))
                        edges.append(edge(leg, o, d, 60, types=(None, "Y")))
    return edges


@pytest.mark.parametrize("clean", [True, False])
@pytest.mark.parametrize("seed", [1, 3])
def test_tours_equal_the_plain_chains(spark, seed, clean):
    edges = random_edges(seed, clean)
    homes = ["D0", "D1", "D2"] if clean else ["D0", "D1", "S1", "P1"]
    edge_df, home_df = frames(spark, edges, homes)
    tuning = Tuning(pairs_per_task=72) if seed == 3 else Tuning()
    got = tours.build_tours(edge_df, home_df, P, tuning)
    want = plain(edges, homes, "tours_all")
    assert spark_rows(got) == want
    assert sum(want.values()) > 20
    homed = tours.build_tours(edge_df, home_df, P, tuning, only_dc_homed=True)
    assert spark_rows(homed) == spark_rows(tours.dc_homed(got)) == plain(edges, homes, "tours_dc_homed")


@pytest.mark.parametrize("clean", [True, False])
def test_chains_equal_the_plain_chains(spark, clean):
    edges = random_edges(7, clean)
    edge_df, _ = frames(spark, edges, [])
    two = tours.two_leg_chains(edge_df, P)
    assert spark_rows(two) == plain(edges, [], "chains2")
    assert spark_rows(tours.three_leg_chains(two, edge_df, P)) == plain(edges, [], "chains3")


def shape(df):
    return sorted((r.a_origin, r.a_dest, r.b_dest, r.c_dest, r.d_dest) for r in df.collect())


def build(spark, edges, homes=("D",)):
    return tours.build_tours(*frames(spark, edges, homes), P)


def test_mileage_cap(spark):
    fits = [edge("OS", "D", "S", 600), edge("SO", "S", "D", 600)]
    over = [edge("OS", "D", "T", 600.01), edge("SO", "T", "D", 600)]
    assert shape(build(spark, fits + over)) == [("D", "S", "D", None, None)]


def three(first, loaded, last):
    return [edge("OSRS1", "D", "P", first), edge("SRS1-SRS2", "P", "Q", loaded), edge("SRS2O", "Q", "D", last)]


def test_empty_share(spark):
    assert build(spark, three(100, 200, 100)).count() == 0
    assert shape(build(spark, three(100, 200.01, 100))) == [("D", "P", "Q", "D", None)]
    assert build(spark, three(0, 0, 0)).count() == 0


def test_home_types(spark):
    out_and_back = [edge("SO", "S", "D", 5), edge("SO", "S", "E", 5), edge("SO", "S", "F", 5)]
    first = [
        edge("OS", "D", "S", 5, types=(None, "STR")),
        edge("OS", "E", "S", 5, types=("XDC", "STR")),
        edge("OS", "F", "S", 5, types=("FDC/BDC", "STR")),
    ]
    got = tours.dc_homed(build(spark, out_and_back + first, ("D", "E", "F")))
    assert [r[0] for r in shape(got)] == ["D", "F"]


def test_cost_and_lane_numbers(spark):
    edges = [edge("OS", "D", "S", 30), edge("SO", "S", "D", 30), edge("OS", "E", "S", 30), edge("SO", "S", "E", 30)]
    edge_df, home_df = frames(spark, edges, ["D", "E"])
    lanes = spark.createDataFrame([("D", "S", "zD", "zS", 1), ("D", "S", "old", "zS", 2), ("S", "D", "zS", "zD", 3)], LANES)
    rates = spark.createDataFrame([("D", 0.9, 5.0, 10.0), ("D", 1.1, 7.0, 30.0)], SOURCES["dedicated_costs"])
    priced = costing.priced_tours(edge_df, home_df, lanes, rates, P)
    stepwise = costing.tour_lanes(
        costing.tour_cost(tours.dc_homed(tours.build_tours(edge_df, home_df, P)), rates, P), lanes
    )
    assert spark_rows(priced) == spark_rows(stepwise)
    final = costing.final_tours(priced)
    got = [(r.route_nbr, r.home_dc, r.pair_nbr1, r.pair_nbr2, r.pair_nbr3, r.rf_cost) for r in final.orderBy("route_nbr").collect()]
    per_leg = 30 * 1.0 + 30 * 0.4 + 6 + 1.0 * 20
    assert got == [
        (1, "D", 1, 3, None, pytest.approx(2 * per_leg)),
        (2, "D", 2, 3, None, pytest.approx(2 * per_leg)),
        (3, "E", None, None, None, 0.0),  # a home without rates
    ]


def test_no_python_and_no_cartesian_product_in_tours(spark):
    plan = build(spark, random_edges(1, True), ("D0",))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
