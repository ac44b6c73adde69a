import random
from datetime import date, datetime
from types import SimpleNamespace

import pytest

from deadhead.config import Params
from deadhead.operators.demand import empty_demand, lane_totals
from deadhead.schemas import SOURCES
from deadhead.sources.tables import Sources

P = Params(min_loads=2, since=date(2024, 1, 1))


def make_sources(spark, **rows):
    return SimpleNamespace(
        **{name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SOURCES.items()}
    )


def line(n=1, invoice="i1", o="S1", ot="STR", d="D1", dt="FDC", miles=10.0, day=date(2024, 2, 1), arvl=None, dprt=None, kind=25):
    return [(invoice, o, ot, "z" + o, d, dt, "z" + d, miles, day, arvl, dprt, kind)] * n


DAYS = [(date(2024, 2, 1),), (date(2023, 2, 1),), (date(2024, 2, 2),)]


def run(spark, lines, p=P, **rows):
    rows.setdefault("calendar", DAYS)
    return empty_demand(make_sources(spark, invoice_lines=lines, **rows), p).collect()


def test_minimum_of_loads(spark):
    got = run(spark, line(2, o="S1") + line(1, o="S2"))
    assert [(r.o_id, r.loads) for r in got] == [("S1", 2)]
    assert (got[0].leg, got[0].ow_cost_per_load, got[0].dist) == ("SO", 10000, 10.0)


def test_first_known_date_counts(spark):
    lines = (
        line(2, o="none", day=None)
        + line(2, o="left", day=None, dprt=datetime(2024, 2, 2, 5))
        + line(2, o="came", day=None, arvl=datetime(2024, 2, 1, 5), dprt=datetime(2023, 2, 1))
        + line(2, o="old", day=date(2023, 2, 1), arvl=datetime(2024, 2, 1))
        + line(2, o="offcal", day=date(2024, 7, 1))
    )
    assert {r.o_id for r in run(spark, lines)} == {"left", "came"}


def test_types_and_shipment_kind(spark):
    lines = (
        line(2, o="ok", dt="FDC/BDC")
        + line(2, o="null", ot=None)
        + line(2, o="store", dt="STR")
        + line(2, o="kind", kind=10)
        + line(2, o="rev", dt="BDC/FDC")
    )
    assert {r.o_id for r in run(spark, lines)} == {"ok"}


def test_dimensions_multiply_and_the_dc_is_moved(spark):
    got = run(
        spark,
        line(2, miles=None) + line(1, miles=6.0),
        invoices=[("i1", "D1")],
        campus_map=[(1, "one", "D1", "A"), (1, "one", "D1", "B")],
        locations=[("S1", "x", "TX", "1"), ("S1", "x", "TX", "2"), ("S1", "x", "TX", "2"), ("D1", "y", "GA", "3")],
        dc_transitions=[("D1", "D9")],
    )
    # twice by the two zips of the store, once per carrier
    assert sorted((r.scac, r.loads, r.dist, r.d_id, r.d_zip, r.d_city, r.o_city) for r in got) == [
        ("A", 6, 6.0, "D9", "zD1", "y", "x"),
        ("B", 6, 6.0, "D9", "zD1", "y", "x"),
    ]


def test_repeated_calendar_dates_and_invoices_count_again(spark):
    got = run(spark, line(1) + line(1, miles=20.0), calendar=DAYS + DAYS[:1], invoices=[("i1", "D1"), ("i1", "D1")])
    assert [(r.loads, r.dist) for r in got] == [(8, 15.0)]


def test_lines_without_invoice_id_are_kept(spark):
    got = run(spark, line(3, invoice=None), invoices=[(None, "D1"), ("i2", "D1")])
    assert [(r.loads, r.dc_nbr) for r in got] == [(3, None)]


def test_equals_grouping_after_all_joins_on_random_rows(spark):
    rng = random.Random(5)
    lines = []
    for _ in range(400):
        lines += line(
            1,
            invoice=rng.choice(["i1", "i1", "i1", "i2", "i3", None]),
            o=rng.choice(["S1", "S2"]),
            d=rng.choice(["D1", "D2"]),
            dt=rng.choice(["FDC", "BDC"]),
            miles=rng.choice([None, 1.0, 2.5, 8.0]),
            day=rng.choice([None, date(2024, 2, 1), date(2024, 2, 2)]),
            arvl=rng.choice([None, datetime(2024, 2, 1)]),
        )
    src = make_sources(
        spark,
        invoice_lines=lines,
        calendar=DAYS + DAYS[:1],
        invoices=[("i1", "D1"), ("i1", "D2"), ("i2", None)],
        campus_map=[(1, "one", "D1", "A"), (2, "two", "D1", "B")],
        locations=[("S1", "x", "TX", "1"), ("S1", "x", "TX", "2"), ("D2", "y", "GA", "3"), ("D2", "q", "GA", "3")],
        dc_transitions=[("D1", "D9"), ("D1", "D8")],
    )
    for name in SOURCES:
        getattr(src, name).createOrReplaceTempView(name)
    plain = spark.sql("""
        SELECT campus, campus_nbr_nm, dc_nbr, scac, orig_fac_als_id o, p.city_nm oc, nvl(new_bdc_nbr, dest_fac_als_id) d,
               dest_fac_typ_ind dt, dest_pstl_cd dz, q.city_nm dcity, avg(mile_cnt) dist, count(*) loads
        FROM invoice_lines l LEFT JOIN dc_transitions ON dest_fac_als_id = old_bdc_nbr
        LEFT JOIN invoices i ON l.invoice_id = i.invoice_id
        JOIN calendar ON cal_dt = nvl(shp_dt, nvl(to_date(arvl_ts), to_date(dprt_ts)))
        LEFT JOIN campus_map ON dc_nbr = campus_name
        LEFT JOIN (SELECT DISTINCT * FROM locations) p ON orig_fac_als_id = p.loc_nbr
        LEFT JOIN (SELECT DISTINCT * FROM locations) q ON dest_fac_als_id = q.loc_nbr
        WHERE cal_dt >= '2024-01-01' GROUP BY ALL""")
    got = empty_demand(src, P).select(
        "region", "campus_nbr_nm", "dc_nbr", "scac", "o_id", "o_city", "d_id", "d_type", "d_zip", "d_city", "dist", "loads"
    )
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, plain.filter("loads >= 2").collect()))


def test_invoices_are_scanned_once_and_filters_reach_the_scan(spark, tmp_path):
    src = make_sources(spark, invoice_lines=line(2), calendar=DAYS)
    path = str(tmp_path / "lines")
    src.invoice_lines.write.parquet(path)
    src.invoice_lines = spark.read.parquet(path)
    plan = lane_totals(src, P)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "ond_shp_typ_cd" in pushed and "shp_dt" in pushed
    assert "Python" not in plan


@pytest.mark.parametrize("hot", ["i1", None])
def test_a_hot_invoice_is_spread(spark, tmp_path, hot):
    settings = {
        # the calendar stays below the threshold, the invoices do not
        "spark.sql.autoBroadcastJoinThreshold": "1500",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "3000",
    }
    before = {k: spark.conf.get(k) for k in settings}
    rng = random.Random(2)
    lines = line(3000, invoice=hot) + [row for i in range(300) for row in line(1, invoice=f"j{i}")]
    lines = [(*r[:7], rng.random() * 100, *r[8:]) for r in lines]
    src = make_sources(spark, invoice_lines=lines, calendar=DAYS, invoices=[("i1", "D1")] + [(f"j{i}", "D1") for i in range(300)])
    for name, parts in (("invoice_lines", 16), ("calendar", 1), ("invoices", 1)):
        getattr(src, name).repartition(parts).write.parquet(str(tmp_path / name))
        setattr(src, name, spark.read.parquet(str(tmp_path / name)))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = lane_totals(src, P)
        assert sorted((r.dc_nbr or "", r.loads) for r in df.collect()) == ([("D1", 3300)] if hot else [("", 3000), ("D1", 300)])
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        print(plan)
        assert "hashpartitioning(invoice_id" in plan and "null_key" in plan.split("hashpartitioning(invoice_id")[1][:40]
        assert hot is None or "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_missing_column_is_an_error(spark):
    src = make_sources(spark)
    with pytest.raises(ValueError, match="dc_nbr"):
        Sources(**{**vars(src), "invoices": src.invoices.drop("dc_nbr")}).conformed()
