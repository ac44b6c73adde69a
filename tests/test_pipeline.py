from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from deadhead import storage
from deadhead.config import Params
from deadhead.operators import distance, quality
from deadhead.plans.pipeline import Pipeline, run
from deadhead.schemas import SOURCES
from deadhead.sources.tables import Snapshot, Sources, published, read_catalog, read_published, read_sources, write_sources
from deadhead.sources.testdata import sources_from_testdata

TABLES = {
    "str_dc_empty_demand", "missing_distances", "input_legs", "rf_locations", "rf_pair_number_lanes", "demand_data",
    "rf_routes_final", "matching_ded", "matching_ow", "routes_lanes", "routes_savings", "pair_to_route_lookup",
    "route_to_pair_lookup_base", "lanes_on_routes", "uncovered_lanes", "lane_issues", "run_audit", "matching_gap", "cost_summary", "run_counts",
}


def test_from_written_tables_to_written_reports(spark, tmp_path):
    write_sources(sources_from_testdata(spark, "/root/testdata/sf0.001"), str(tmp_path / "in"))
    src = read_sources(spark, str(tmp_path / "in"))
    assert isinstance(src, Sources)
    p = Params(min_loads=1, since=date(1998, 1, 1))
    out = run(src, str(tmp_path / "out"), datetime(2024, 5, 1, 10, 0), p)
    root = str(tmp_path / "out")
    assert set(out) == TABLES == set(published(spark, root)[0].tables)
    assert read_published(spark, root, "rf_routes_final").count() == 164
    assert out["rf_routes_final"].count() == 164
    audit = out["run_audit"].first()
    assert (audit.lanes_over, audit.bad_loads) == (0, 0)
    ded = {r.pair_number: r.model_loads for r in out["lanes_on_routes"].collect()}
    assert len(ded) == out["demand_data"].count()
    gap = out["matching_gap"].first()
    assert gap.within_target and gap.bound <= gap.objective


def table_of(spark, day):
    return spark.createDataFrame([(day,)], "day int")


def test_a_failed_run_leaves_the_published_tables(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(LookupError):
        read_published(spark, root, "plan")
    first = Snapshot(spark, root)
    first.write("plan", table_of(spark, 1))
    with pytest.raises(LookupError):
        read_published(spark, root, "plan")
    first.publish()
    failed = Snapshot(spark, root)
    failed.write("plan", table_of(spark, 2))  # and never published
    assert read_published(spark, root, "plan").first().day == 1
    for day in (3, 4):
        later = Snapshot(spark, root)
        later.write("plan", table_of(spark, day))
        later.publish()
        assert read_published(spark, root, "plan").first().day == day
    assert [r.number for r in published(spark, root)] == [3, 2, 1]
    kept = {f.name for f in (tmp_path / "out" / "_runs").iterdir()}
    assert kept == {failed.run, *[r.run for r in published(spark, root)[:2]]}
    with pytest.raises(LookupError):
        read_published(spark, root, "other")


def test_the_gate_stops_on_what_was_written(spark, tmp_path):
    src = sources_from_testdata(spark, "/root/testdata/sf0.001")
    p = Params(min_loads=1, since=date(1998, 1, 1))
    gone = ("postal_codes", "distance_table", "manual_distances")
    without = Sources(**{name: getattr(src, name).limit(0) if name in gone else getattr(src, name) for name in SOURCES})
    job = Pipeline(without, p)
    with pytest.raises(quality.MissingDistances):
        job.legs
    assert job.missing_distances.count() > 0


def test_products_are_located_once_per_zip_pair(spark):
    src = sources_from_testdata(spark, "/root/testdata/sf0.001")
    job = Pipeline(src, Params(min_loads=1, since=date(1998, 1, 1)))
    plain = distance.fill_geodesic(distance.fill_from_table(job.labelled_legs, src.distance_table), src.postal_codes, job.p)
    rows = lambda df: sorted(map(repr, df.withColumn("dist", F.round("dist", 6)).select(*sorted(df.columns)).collect()))
    assert rows(job.located_legs) == rows(plain)
    zips = job.zip_distances
    assert zips.count() == zips.select("o_zip", "d_zip").distinct().count()


def session_with(configured=None, checkpoint_dir=None, master="yarn"):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoint_dir)
    return SimpleNamespace(conf={"spark.checkpoint.dir": configured}, sparkContext=context)


def test_shared_folder_is_read_from_the_session():
    assert storage.shared_folder(session_with("hdfs:///shared/")) == "hdfs:///shared"
    assert storage.shared_folder(session_with(checkpoint_dir="hdfs:///set")) == "hdfs:///set"


def test_no_private_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(session_with())
    assert storage.shared_folder(session_with(master="local[2]"))


def test_catalog_tables_are_read_and_conformed(spark):
    for name, schema in SOURCES.items():
        rows = [tuple(None for _ in schema)]
        spark.createDataFrame(rows, schema).withColumn("more", F.lit(1)).createOrReplaceTempView(f"listed_{name}")
    src = read_catalog(spark, {name: f"listed_{name}" for name in SOURCES})
    assert all(getattr(src, name).schema == schema and getattr(src, name).count() == 1 for name, schema in SOURCES.items())
    spark.range(1).createOrReplaceTempView("listed_calendar")
    with pytest.raises(ValueError, match="cal_dt"):
        read_catalog(spark, {name: f"listed_{name}" for name in SOURCES})
