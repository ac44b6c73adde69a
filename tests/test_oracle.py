"""Every registered query against DuckDB; one pipeline is shared, so each stage runs once."""

from dataclasses import replace

import pytest

from checks import oracle, queries
from checks.compare import connect, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def job(spark):
    # at this scale few lanes reach the registered minimum of loads
    return queries.pipeline(spark, SF, replace(queries.PARAMS, min_loads=1))


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", [n for n in queries._BUILDS if n not in queries.WITHOUT_SQL])
def test_query_equals_oracle(job, duck, name):
    got = queries.rounded(queries._BUILDS[name](job))
    result = duck.execute(oracle.statement(name, min_loads=1))
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, result.fetchall())


def test_every_query_has_a_statement():
    assert set(queries._BUILDS) - queries.WITHOUT_SQL <= set(oracle.BLOCKS)


def test_priced_plan_is_valid_and_near_the_bound(job):
    audit, gap = (queries._BUILDS[n](job).first() for n in ("priced_audit", "priced_gap"))
    assert (audit.lanes_over, audit.bad_loads) == (0, 0)
    assert gap.objective == pytest.approx(audit.objective) and gap.within_target
    greedy = queries._BUILDS["audit_totals"](job).first()
    assert audit.loads_short == greedy.loads_short
    assert audit.objective <= greedy.objective + 0.01 * abs(greedy.objective)


def test_every_block_double_is_compared_rounded(job):
    for name, build in queries._BUILDS.items():
        if name in queries.WITHOUT_SQL:
            continue
        doubles = [f.name for f in build(job).schema if f.dataType.simpleString() == "double"]
        whole = {"loads", "model_loads", "model_ow_loads"}
        assert set(doubles) - whole <= set(oracle.DOUBLES.get(name, [])), name
