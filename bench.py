"""Seconds per stage at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, printed as one JSON line.

Two graphs are run: facilities by nation (the graph of the registered queries) and the fine grain, whose
186,000 lanes and 370,000 tours at scale factor 0.1 show the work rather than the fixed cost of a Spark job. The input
tables are written before the clock starts, so the stages do not include the adapter of the test tables.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from collections.abc import Callable

from checks.queries import SINCE, STAMP
from deadhead.config import Params
from deadhead.operators import matching, report
from deadhead.plans.pipeline import Pipeline
from deadhead.session import local_session
from deadhead.sources.tables import read_sources, write_sources
from deadhead.sources.testdata import sources_from_testdata

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def stages(job: Pipeline) -> dict[str, Callable[[], object]]:
    def reports() -> int:
        savings = job.savings(job.plan(STAMP))
        rollup = report.lane_rollup(report.lane_to_route(savings))
        return report.lanes_on_routes(job.lane_demand, rollup).count()

    return {
        "empty_demand": lambda: job.empty_demand,
        "legs": lambda: job.legs,
        "lanes": lambda: job.lane_demand,
        "tours": lambda: job.final_tours,
        "matching": lambda: job.runs,
        "audit": lambda: matching.run_audit(job.routes, job.lane_model, job.runs).collect(),
        "reports": reports,
    }


def main() -> None:
    sf = float(re.search(r"sf([0-9.]+)", SF_DIR).group(1))
    spark = local_session(CPUS, "16g")
    coarse = Params(min_loads=max(1, round(sf * 1000)), since=SINCE)
    fine = Params(min_loads=3 if sf >= 0.1 else 1, since=SINCE, min_partner_volume=max(1, min(20, round(sf * 200))))
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for grain, p in (("nation", coarse), ("fine", fine)):
        given = tempfile.mkdtemp(prefix=f"bench-{grain}-")
        write_sources(sources_from_testdata(spark, SF_DIR, fine=grain == "fine"), given)
        job = Pipeline(read_sources(spark, given), p)
        for name, stage in stages(job).items():
            started = time.perf_counter()
            stage()
            seconds[f"{grain}_{name}"] = round(time.perf_counter() - started, 3)
        rows[f"{grain}_lanes"] = job.lane_numbers.count()
        rows[f"{grain}_tours"] = job.final_tours.count()
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf, "rows": rows}))


if __name__ == "__main__":
    main()
