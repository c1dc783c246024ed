"""Benchmark: every registered query plus the full import-and-publish run.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line.  Each query is executed completely through the
``noop`` sink (nothing is collected).  The fixture exports are written once
before timing (``setup_sec``), as real exports would already be files.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _sf(sf_dir: str):
    tag = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(tag)
    except ValueError:
        return tag


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from fieldload.plans import import_plan as ip
    from fieldload.plans import publish as pb
    from fieldload.queries import QUERIES
    from fieldload.session import build_session
    from fieldload.sources import fixtures as fx

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)

    t0 = time.perf_counter()
    f = fx.load(spark, sf_dir)
    setup = time.perf_counter() - t0

    timings: dict[str, float] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(repeats):
            t = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        timings[name] = round(sorted(runs)[len(runs) // 2], 3)

    if not only or "full_import" in only:
        base = tempfile.mkdtemp(prefix="fieldload-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
        t = time.perf_counter()
        plan = ip.plan_import(f.sources, f.prior, f.sources.projects.select("id"), fx.RUN_TS)
        pb.run_import(plan, base)
        timings["full_import"] = round(time.perf_counter() - t, 3)

    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": _sf(sf_dir),
                "cpus": cpus,
                "setup_sec": round(setup, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
