"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full through the ``noop`` sink (every row produced, nothing
collected to the driver) and timed from plan construction to the end of the write, so
eager steps inside a job (checkpoints, counts) are included.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerprofile.plans.catalog import QUERIES  # noqa: E402
from ledgerprofile.session import build_session  # noqa: E402

HEADLINE = [
    "taxpayer_monthly",
    "industry_monthly",
    "pair_monthly_sales",
    "industry_share",
    "growth_slope_ridge",
    "monthly_autocorrelation",
    "trade_centrality",
    "tag_foreign_trade",
    "tag_fast_growth",
    "tag_periodic",
    "tag_supply_core",
    "tag_industry_leader",
    "enterprise_profile",
]


def _cpu_ticks() -> list[int] | None:
    """Aggregate CPU tick counters (Linux); None elsewhere."""
    try:
        with open("/proc/stat") as fh:
            return [int(x) for x in fh.readline().split()[1:]]
    except (OSError, ValueError):
        return None


def _steal_pct(before: list[int] | None, after: list[int] | None) -> float | None:
    """Share of CPU time the hypervisor took away during the run (context for timings)."""
    if not before or not after or len(before) < 8:
        return None
    delta = [b - a for a, b in zip(before, after)]
    total = sum(delta)
    return round(100.0 * delta[7] / total, 1) if total else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    # warm-up (not timed): JVM start, JIT of the code paths, Python workers - one summary
    # on the smallest scale next to the measured one
    warm_dir = re.sub(r"sf[0-9.]+$", "sf0.001", sf_dir.rstrip("/"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    QUERIES["taxpayer_monthly"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    ticks = _cpu_ticks()
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "cpu_steal_pct": _steal_pct(ticks, _cpu_ticks()),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
