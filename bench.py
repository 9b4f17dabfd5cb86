"""Benchmark: headline warehouse queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "headline_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully evaluated with the no-op sink (every row computed, nothing
collected). The one-off staging materialization (derived inputs written as
parquet, as a real load lands them) is reported separately as ``setup``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "fact_seismic", "fact_disaster", "bridge", "scd2_rename", "surrogate_keys",
    "nearest_place", "quality_metrics", "top_countries_count", "completeness",
    "staging_antijoin", "keep_first", "rebuild", "read_disaster_csv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from quakehouse.plans.registry import QUERIES
    from quakehouse.plans.warehouse import Warehouse
    from quakehouse.session import build_session

    spark = build_session(f"local[{cpus}]", app="quakehouse-bench")
    t0 = time.time()
    w = Warehouse(spark, sf_dir)
    for t in (w.event_stage, w.disaster_stage, w.dim_geo, w.fact_seismic, w.fact_disaster, w.bridge):
        t.count()
    # land the feed files the reader queries parse (one-off, like a download)
    from quakehouse.plans.catalog_io import _disasters_path, _events_path
    _events_path(w)
    _disasters_path(w)
    setup = time.time() - t0

    times: dict[str, float] = {}
    for name in HEADLINE:
        s = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - s, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "setup_sec": round(setup, 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
