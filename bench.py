"""Benchmark: nightly load + the 13 marts (+ operator queries) at $BENCH_SF_DIR.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
The nightly load builds and writes the warehouse once; each mart then runs
on the written tables (as analysts would), forced with a no-op sink so the
whole plan executes without collecting to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from locastar.session import get_session
    extra = {"spark.driver.memory": "16g"}
    event_log = os.environ.get("BENCH_EVENT_LOG")   # folder for Spark's event log (stage/task times)
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = get_session(f"local[{cpus}]", app_name="locastar-bench",
                        shuffle_partitions=max(8, cpus * 2), extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    from locastar.plans.marts import MARTS
    from locastar.plans.nightly import read_warehouse, run_nightly
    from locastar.plans import registry
    from locastar.sources.analogue import AS_OF

    out_dir = tempfile.mkdtemp(prefix="locastar-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    times: dict[str, float] = {}

    t0 = time.time()
    version = run_nightly(spark, sf_dir, out_dir, AS_OF)
    times["nightly_load"] = round(time.time() - t0, 3)

    t0 = time.time()   # the usual night: everything is stored already
    version = run_nightly(spark, sf_dir, out_dir, AS_OF)
    times["nightly_second"] = round(time.time() - t0, 3)

    dw = read_warehouse(spark, out_dir, version)
    for name, fn in MARTS.items():
        t = time.time()
        fn(dw, AS_OF).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    # operator-level queries that read the input tables directly
    for name, fn in registry.QUERIES.items():
        if name in MARTS or not registry.BENCH.get(name, False):
            continue
        t = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_nightly_plus_marts",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "spark": spark.version, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
