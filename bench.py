"""Benchmark the headline queries and print ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
     BENCH_QUERIES (comma list, optional).
Each query is executed in full with the ``noop`` sink (no collect to the driver); the value per
query is the median of BENCH_RUNS runs after one warm-up run; ``value`` is their sum.
``shuffle_bytes`` (per query, one timed run) comes from Spark's event log, written to a fresh
scratch folder and read after the session stops (no UI, no REST endpoint).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "e2_classification",      # flagship: panel build -> grid -> fill -> labels -> baselines -> macro F1
    "c4_features",            # full labelled feature panel (one window stage)
    "c3_label_supplier",      # supplier x month panel from lineitem
    "w7_ffill_hourly",        # user x hour grid + limited fill from events
    "j1_full_outer_merge",    # two-source merge, one shuffle
    "j8_walk_forward",        # expanding folds without a join
    "q3_future_lag_value",    # value-based leakage scan
    "q8_leakage_report",      # fused leakage gate
    "e5_init_month",          # stratified skill
    "e7_regression",          # value forecasts RMSE / MAE
    "x1_export",              # export plan
    "a1_daily_mean",          # daily roll-up of events
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from panelcast.plans import catalog
    from panelcast.session import get_spark

    log_dir = tempfile.mkdtemp(prefix="bench-events-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark = get_spark("panelcast-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", _default_driver_memory()),
                             "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
                             "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    catalog.load_all()
    sc = spark.sparkContext
    timings, errors = {}, {}
    for name in names:
        def once(group):
            sc.setJobGroup(group, group)
            t0 = time.perf_counter()
            catalog.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        try:
            once(f"warmup:{name}")
            timings[name] = round(statistics.median(once(f"{'measure' if i == 0 else 'repeat'}:{name}")
                                                    for i in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - report the failure, keep measuring the others
            timings[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {"metric": "sum of median wall time of headline queries",
           "value": round(sum(v for v in timings.values() if v is not None), 3),
           "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus), "runs": runs,
           "shuffle_bytes": shuffle_bytes(log_dir)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


def _default_driver_memory() -> str:
    """60% of physical memory, at most 16g (the driver machine may be small)."""
    try:
        total_gb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2 ** 30
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(2, min(16, int(total_gb * 0.6)))}g"


def shuffle_bytes(log_dir: str) -> dict:
    """Shuffle bytes written per query (its first timed run), from the event log."""
    stage_group, written = {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        with open(path, errors="replace") as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                if not isinstance(ev, dict):
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    sid = ev.get("Stage ID")
                    written[sid] = written.get(sid, 0) + int(m.get("Shuffle Bytes Written", 0))
    out = {}
    for sid, b in written.items():
        group = stage_group.get(sid, "")
        if group.startswith("measure:"):
            name = group.split(":", 1)[1]
            out[name] = out.get(name, 0) + b
    return out


if __name__ == "__main__":
    main()
