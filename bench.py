"""Benchmark: run the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver); the time per key is the wall time of that
action.  Before timing, every headline query runs once, untimed, on the
smallest tables (``BENCH_WARMUP_DIR``, default the sf0.001 folder) so that JVM
class loading and code generation are not charged to whichever query happens
to run first; the timed runs still do all of their work on ``BENCH_SF_DIR``.

``BENCH_HOT=1`` forces the paths for hot keys, large groups and large dimensions.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fault_rates", "label_telemetry", "fault_interval_join", "fault_interval_join_bucketed", "fault_episodes",
    "velocity", "ping", "step_audit", "spike_windows", "angle_error_trend", "top_k_per", "shuffle_rank",
    "profile_columns", "describe_num", "histogram", "corr_matrix", "dataset_manifest",
    "basket_pairs", "attach_rate", "cross_border", "cross_border_rates", "missing_charges", "recurring",
    "power_residual", "loss_breakdown", "pump_residual", "sales_cube", "overlay_solar", "overlay_wind",
    "overlay_pump", "split_by_share", "sample_weighted",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from gridlens.session import get_session
    from gridlens.plans.registry import load_all
    q, _ = load_all()
    keys = sys.argv[1:] or [k for k in HEADLINE if k in q]
    # BENCH_HOT=1 forces the paths meant for hot keys, large groups and large dimensions
    hot = {f"spark.gridlens.{k}": "2000" for k in ("bucketTargetRows", "quantileHotRows", "broadcastLimitBytes")}
    spark = get_session(f"local[{cpus}]", app="gridlens-bench", shuffle_partitions=max(8, 2 * cpus),
                        extra={**(hot if os.environ.get("BENCH_HOT") else {}), "spark.driver.memory": "16g",
                               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for k in keys:
            try:
                q[k](spark, warm).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001
                pass
    times, failed = {}, []
    for k in keys:
        t0 = time.perf_counter()
        try:
            q[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[k] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed.append(k)
            print(f"# {k} failed: {str(e).splitlines()[0][:200]}", file=sys.stderr)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "failed": failed}))
    if failed:
        sys.exit(1)  # a total without them would look faster


if __name__ == "__main__":
    main()
