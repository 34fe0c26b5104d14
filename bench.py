"""Benchmark: the daily lake build plus the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Phase 1 ("lake_build") lands Bronze in memory, writes Silver and Gold to the
shared folder and reads them back — what the daily batch does (Silver,
then the DQ audit of Silver, then Gold).  Phase 2
times each headline query on the written lake with a ``noop`` sink (full
execution, nothing collected).  Each query is run twice and the second
(warm) time is reported, with the shuffle bytes it wrote (from Spark's
event log in a scratch folder).
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_360", "txn_monthly_summary", "segment_metrics", "support_kpis",
    "q1_segment_summary", "q2_churn_top100", "q3_high_value", "q4_monthly_trend",
    "q5_geography", "q6_cross_sell", "q7_ticket_kpis", "q8_segment_changes",
    "q9_fraud_exposure", "q10_dq_latest", "v1_executive_kpis", "v2_segment_breakdown",
    "v3_geography", "v4_churn_detail", "v5_monthly_trend", "v6_cross_sell",
    "v7_support_ops", "dq_results", "scd2_history", "dedup_latest", "layer_audit",
    "branch_rollup", "spend_by_channel",
]


def shuffle_bytes(log_dir: str) -> dict:
    """Shuffle bytes written per job group, from the (stopped) app's event log."""
    stage_group, out = {}, {}
    # Spark 4 writes a folder per application (eventlog_v2_<app>/events_N_<app>)
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    g = stage_group.get(info["Stage ID"])
                    if not g or not g.endswith("#1"):
                        continue
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            key = g[:-2]
                            out[key] = out.get(key, 0) + int(acc.get("Value", 0))
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from bankmart.session import build_session, scratch_path
    from bankmart.plans.lake import Lake
    from bankmart.plans import catalogue

    log_dir = tempfile.mkdtemp(prefix="bankmart-bench-events-")
    spark = build_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)),
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    catalogue.queries()          # register all query modules
    fns = catalogue.QUERIES

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    times = {}
    # the lake build runs twice into fresh folders; the second (warm JVM) run
    # is reported, like the queries below
    for i in range(2):
        sc.setJobGroup(f"lake_build#{i}", "lake build")
        t0 = time.time()
        lake = Lake.materialized(spark, sf_dir, scratch_path(spark, "bench-lake"))
        times["lake_build"] = round(time.time() - t0, 3)

    for key in HEADLINE:
        best = None
        for i in range(2):
            sc.setJobGroup(f"{key}#{i}", key)
            t = time.time()
            run(fns[key](lake))
            best = time.time() - t
        times[key] = round(best, 3)

    spark.stop()
    try:
        shuffled = shuffle_bytes(log_dir)
    except Exception:  # noqa: BLE001 — the timings are the result; bytes are extra
        shuffled = {}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "shuffle_bytes": {k: shuffled.get(k, 0) for k in times}}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
