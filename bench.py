"""Benchmark: run the headline catalog queries at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, optional), BENCH_REPEAT (best of n, default 1).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed completely through a no-op sink (nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "b13_feature_types",        # profile + semantic typing (B1, B12, B13)
    "b27_box_stats",            # exact quartiles
    "x3_stratified_split",      # exact stratified split (bucketed ranks)
    "x7_stratified_kfold",      # stratified folds
    "f22_pipeline_transform",   # full preprocessing fit + transform
    "f9_hashing",               # md5 hashing encoder
    "f19_correlation_filter",   # pairwise correlations
    "a5_a7_cramers_v",          # all categorical pairs in one aggregation
    "a8_a10_theils_u",
    "a11_anova",
    "a12_mutual_information",
    "a2_spearman",              # distributed ranks
    "g3_rank_pairs",            # MI ranking of interaction pairs
    "g5_binning",
    "g6_group_aggregates",
    "l1_mi_filter",
    "e1_roc_auc",               # exact AUC via range-partitioned running sums
    "e9_threshold_curve",
    "e12_roc_points",
    "m3_linear_closed_form",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    os.environ.setdefault("TABSMITH_MASTER", f"local[{cpus}]")

    from tabsmith.plans import registry
    from tabsmith.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus), app_name="tabsmith-bench")
    qs = registry.queries()
    times, errors = {}, {}
    # warm-up on the smallest tables: JVM start, JIT and code generation caches
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for w in ("b13_feature_types", "b27_box_stats", "e1_roc_auc"):
        try:
            qs[w](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir).write.format("noop").mode("overwrite").save()
        except Exception:
            pass
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.time()
            try:
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # report, keep going
                errors[name] = re.sub(r"\s+", " ", str(e))[:200]
                best = None
                break
            dt = time.time() - t0
            best = dt if best is None else min(best, dt)
        if best is not None:
            times[name] = round(best, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
