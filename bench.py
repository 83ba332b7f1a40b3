"""Headline-query bench: prints ONE JSON line with per-query wall seconds.

    BENCH_SF_DIR (default /root/testdata/sf0.1)   BENCH_CPUS (default 8)
    BENCH_QUERIES (optional comma list)           BENCH_REPEAT (default 1; best of N)

Every query is executed completely (``noop`` sink: all rows produced, nothing collected);
the time includes the eager steps some operators run while planning (offset tables of the
distributed rank, quantile probes).
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "model_train", "lead_purchase_join", "latest_lead_per_day", "valid_leads", "param_extract",
    "user_features", "behaviour_counters", "src_training_table", "cat_vocab_fit", "cat_encode",
    "rank_by_score", "average_precision", "roc_auc", "roc_points", "qcut_deciles", "decile_lift",
    "band_lift", "capacity_table", "grade_table", "confusion_at_top", "grade_assign",
    "stratified_split", "data_fingerprint", "snap_asof",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    from leadlens.plans.catalogue import QUERIES, load_all
    from leadlens.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    load_all()
    # warm-up: JVM, parquet reader and writer, codegen caches (not timed)
    QUERIES["snap_asof_stored"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for q in names:
        best = float("inf")
        try:
            for _ in range(repeat):
                t = time.perf_counter()
                QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - t)
            times[q] = round(best, 3)
        except Exception as e:  # noqa: BLE001 — one failing query must not lose the whole line
            times[q] = None
            errors[q] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_total_wall", "value": round(sum(v for v in times.values() if v is not None), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
