"""Speed-layer figures: ingest rows/s from the progress listener and the
file count of the watch fact before and after compaction.

    BENCH_SF_DIR=/root/testdata/sf0.1 python tools/stream_bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from reelpulse.plans import catalog
    from reelpulse.session import build_session
    from reelpulse.streaming import ingest as st

    spark = build_session(f"local[{cpus}]", app="reelpulse-stream-bench", shuffle_partitions=cpus,
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.sql.sources.parallelPartitionDiscovery.threshold": "100000"})
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    listener = st.MetricsListener()
    t0 = time.perf_counter()
    root, paths = catalog._run_ingest(spark, sf_dir, files=8, per_trigger=2, listener=listener)
    wall = time.perf_counter() - t0
    rows = [r for r in listener.rows if r[3] > 0]
    n_in = sum(r[3] for r in rows)
    before = len(spark.read.parquet(paths.watch).inputFiles())
    t1 = time.perf_counter()
    out = st.compact(spark, paths.watch, f"{root}/fact_watch_history_compacted")
    compact_s = time.perf_counter() - t1
    after = len(spark.read.parquet(out).inputFiles())
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "sf": float(m.group(1)) if m else None,
        "batches": len(rows),
        "input_rows": n_in,
        "ingest_wall_sec": round(wall, 2),
        "rows_per_sec_processed": round(n_in / max(sum(r[6] for r in rows) / 1000, 1e-9), 1),
        "watch_files_before_compaction": before,
        "watch_files_after_compaction": after,
        "compaction_sec": round(compact_s, 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
