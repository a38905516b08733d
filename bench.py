"""Benchmark: headline queries at one scale factor, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (full execution, no
collect to the driver); times are wall-clock seconds after one warm-up pass of
every headline query on the smallest scale factor (JIT and generated-code
caches, Python workers), i.e. steady-state throughput.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans import registry  # noqa: E402
from quire.plans.books import onix_ingest  # noqa: E402
from quire.session import build_session  # noqa: E402

HEADLINE = [
    "book_upsert", "soft_delete_reactivate", "stock_gated_merge", "framed_csv_inventory", "unframed_csv_avail",
    "promotions_upsert", "firm_sale_upsert", "excerpt_upsert", "job_progress", "ledger_transitions",
    "quarantine", "genres_upsert", "embedding_text", "fts_rank", "cosine_topk", "trigram_title",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="quire-bench")
    qs = registry.queries()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        onix_ingest(spark, warm_dir).write.format("noop").mode("overwrite").save()
        for name in HEADLINE:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    t0 = time.time()
    onix_ingest(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times["onix_ingest"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").count()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "onix_books_per_sec": round(parts / times["onix_ingest"], 1) if times["onix_ingest"] else None,
        "notices_per_sec": round(lines / times["book_upsert"], 1) if times["book_upsert"] else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
