"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` sink (every row is
computed, nothing is collected).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from canopy.plans.registry import load_all  # noqa: E402
from canopy.session import build_session  # noqa: E402

HEADLINE = [
    "clean_text", "corpus_sizes", "dedupe_multimodal", "message_record", "channel_coverage",
    "download_status", "batch_of_100", "ctfidf", "topic_info", "document_info",
    "eps_edges", "knn_exact", "density_clusters", "topic_model_info", "intermodal_crosstab",
    "representative_images", "annotate_topics", "image_dhash", "stream_posts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * int(cpus)))
    reg = load_all()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = reg[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
