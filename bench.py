"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from punctum.plans.queries import registry
from punctum.session import local_session

HEADLINE = [
    "detect_blocks", "detect_blocks_3d", "detect_images", "detect_images_auto", "detect_blocks_lsq", "detect_blocks_multiconsensus", "spot_intensity",
    "gauss_smooth", "dog_anisotropic", "dog_peaks", "gradients", "background_ransac_mean",
    "scan_chunks", "halo_voxels", "spots_nearest", "spots_unmatched",
    "chunk_manifest", "pending_inputs", "poll_delta", "task_durations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registry(), {}
    queries["detect_blocks"](spark, sf_dir).count()  # starts the Python workers and compiles code
    for name in HEADLINE:
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
