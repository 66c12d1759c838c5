"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4) choose data and
cores. Every query is run to a no-op sink, after one untimed run on the smallest tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from padron.catalogue import QUERIES
from padron.session import local_session

HEADLINE = [
    "q_explode_aligned",
    "q_validate_cif",
    "q_clean_mentions",
    "q_group_mentions",
    "q_golden_records",
    "q_company_table",
    "q_split_consortium",
    "q_phrase_containment_join",
    "q_token_overlap_join",
    "q_fuzzy_join",
    "q_link_consortia",
    "q_consortium_members",
    "q_stoplist_percentile",
    "q_register_link",
    "q_forward_fill",
]
WARM_DIR = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(cpus, "padron-bench")
    timings: dict[str, float] = {}
    for name in HEADLINE:
        QUERIES[name](spark, WARM_DIR).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs), 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": scale}))


if __name__ == "__main__":
    main()
