"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronomart.session import build_session, scratch_scope  # noqa: E402
from workload import queries  # noqa: E402

HEADLINE = [
    "scd2_apply",
    "scd2_apply_composite",
    "his_durations",
    "load_append_new",
    "mart_membership",
    "mart_diversity_top20",
    "mart_member_rank",
    "gra_overlap",
    "gra_member_specialisation",
    "txt_keywords",
    "txt_term_frequency",
    "txt_category_distribution",
    "agg_collect_set",
    "agg_dedupe_key",
    "src_pages",
    "src_envelope_dir",
    "fact_event",
    "mart_events",
    "clean_member_events",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        timed = []
        for _ in range(RUNS + 1):
            with scratch_scope(spark):
                started = time.perf_counter()
                registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                timed.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timed[1:]), 3)  # the first run warms up
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
