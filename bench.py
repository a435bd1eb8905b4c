"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed once to warm up, then ``BENCH_REPEAT`` times (default 3); the
median wall time is reported.  Results are forced with the ``noop`` sink, so the
timing covers the whole plan without pulling rows to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from colforge.plans.catalog import registry  # noqa: E402
from colforge.session import get_session  # noqa: E402

HEADLINE = [
    "tg11_player_targets", "bd1_band_half", "fl7_cleaning_report", "pj14_row_mean_nonzero",
    "cl1_prepare_fixtures", "cl2_prepare_players", "cl3_format_fixtures", "jn3_lineup_enrich",
    "jn4_first_per_key", "ag1_group_mean", "ag5_distinct_counts", "ag6_pairwise_corr",
    "fs3_identify_collinear", "en1_label_encode", "sp1_stratified_split", "sp3_stacking_split",
    "rb1_undersample_three_class", "ev2_classification_report", "rl8_lineup_verdict", "ml1_random_forest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session("colforge-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()
    names = only or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        fn = reg[name][0]

        def run():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()
        times[name] = round(statistics.median(run() for _ in range(repeat)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat,
                      "spark": spark.version,
                      "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}))
    spark.stop()


if __name__ == "__main__":
    main()
