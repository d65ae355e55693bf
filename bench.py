"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout.

Each query runs once to warm up and then $BENCH_REPEATS times (default 3); the median
counts. All rows are produced, into the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from carelake import registry  # noqa: E402
from carelake.fixtures import Inputs  # noqa: E402
from carelake.plans.patients import patient_journey_plain  # noqa: E402
from carelake.registry.aggregates import labelled  # noqa: E402
from carelake.session import get_session  # noqa: E402

HEADLINE = [
    "ds_daily_kpis", "ds_revenue", "ds_clinical", "ds_inventory", "ds_patient_360",
    "ds_patient_acuity", "ds_patient_journey", "ds_clean_events", "ds_fact_encounters",
    "ds_market_dna", "dml_merge", "dml_merge_guarded", "doc_anonymize", "doc_product_cards", "str_hourly_monitor",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    known = registry.queries()
    runs = {name: known[name] for name in chosen if name in known}
    if not sys.argv[1:]:
        # For comparison only: the journey with ordinary windows (one task per hot patient).
        runs["journey_plain_windows"] = lambda s, d: patient_journey_plain(labelled(Inputs(s, d)))
    seconds = {}
    for name, build in runs.items():
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], [round(t, 2) for t in times], file=sys.stderr, flush=True)
    total = round(sum(v for k, v in seconds.items() if k != "journey_plain_windows"), 3)
    print(json.dumps({"metric": "total of headline queries, warm median", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
