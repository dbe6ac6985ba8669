"""Times every registered query of the odds tables; prints one JSON line.

Each query runs in full into Spark's noop sink, twice in a row: ``cold`` holds the
first run (class loading and code generation included), ``queries`` the second.
``value`` sums the second runs of the queries that the first bench had, so that
it compares over rounds; ``all_queries_total`` sums all. Times go to the error
output as they are taken. A query that fails is named in ``failed`` and counted
in no sum. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from linesmith.plans.catalog import all_queries  # noqa: E402
from linesmith.session import clear_scratch, local_session  # noqa: E402

#: Takes a path on purpose that its input would not.
FORCED = {"ledger_rounds"}
#: The queries of the first bench.
HEADLINE = ("unpack_first_events opening_lines pivot_books assemble_wide team_lookup fill_within_user fill_hot_type page_rows "
            "odds_response opponents line_movement game_grain dedupe_keys impute_median exact_medians cover_model kelly_settle "
            "weekly_pnl ledger season_record pick_strings weekly_store weekly_csv").split()


def seconds_of(spark, run, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    taken = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    return taken


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name, query in all_queries().items():
        if name in FORCED:
            continue
        try:
            first, second = seconds_of(spark, query.run, folder), seconds_of(spark, query.run, folder)
        except Exception as error:  # the others still count
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
            print(f"{name} failed", file=sys.stderr, flush=True)
            continue
        cold[name], warm[name] = first, second
        print(f"{name} {first} {second}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(warm.get(q, 0) for q in HEADLINE), 3), "unit": "sec",
                      "all_queries_total": round(sum(warm.values()), 3), "queries": warm, "cold": cold, "failed": failed,
                      "sf": float(Path(folder).name.removeprefix("sf") or 0)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
