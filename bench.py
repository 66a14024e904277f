"""Time the headline queries on one data set and print one JSON line: the best of three warm runs, and all of them."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filmloom.queries import QUERIES  # noqa: E402
from filmloom.session import build_session  # noqa: E402

RUNS = 3
HEADLINE = (
    "r13_film_documents",
    "r13_text_film_documents",
    "j1_star_left_joins",
    "j2_full_outer_chain",
    "j4_admin_annotations",
    "u1_union_of_affected",
    "q2_unique_role_link",
    "o4_page",
    "o5_all_pages",
    "o5_deep_page",
    "o5_listing_page",  # opens a listing that the first run writes
    "o5_listing_changes",  # writes its listing anew in each run, then changes it twice
    "r2_film_list",
    "r6_genre_films",
    "r10_person_films",
    "r11_admin_list",
    "x1_mixed_analyser",
    "x3_vocabulary",
    "x3_incremental_index",  # builds its index anew in each run, then changes it
    "x6_relevance_order",
    "x6_short_texts",
    "x9_clauses",
    "x7_fuzzy_match",
    "k3_upsert_idempotent",
    "r14_incremental_refresh",
    "r14_link_changes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["r13_film_documents"](spark, sf_dir).limit(1).collect()  # start-up is not part of any query
    runs: dict[str, list[float]] = {}
    for name in HEADLINE:
        for run in range(1 + RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:  # the first is not warm
                runs.setdefault(name, []).append(round(time.perf_counter() - start, 3))
    times = {name: min(taken) for name, taken in runs.items()}
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
