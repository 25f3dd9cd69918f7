"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bibweave.plans.catalogue import QUERIES
from bibweave.session import local_session

HEADLINE = [
    "q12_duplicate_doi", "q12_duplicate_document_text", "q01_duplicate_article_titles", "q02_duplicate_titles",
    "q13_duplicate_scopus_id", "q18_ambiguous_orcid", "q20_invalid_issn", "q21_invalid_isbn", "q27_unicode_identifiers",
    "q28_stale_organisations", "q36_row_check_statistics", "q36_hits", "q36_standard_run", "q38_shared_orcids",
    "q39_partly_without_staff_id", "f04_tidy_html", "f19_match_text", "g06_collapse", "g17_per_month", "w02_running_total",
    "w03_previous_value", "n02_parse_names", "n05_aliases", "n08_one_to_one", "n09_search", "n13_authors", "n17_authors",
    "l01_title_links", "l06_best_matches", "q34_staff_last_modified", "x02_updatable", "x08_snapshot_changes",
    "x11_rendered_records", "t03_upserted_ids",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    sink(QUERIES["q12_duplicate_doi"](spark, sf_dir))  # warm-up
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            start = time.perf_counter()
            sink(QUERIES[name](spark, sf_dir))
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name} {best:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline query time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
