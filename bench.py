"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crawlspark import catalog  # noqa: E402
from crawlspark.session import build_session  # noqa: E402

HEADLINE = (
    "fetch_index generate webdb_upsert extract_links extract_pages enrich_urls redirect_representative "
    "page_text robots_meta main_content url_partition selector_order generate_per_partition_limit "
    "index_write doc_add_if_absent fetch_content fetch_backoff crawl_report crawl_rounds"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        took = []
        # the first run warms code generation up and is not counted
        for _ in range((runs if name != "crawl_rounds" else 1) + 1):
            start = time.perf_counter()
            catalog.run(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
