"""Time the headline queries: one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores, ``BENCH_QUERIES``
an optional comma-separated choice. Each query is planned and run to the end once, after one
small warm-up query; the stored incidents table is written before the timing and reported as
its own entry.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from alertloom.plans import derive  # noqa: E402
from alertloom.plans.queries import QUERIES  # noqa: E402
from alertloom.session import build_session  # noqa: E402

HEADLINE = [
    "q_ingest", "q_deadletter", "q_normalize", "q_template", "q_enrich", "q_match_matrix",
    *[f"q_corr_{i:03d}" for i in range(1, 7)], "q_incidents", "q_incidents_split", "q_open_counts", "q_counters",
    "q_features", "q_store_row", "q_upsert", "q_docs",
    "q_summary", "q_by_category", "q_timeline_24h", "q_timeline_30d", "q_top_hosts", "q_top_rules", "q_conf_hist",
    "q_list", "q_list_page2", "q_search", "q_recent", "q_update", "q_labels", "q_top_probs",
    "q_label", "q_encode", "q_group_split", "q_strat_split", "q_report", "q_confusion", "q_calibration",
    "q_fw_parse", "q_portscan", "q_ssh_brute", "s_ingest", "s_corr", "s_store",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(cpus), "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("q_rule_class")
    times = {}
    started = time.perf_counter()
    derive.stored_incidents(spark, sf_dir)
    times["store_incidents"] = round(time.perf_counter() - started, 3)
    for name in names:
        started = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
