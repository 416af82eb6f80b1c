"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables, default sf0.1) and BENCH_CPUS (local cores, default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from linkrank import operators as g  # noqa: E402
from linkrank.sources import parse_link_dump  # noqa: E402
from registry.queries import graph, write_dump  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("linkrank-bench")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        result = run()
        if hasattr(result, "write"):
            result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    parts = timed("store_part_next", lambda: graph(spark, FOLDER, "part_next"))
    pages = timed("store_page_link", lambda: graph(spark, FOLDER, "page_link"))
    buyers = timed("store_cust_supp", lambda: graph(spark, FOLDER, "cust_supp"))
    ranks = timed("pagerank", lambda: g.pagerank(*parts))
    timed("pagerank_with_sinks", lambda: g.pagerank(*buyers))
    labels = timed("connected_components", lambda: g.connected_components(*pages))
    timed("connected_components_dense", lambda: g.connected_components(*parts))
    timed("component_sizes", lambda: g.component_sizes(labels))
    groups = timed("label_propagation", lambda: g.label_propagation(parts[1]))
    timed("modularity", lambda: g.modularity(parts[1], groups))
    timed("modularity_directed", lambda: g.modularity_directed(parts[1], groups))
    timed("authority_scores", lambda: g.authority_scores(*buyers))
    timed("hub_scores", lambda: g.hub_scores(buyers[0]))
    timed("in_degree_histogram", lambda: g.in_degree_histogram(buyers[0]))
    timed("shortest_path", lambda: g.shortest_path(parts[1], "1", "17"))
    timed("distance_to_target", lambda: g.distances_to(parts[1], "1"))
    timed("top_by_metric", lambda: g.top_by_metric(g.rank_degree_profile(parts[0], ranks)))
    dump = write_dump(spark, FOLDER)
    timed("parse_link_dump", lambda: parse_link_dump(spark, dump))
    print(
        json.dumps(
            {
                "metric": "link_graph_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
