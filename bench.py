"""Times the load stages and every report query; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
from pathlib import Path
from time import perf_counter

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loanmill.plans.catalog import CATALOG
from loanmill.plans.lake import Lake
from loanmill.plans.load import run_all
from loanmill.sources import star_feed
from loanmill.sources.feeds import Source

# Queries that read the stored layers; the load itself is timed by stage.
REPORTS = [
    "q01", "q02", "q03", "q04", "q05", "q06", "q07", "q08", "q09", "q10", "portfolio_summary", "portfolio_trends",
    "portfolio_view", "by_state", "by_lender", "top_denial_by_state", "filter_domains", "dq_checks", "profile_columns",
    "dedup_latest", "doc_chunks", "vector_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lake.of(spark, sf_dir)
    times: dict[str, float] = {}

    # Raw files, outside the clock: the feed as one CSV and one JSON-lines folder.
    root = tempfile.mkdtemp(prefix="loanmill-bench-")
    feed = star_feed.feed(spark, sf_dir).cache()
    raw_rows = feed.count()
    csv, js = f"{root}/raw/core", f"{root}/raw/broker"
    feed.filter(F.col("_source_file") == star_feed.CSV_FILE).drop("_source_file").write.option("header", True).csv(csv)
    feed.filter(F.col("_source_file") != star_feed.CSV_FILE).drop("_source_file").write.option("ignoreNullFields", False).json(js)
    feed.unpersist()
    sources = [
        Source("core", "csv", f"{csv}/part-*.csv", one_record_per_line=True),
        Source("broker", "json", f"{js}/part-*.json", one_record_per_line=True),
    ]
    for attempt in ("cold", "warm"):
        result = run_all(spark, f"{root}/{attempt}", sources, lake.rules, star_feed.JSON_TIME)
        times |= {f"load_{stage}" + ("_cold" if attempt == "cold" else ""): s for stage, s in result.seconds.items()}
    load_seconds = sum(result.seconds.values())

    assert lake.star and lake.bronze and lake.checked
    for name in REPORTS:
        seconds = []
        for _ in range(2):
            begin = perf_counter()
            CATALOG[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(perf_counter() - begin)
        times[name] = round(min(seconds), 3)

    print(json.dumps({
        "metric": "load stages (warm) plus report queries, wall clock",
        "value": round(load_seconds + sum(times[n] for n in REPORTS), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "raw_rows": raw_rows,
        "load_seconds": round(load_seconds, 3),
        "load_rows_per_second": round(raw_rows / load_seconds),
        "stage_rows_per_second": {s: round(raw_rows / t) for s, t in result.seconds.items() if t},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
