"""The feed derived from order tables, on rows of its own."""

import re
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanmill import schemas, session
from loanmill.plans import lake as lakes
from loanmill.plans.lake import Lake
from loanmill.sources import star_feed
from loanmill.sources.feeds import Landing

DAY = datetime(1996, 3, 1)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "WEST")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "NATION_0", 0)]),
    "customer": ("c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, 0, 10.0, "BUILDING"), (2, None, 10.0, "X")]),
    "supplier": ("s_suppkey bigint, s_name string", [(1, "Lender")]),
    "part": ("p_partkey bigint, p_type string, p_size int", [(1, "PROMO", 12), (67, "PROMO", 12)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(1, 1, 100.0, DAY, "1-URGENT"), (2, 2, 100.0, DAY, "1-URGENT"), (3, None, 100.0, DAY, "1-URGENT")],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [
            (1, 1, 1, 1, 5.0, 50.0, 0.0, 0.05, "A", "F", DAY), (1, 67, 1, 2, 5.0, 50.0, 0.0, 0.05, "A", "F", DAY),
            (1, 1, 1, 3, 5.0, 50.0, 0.0, 0.05, "N", "O", DAY), (1, 1, 1, 4, 5.0, 50.0, 0.0, 0.05, "N", None, DAY),
            (2, 1, 1, 1, 5.0, 50.0, 0.0, 0.05, "N", "O", DAY), (3, 1, 1, 1, 5.0, 50.0, 0.0, 0.05, "N", "O", DAY),
        ],
    ),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_feed_goes_straight_into_its_two_batches(spark, tables, monkeypatch):
    def none(*_):
        raise AssertionError("a table of its own")

    monkeypatch.setattr(lakes, "written", none)
    counts = Lake(spark, tables).landing.counts().collect()
    # The second line is delivered twice; a line without a status counts as JSON; orders without customer or nation drop out.
    assert {tuple(r) for r in counts} == {(star_feed.CSV_FILE, 3, 0), (star_feed.JSON_FILE, 2, 0)}


def test_lines_do_not_travel_to_customers(spark, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = star_feed.feed(spark, tables)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    (at,) = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in line]
    below = [line for line in lines[at + 1 :]]
    below = below[: next((k for k, line in enumerate(below) if depth(line) <= depth(lines[at])), len(below))]
    assert below and not any("l_orderkey" in line for line in below)


def test_row_groups_of_written_tables_are_smaller_than_a_split(spark, monkeypatch):
    assert session.ROW_GROUP_BYTES < int(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    monkeypatch.setattr(session, "ROW_GROUP_BYTES", 1 << 20)
    table = session.written(spark.range(400_000).coalesce(1).selectExpr("xxhash64(id) AS h"), "row-groups")
    (path,) = [f for f in table.inputFiles()]
    assert pq.ParquetFile(path.removeprefix("file://")).num_row_groups > 1
    assert table.distinct().count() == 400_000


def test_both_files_are_landed_by_one_pass(spark, tables):
    lake = Lake(spark, tables)
    landing = lake.landing
    files = [path.split("/")[-2:] for path in lake.bronze.inputFiles()]
    jobs = {re.match(r"part-\d+-(.{36})", name).group(1) for _, name in files}
    assert len(jobs) == 1 and len({folder for folder, _ in files}) == 2
    times = {(r["_source_file"], r["_ingestion_timestamp"]) for r in landing.bronze().collect()}
    assert times == {(star_feed.CSV_FILE, star_feed.CSV_TIME), (star_feed.JSON_FILE, star_feed.JSON_TIME)}
    assert {(r["file"], r["files_of_batch"]) for r in landing.manifest().collect()} == {(star_feed.CSV_FILE, 1), (star_feed.JSON_FILE, 1)}


def test_a_file_of_the_pass_without_rows_is_landed_empty(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "bronze"))
    cells = [F.lit("1").alias(c) for c in schemas.SOURCE_COLUMNS[1:]]
    rows = spark.range(3).select(F.when(F.col("id") > 0, "1").alias("application_id"), *cells, F.lit("a.csv").alias("_source_file"))
    landing.load_each(rows, {"a.csv": DAY, "b.csv": DAY})
    assert {tuple(r) for r in landing.counts().collect()} == {("a.csv", 2, 1), ("b.csv", 0, 0)}
    landing.load_each(rows.limit(0), {"a.csv": DAY})
    assert {tuple(r) for r in landing.counts().collect()} == {("a.csv", 0, 0), ("b.csv", 0, 0)}


def test_a_setting_holds_for_its_body_only(spark):
    key, get = "spark.sql.maxConcurrentOutputFileWriters", lambda: spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    with pytest.raises(ValueError), session.setting(spark, key, "2"):
        assert get() == "2"
        with session.setting(spark, key, "3"):
            assert get() == "3"
        assert get() == "2"
        raise ValueError
    assert get() is None
