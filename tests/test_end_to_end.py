"""The whole load on generated files, and every query against DuckDB on the smallest test tables."""

from datetime import datetime
from pathlib import Path

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from loanmill.plans import load
from loanmill.plans.catalog import CATALOG
from loanmill.plans.lake import Lake
from loanmill.plans.oracle import oracle
from loanmill.sources import audit, star_feed
from loanmill.sources.feeds import Landing, Source
from loanmill.sources.tables import Warehouse

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_equals_sql(spark, con, name):
    df = entry_point.queries()[name](spark, SF)
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare.differences(df, con, sql) == []


def test_every_query_has_sql():
    assert set(CATALOG) == set(oracle())
    assert set(CATALOG) <= set(entry_point.queries()) and set(oracle()) <= set(entry_point.oracle_sql())


def test_files_in_reports_out(spark, tmp_path):
    lake = Lake.of(spark, SF)
    rows = star_feed.feed(spark, SF)
    is_csv = F.col("_source_file") == star_feed.CSV_FILE
    rows.filter(is_csv).drop("_source_file").write.option("header", True).csv(f"{tmp_path}/core")
    rows.filter(~is_csv).drop("_source_file").write.option("ignoreNullFields", False).json(f"{tmp_path}/broker")
    sources = [
        Source("core", "csv", f"{tmp_path}/core/part-*.csv"),
        Source("broker", "json", f"{tmp_path}/broker/part-*.json", one_record_per_line=True),
        Source("absent", "csv", f"{tmp_path}/absent*.csv"),
    ]
    root, now = f"{tmp_path}/out", datetime(2002, 1, 2)
    with pytest.raises(FileNotFoundError):
        load.latest_quality_report(Warehouse(spark, root))
    first = load.run_all(spark, root, sources, lake.rules, now)
    assert first.transform.rows_rejected == lake.rejects.count()
    assert first.load.rows_new == lake.star.fact.count()
    assert {r["name"]: r["passed"] for r in first.checks.collect()} == {
        r["name"]: r["passed"] for r in entry_point.queries()["dq_checks"](spark, SF).collect()
    }
    warehouse = Warehouse(spark, root)
    assert Landing(spark, f"{root}/bronze_loan_application").bronze().count() == lake.bronze.count()
    assert warehouse.read(load.PROFILE).count() == 20
    stages = {r["stage"]: r["status"] for r in audit.latest_run(audit.log_of(warehouse)).collect()}
    assert stages == dict.fromkeys(("ingestion", "transformation", "dimensional_load", "data_quality"), "SUCCESS")
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "loanmill" / spark.sparkContext.applicationId
    assert not (shared / first.run_id).exists() and not list(Path(root).rglob("_staging"))
    again = load.run_all(spark, root, sources, lake.rules, datetime(2002, 1, 3))
    assert (again.load.rows_new, again.load.rows_updated, again.load.rows_unchanged) == (0, 0, first.load.rows_new)
    assert load.latest_quality_report(warehouse).first()["generated_at"] == datetime(2002, 1, 3)
